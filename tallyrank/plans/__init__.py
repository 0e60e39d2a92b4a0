"""Registered queries by family."""

from __future__ import annotations

from importlib import import_module

from tallyrank.plans.registry import REGISTRY, Registry

FAMILIES = ["relational", "neighbours", "metrics", "sequences", "features", "vectors", "profiles", "models"]


def load_all() -> Registry:
    for family in FAMILIES:
        import_module(f"tallyrank.plans.{family}")
    return REGISTRY
