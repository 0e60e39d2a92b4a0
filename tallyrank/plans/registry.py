"""Named queries: a Spark plan over a table folder and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyrank.sources.tables import Tables

# Shared SQL views, the counterparts of sources.tables.
VIEWS = {
    "inter": """
        SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
               CAST(1 + CAST(sum(l.l_quantity) AS BIGINT) % 5 AS DOUBLE) AS rating,
               CAST(epoch(min(o.o_orderdate)) AS BIGINT) AS ts
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2""",
    "train": "SELECT * FROM inter WHERE substr(md5(concat(user_id, '-', item_id)), 1, 2) < 'b3'",
    "test": "SELECT * FROM inter WHERE substr(md5(concat(user_id, '-', item_id)), 1, 2) >= 'b3'",
    "brand": """
        SELECT o.o_custkey AS user_id, p.p_brand AS item_id,
               CAST(1 + CAST(sum(l.l_quantity) AS BIGINT) % 5 AS DOUBLE) AS rating
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
        JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2""",
    "baskets": """
        SELECT DISTINCT l.l_orderkey AS basket, p.p_brand AS item
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    "catalogue": "SELECT p_partkey AS item_id, p_type AS category FROM part",
}
NEEDS = {"train": ["inter"], "test": ["inter"]}


def with_views(names: str, body: str, **extra: str) -> str:
    """Prefix ``body`` with the named shared views and any extra ones, in order."""
    ordered: list[str] = []
    for name in names.split():
        for need in [*NEEDS.get(name, []), name]:
            if need not in ordered:
                ordered.append(need)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in ordered]
    parts += [f"{n} AS MATERIALIZED ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


@dataclass
class Registry:
    plans: dict[str, Callable[[Tables], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None):
        def add(fn: Callable[[Tables], DataFrame]):
            if name in self.plans:
                raise ValueError(f"query {name} is registered twice")
            self.plans[name] = fn
            if sql:
                self.sql[name] = sql
            return fn

        return add

    def callables(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bind(fn):
            return lambda spark, folder: fn(Tables(spark, folder))

        return {name: bind(fn) for name, fn in self.plans.items()}


REGISTRY = Registry()
