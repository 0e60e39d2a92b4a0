import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tallyrank.llm import conversation as cv
from tallyrank.llm.queries import QUERIES

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        case = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 0:
            continue
        role, text = "user" if case == 4 else role, "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(conv_id, turn, role, text)] * (2 if case == 3 else 1)
    return out


def plain(rows):
    """The report of one conversation by trying all edits: (cost, audit) by the rows and the roles so far."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    n = len(rows)

    @lru_cache(None)
    def best(i, last, added):
        """Cheapest (cost, audit, lines) for rows i.. after the role ``last``; ``added`` inserts stand in a row."""
        found = [(0, "", ())] if i == n and last in ("", "a") else []

        def then(cost, letter, role, rest):
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], ((role,) if role else ()) + rest[2]))

        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        if added < 2:
            for role in ("user", "assistant"):
                if role[0] in allowed:
                    then(3, "I", f"{role}:", best(i, role[0], added + 1))
        if i < n:
            then(4, "D", None, best(i + 1, last, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if rows[i][2][:1] and rows[i][2][0] in allowed:
                    then(more, "K", f"{rows[i][2]}:{rows[i][3]}", best(i + 1, rows[i][2][0], 0))
                for role in ("user", "assistant"):
                    if role[0] in allowed:
                        then(3 + more, "R", f"{role}:{rows[i][3]}", best(i + 1, role[0], 0))
        return min(found) if found else None

    cost, audit, lines = best(0, "", 0)
    turns = {r[1] for r in rows} - {None}
    roles = [r[2][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def _random(seed, convs=120, most=14):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \t", "é!", "a b. \n", "x\x85"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "umpire"]
    rows = []
    for conv in range(convs):
        for k in range(rng.randint(0, most)):
            rows.append((conv, rng.choice([k, k, k, 2 * k, None]), rng.choice(roles) if rng.random() < 0.5 else roles[1 + k % 2], rng.choice(texts) if rng.random() < 0.5 else f"turn {k}."))
    return rows


def _by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed,block_rows", [(1, 1 << 16), (2, 1), (3, 3)])
def test_reports_and_turns_match_brute_force(spark, seed, block_rows):
    rows = _random(seed)
    table = spark.createDataFrame(rows, SCHEMA)
    report = cv.repair_conversations(table, block_rows=block_rows)
    got = {r.conv_id: r.asDict() for r in report.collect()}
    want = {k: plain(v) for k, v in _by_id(rows).items()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == {"conv_id": key, **row}, _by_id(rows)[key]
    lines = {}
    for r in sorted(cv.repaired_turns(table, report).collect(), key=lambda r: (r.conv_id, r.position)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for key, row in want.items():
        assert hashlib.sha256("\n".join(lines.get(key, [])).encode()).hexdigest() == row["repaired_sha256"]


def test_state_crosses_batches(spark):
    rows = [(7, k, "user" if k % 3 else "assistant", f"turn {k}." if k % 5 else "open") for k in range(900)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 13)
    try:
        got = cv.repair_conversations(spark.createDataFrame(rows, SCHEMA), block_rows=50).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    whole = cv.Reader(7)
    seen = set()
    for _, turn, role, text in rows:
        whole.row(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    want = whole.out(True)
    assert len(got) == 1 and len(got[0].audit.replace("I", "")) == 900
    assert [got[0][c] for c in (*cv.COUNTS, "repaired_sha256")] == [want[c] for c in (*cv.COUNTS, "repaired_sha256")]


def test_the_query_damages_and_reports_every_conversation(spark, tmp_path):
    rows = _random(4, 60, 6) + [(None, None, None, None), (None, 1, "user", "Hi."), (9000, None, "assistant", None)]
    rows += [(conv, 0, "user", "Only.") for conv in range(1000, 1060)]  # some of them lose their only row
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'z' AS audit", "1 AS cost", "'q' AS repeated")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r.asDict() for r in QUERIES["op12_repair"](spark, str(tmp_path)).collect()}
    kept = _by_id(damage(rows))
    assert got.keys() == {r[0] for r in rows} and len(kept) < len(got)
    for key in got:
        assert got[key] == {"conv_id": key, **plain(kept.get(key, []))}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    report = cv.repair_conversations(none, none)
    assert report.count() == 0 and cv.repaired_turns(none, report).count() == 0
