import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyrank.llm import linededup as ld
from tallyrank.llm.queries import QUERIES
from tests_llm_brute import awkward, empty  # noqa: F401

SPACE = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(texts, least):
    lists = [(t or "").split("\n") for t in texts]
    keys = [[lower(x.strip(SPACE)) for x in lines] for lines in lists]
    count = {}
    for own in keys:
        for k in set(own):
            count[k] = count.get(k, 0) + 1
    out = []
    for lines, own in zip(lists, keys):
        kept = [x for x, k in zip(lines, own) if not k or count[k] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _texts(seed, n=300):
    rng = random.Random(seed)
    pool = [f"line {k}" for k in range(200)] + ["Licence", " licence\t", "LICENCE", "", "  ", "\x1c", "Ä", "ä", "é\x85"]
    texts = ["\n".join(rng.choice(pool[: 2 + rng.randrange(len(pool))] if rng.random() < 0.6 else pool[200:]) for _ in range(rng.randrange(9))) for _ in range(n)]
    return texts + [None, "", "\n", "\r\n", "licence", "x" * 300_000 + "\nlicence\n" + "y" * 10]


@pytest.mark.parametrize("least,batches,sent", [(10, 8, 1 << 18), (10, 5, 0), (2, 1, 3), (40, 3, 1 << 18)])
def test_both_ways_match_brute_force(spark, least, batches, sent):
    texts = _texts(least)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = ld.dedup_lines(docs, least, batches, sent_keys=sent).collect()
    want = brute(texts, least)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_lines, r.n_dropped, r.text) == want[r.doc_id]


def test_runs_are_merged_in_levels_without_a_shuffle(spark):
    docs = spark.createDataFrame([(i, f"a{i % 7}\nb{i % 3}\nc{i}") for i in range(80)], "doc_id LONG, text STRING")
    counts = ld.line_counts(docs, 5).cache()
    runs = ld.LineRuns(spark, 3, 10)
    sizes = []
    for number in range(5):
        runs.add(counts.where(F.col("batch") == number))
        sizes.append(len(runs.runs()))
    assert sizes == [1, 1, 2, 1, 2]  # the ones of 1, 2, 3, 4, 5 in binary
    plan = runs.merged(*runs.runs())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plan = runs.unknown(counts.where("batch = 0"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("hashpartitioning(h1") == 1  # the batch's own
    assert {tuple(r) for r in runs.common().collect()} == {
        tuple(int(x) for x in ld._digests([k.encode()])[0]) for k in [f"a{i}" for i in range(7)] + [f"b{i}" for i in range(3)]}
    runs.drop()


def test_awkward_rows_and_the_query(spark, awkward, empty, tmp_path):
    clash = awkward.withColumns({"n_lines": F.lit("z"), "_made": F.lit(1)}).drop("_made")
    rows = ld.dedup_lines(clash, 2)
    assert rows.count() == awkward.count() and set(awkward.columns) | {"n_lines", "n_dropped"} == set(rows.columns)
    assert ld.dedup_lines(empty).count() == 0
    texts = _texts(5) + ["same\nHEAD"] * 12
    spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    want = brute(texts, 10)
    for r in QUERIES["op13_linededup"](spark, str(tmp_path)).collect():
        lines, dropped, text = want[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (lines, dropped, hashlib.sha256(text.encode()).hexdigest())
