import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyrank.operators.ranking import dense_index, position, previous_value, running_total, top_k
from tallyrank.operators.relational import catalogue_positions, expand_runs, unseen_runs


def _frame(spark):
    random.seed(4)
    rows = [("hot" if random.random() < 0.5 else f"u{random.randrange(20)}", random.randrange(1000), k) for k in range(600)]
    return rows, spark.createDataFrame(rows, "g STRING, t LONG, k LONG")


def _expr(bucket):
    return F.expr(bucket) if bucket else None


@pytest.mark.parametrize("bucket", [None, "floor(t / 50)"])
def test_position_equals_row_number(spark, bucket):
    rows, df = _frame(spark)
    got = position(df, ["g"], [F.col("t"), F.col("k")], _expr(bucket), "pos", "n").toPandas()
    want = pd.DataFrame(rows, columns=["g", "t", "k"]).sort_values(["t", "k"])
    want["pos"] = want.groupby("g").cumcount()
    want["n"] = want.groupby("g").k.transform("size")
    merged = got.merge(want, on="k")
    assert len(merged) == 600
    assert (merged.pos_x == merged.pos_y).all() and (merged.n_x == merged.n_y).all()


@pytest.mark.parametrize("bucket", [None, "floor(t / 50)"])
def test_running_total_and_previous(spark, bucket):
    rows, df = _frame(spark)
    totals = running_total(df, ["g"], [F.col("t"), F.col("k")], _expr(bucket), "t", "s").toPandas()
    want = pd.DataFrame(rows, columns=["g", "t", "k"]).sort_values(["t", "k"])
    want["s"] = want.groupby("g").t.cumsum()
    merged = totals.merge(want, on="k")
    assert (merged.s_x == merged.s_y).all()
    single = df.select("g", "t").distinct()
    lagged = previous_value(single, ["g"], "t", _expr(bucket), "p", -1).toPandas()
    base = pd.DataFrame(rows, columns=["g", "t", "k"])[["g", "t"]].drop_duplicates().sort_values("t")
    base["p"] = base.groupby("g").t.shift(1).fillna(-1).astype(int)
    both = lagged.merge(base, on=["g", "t"])
    assert len(both) == len(base) and (both.p_x == both.p_y).all()


def test_dense_index_on_common_prefixes(spark):
    names = [f"Customer#{k:09d}" for k in range(500)]
    got = dense_index(spark.createDataFrame([(n,) for n in names], "v STRING"), "v").collect()
    assert sorted((r.v, r.idx) for r in got) == [(n, k) for k, n in enumerate(names)]


def test_top_k_ranks_are_dense(spark):
    _rows, df = _frame(spark)
    got = top_k(df, ["g"], [F.desc("t"), F.asc("k")], 3).toPandas()
    assert got.groupby("g")["rank"].apply(lambda r: sorted(r) == list(range(1, len(r) + 1))).all()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 11)), min_size=1, max_size=30))
def test_unseen_runs_are_the_complement(spark, pairs):
    seen = spark.createDataFrame(sorted(set(pairs)), "user_id LONG, item_id LONG")
    items = spark.range(12).withColumnRenamed("id", "item_id")
    index, _ = catalogue_positions(seen, items)
    got = {(r.user_id, r.item_id) for r in expand_runs(unseen_runs(seen, items, 4), index).collect()}
    users = {u for u, _ in pairs}
    assert got == {(u, i) for u in users for i in range(12)} - set(pairs)
