import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tallyrank.functions.arrays import mask_of, pad_to
from tallyrank.operators import sampling as sp, sequences as sq, splits
from tallyrank.operators.relational import history_chunks, item_popularity


def _log(spark, seed=3):
    random.seed(seed)
    rows = {(0 if random.random() < 0.5 else random.randrange(1, 8), random.randrange(60)) for _ in range(250)}
    return sorted((u, i, float(1 + i % 5), random.Random(u * 100 + i).randrange(10**6)) for u, i in rows)


@pytest.fixture(scope="module")
def log(spark):
    rows = _log(spark)
    return rows, spark.createDataFrame(rows, "user_id LONG, item_id LONG, rating DOUBLE, ts LONG").cache()


def _history(rows, user):
    return [i for _u, i, _r, _t in sorted((r for r in rows if r[0] == user), key=lambda r: (r[3], r[1]))]


@pytest.mark.parametrize("block", [3, 5, 4096])
def test_recent_histories_across_blocks(log, block):
    rows, df = log
    got = sq.recent_histories(df, ["item_id"], 3, block).collect()
    assert len(got) == len(rows)
    for r in got:
        mine = _history(rows, r.user_id)
        assert r.n == len(mine) and mine[r.pos] == r.item_id
        assert r.hist_item_id == mine[max(0, r.pos - 3):r.pos][::-1]


@pytest.mark.parametrize("chunk,length", [(7, None), (7, 10), (3, 1), (100, 0)])
def test_pointers_are_read_into_histories(log, chunk, length):
    rows, df = log
    samples = sq.sample_pointers(df)
    assert samples.count() == len(rows) - len({r[0] for r in rows})
    parts = {}
    for r in sq.read_histories(samples, history_chunks(df, ["item_id"], chunk), chunk, length).collect():
        assert len(r.hist) <= chunk
        parts[(r.user_id, r.pos, r.part)] = r.hist
    for r in samples.collect():
        mine = _history(rows, r.user_id)
        assert mine[r.pos] == r.item_id and r.split == ("test" if r.pos == len(mine) - 1 else "train")
        want = mine[max(0, r.pos - length) if length is not None else 0:r.pos][::-1]
        got, part = [], 0
        while (r.user_id, r.pos, part) in parts:
            got += parts[(r.user_id, r.pos, part)]
            part += 1
        assert got == want


def test_negatives_point_to_the_same_history(spark, log):
    rows, df = log
    samples = sq.sample_pointers(df)
    items = spark.createDataFrame([(i,) for i in range(80)], "item_id LONG")
    negatives = sp.sample_negatives(samples.where("split = 'train'"), df, items, 2, distinct=False)
    found = sq.with_negatives(samples, negatives).collect()
    by_place = {}
    for r in found:
        by_place.setdefault((r.user_id, r.pos), []).append(r)
    for (user, _pos), group in by_place.items():
        kept = [r for r in group if r.label == 1]
        assert len(kept) == 1 and kept[0].draw == 0 and {r.hist_len for r in group} == {kept[0].pos}
        missed = [r for r in group if r.label == 0]
        assert len(missed) == (2 if kept[0].split == "train" else 0) and all(r.rating is None for r in missed)
        assert not {r.item_id for r in missed} & set(_history(rows, user))


def test_history_chunks_are_whole(log):
    rows, df = log
    parts = sorted((r.user_id, r.part, r.item_id) for r in history_chunks(df, ["item_id"], 7).collect())
    for user in {r[0] for r in rows}:
        joined = [i for u, _p, items in parts if u == user for i in items]
        assert joined == _history(rows, user)
        assert all(len(items) <= 7 for u, _p, items in parts if u == user)


def test_exclude_target_swaps_in_the_last_item(log):
    rows, df = log
    targets = splits.random_items(df)
    held = {r.user_id: r.item_id for r in targets.collect()}
    parts = sq.exclude_target(df, targets, F.lit(999), 10).collect()
    for user, target in held.items():
        mine = _history(rows, user)
        place = mine.index(target)
        mine[place] = mine[-1]
        mine[-1] = 999
        got = [i for r in sorted((p for p in parts if p.user_id == user), key=lambda p: p.part) for i in r["items"]]
        assert got[:len(mine)] == mine and set(got[len(mine):]) <= {999}


def test_pad_and_mask(spark):
    row = spark.createDataFrame([([1, 2, 3],), ([],)], "a ARRAY<BIGINT>").select(
        pad_to("a", 2).alias("short"), pad_to("a", 5).alias("long"), mask_of("a", 5).alias("mask")).collect()
    assert row[0].short == [1, 2] and row[0].long == [1, 2, 3, 0, 0] and row[0].mask == [1, 1, 1, 0, 0]
    assert row[1].short == [0, 0] and row[1].mask == [0] * 5


@pytest.mark.parametrize("catalogue", [62, 400])
def test_negatives_are_unseen_distinct_and_complete(spark, catalogue):
    random.seed(6)
    rows = [(1, i) for i in range(58)] + [(2, i) for i in range(3)]  # user 1 has seen nearly all of the small one
    seen = spark.createDataFrame(rows, "user_id LONG, item_id LONG")
    items = spark.range(catalogue).withColumnRenamed("id", "item_id")
    got = sp.sample_negatives(seen, seen, items, 5).collect()
    unseen = {1: catalogue - 58, 2: catalogue - 3}
    known = set(rows)
    for u, i in rows:
        negs = [r.neg for r in got if (r.user_id, r.item_id) == (u, i)]
        assert len(negs) == len(set(negs)) == min(5, unseen[u])
        assert all((u, n) not in known for n in negs)
        ranks = sorted(r["rank"] for r in got if (r.user_id, r.item_id) == (u, i))
        assert ranks == list(range(1, len(negs) + 1))


def test_recent_histories_without_windows_over_rows(spark):
    rows = [(u, i, float(i), i, None if i % 4 == 0 else f"c{i}") for u in range(3) for i in range(40 if u else 1)]
    df = spark.createDataFrame(rows, "user_id LONG, item_id LONG, rating DOUBLE, ts LONG, category STRING")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # histories go on from batch to batch
    try:
        got = sq.recent_histories(df, ["item_id", "category"], 6, 16)
        # a frame of rows before each row makes every row cost its whole history
        assert "rowframe" not in got._jdf.queryExecution().optimizedPlan().toString().lower().replace("rowframe, unboundedpreceding", "")
        found = got.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.user_id, r.pos) for r in found) == sorted((u, i) for u, i, *_ in rows)
    for r in found:
        before = range(r.pos - 1, max(r.pos - 7, -1), -1)
        assert r.hist_item_id == list(before) and r.hist_category == [f"c{i}" for i in before if i % 4]


@pytest.mark.parametrize("distinct", [True, False])
def test_negatives_are_the_first_good_draws_at_every_cell_size(spark, distinct):
    random.seed(8)
    rows = [(u, i) for u in range(4) for i in random.sample(range(40), 30 if u == 0 else 6)]
    known, catalogue = set(rows), 40

    def draws(u, i, last):
        return [int(md5(f"{u}-{i}-{t}".encode()).hexdigest()[:8], 16) % catalogue for t in range(last)]

    want = {}
    for u, i in rows:
        good = [p for p in draws(u, i, 4 * 3 + 32) if (u, p) not in known]
        want[u, i] = (list(dict.fromkeys(good)) if distinct else good)[:3]
    assert all(len(x) == 3 for x in want.values())
    seen = spark.createDataFrame(rows, "user_id LONG, item_id LONG")
    items = spark.range(catalogue).withColumnRenamed("id", "item_id")
    for cell_rows in (4, 1 << 17):  # user 0 is dealt to copies, or all are one cell
        got = {}
        for r in sp.sample_negatives(seen, seen, items, 3, distinct, cell_rows).orderBy("rank").collect():
            got.setdefault((r.user_id, r.item_id), []).append(r.neg)
        assert got == want


def test_newest_history_sends_each_sample_once(spark):
    df = spark.createDataFrame([(1, i, 1.0, i) for i in range(90)], "user_id LONG, item_id LONG, rating DOUBLE, ts LONG")
    pointers, chunks = sq.sample_pointers(df), history_chunks(df, ["item_id"], 7)
    rows = sq.read_histories(pointers, chunks, 7, 12)
    got = {}
    for r in rows.orderBy("part").collect():
        got.setdefault(r.pos, []).extend(r.hist)
    assert got == {p: list(range(p - 1, max(p - 13, -1), -1)) for p in range(1, 90)}
    # parts are copied and samples are not: the only exploded list is one of the parts
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "_newest" in plan[plan.index("Generate explode"):].split("\n")[0]


def test_unigram_draws_follow_the_power_law(spark):
    counts = {0: 810, 1: 160, 2: 16}
    rows = [(k, item) for item, n in counts.items() for k in range(n)]
    df = spark.createDataFrame(rows, "user_id LONG, item_id LONG")
    vocab = splits.frequency_vocab(df, "item_id")
    got = sp.unigram_negatives(df, vocab, 10).groupBy("neg").count().collect()
    total = sum(n ** 0.75 for n in counts.values())
    assert sum(r["count"] for r in got) == len(rows) * 10
    for r in got:
        assert r["count"] / (len(rows) * 10) == pytest.approx(counts[r.neg] ** 0.75 / total, abs=0.02)


def test_splits_partition_the_rows(log):
    rows, df = log
    for made in (splits.split_leave_last(df), splits.split_leave_one_random(df)):
        counts = {(r.user_id, r.split): r["count"] for r in made.groupBy("user_id", "split").count().collect()}
        for user in {r[0] for r in rows}:
            assert counts[user, "test"] == 1
            assert counts.get((user, "train"), 0) == len(_history(rows, user)) - 1


def test_stratified_folds_are_balanced(spark):
    df = spark.createDataFrame([(k, k % 2) for k in range(8)], "id LONG, y INT")
    folds = splits.stratified_folds(df, "id", "y", 2).groupBy("y", "fold").count().collect()
    assert sorted((r.y, r.fold, r["count"]) for r in folds) == [(0, 0, 2), (0, 1, 2), (1, 0, 2), (1, 1, 2)]


def test_popularity(log):
    rows, df = log
    got = {r.item_id: r.popularity for r in item_popularity(df).collect()}
    assert got == {i: sum(1 for r in rows if r[1] == i) for i in {r[1] for r in rows}}
