"""Lines that many documents share: levelled sorted runs of line keys, and the texts without those lines.

Documents come in batches. A batch's lines are counted by key, keys that a run already knows as common are
taken out by a merge anti-join, and the rest becomes a sorted run of its own. Two runs of one level are merged
into one of the next, so there are about log2(batches) runs at any time and a key is written as often. Runs are
tables bucketed and sorted by key in the shared folder: only a batch is ever shuffled, never a run.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrank.llm.common import SPACE, by_bytes
from tallyrank.session import shared_folder, written

#: Keys of a bucket that a run is cut into, and most buckets of a run (beyond it buckets grow and spill).
BUCKET_KEYS, MOST_BUCKETS = 250_000, 4096
#: Common keys that are sent to every executor (16 bytes each); more of them are joined instead.
SENT_KEYS = 1 << 18
#: Batches that one table is cut into, and in how many documents a line is common.
BATCHES, LEAST = 8, 10
KEY = ["h1", "h2"]
_STRIPPED = SPACE.encode()


def _keys(text: bytes) -> list[bytes]:
    """The key of every line: stripped at both ends, A-Z in lower case."""
    return [line.strip(_STRIPPED) for line in text.lower().split(b"\n")]


def _digests(keys: list[bytes]) -> np.ndarray:
    """128 bits of each key as two signed numbers."""
    joined = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(joined, ">i8").astype(np.int64).reshape(-1, 2)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def line_counts(docs: DataFrame, batches: int = 1, text: str = "text") -> DataFrame:
    """(batch, h1, h2, n): in how many rows of ``docs`` a line key stands, by batch.

    Every row is a document, equal rows too; a line counts once in a document, empty keys not at all. Equal
    texts fall in one batch. Keys are counted in slices of some MB before anything is shuffled, so a line of
    every document is a few rows a task.
    """

    def run(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bytes(arrived):
            counts: dict[int, Counter] = defaultdict(Counter)
            for number, line in zip(rows.column("batch").to_pylist(), _texts(rows.column("text")), strict=True):
                counts[number].update(set(_keys(line)))
            for number, found in counts.items():
                found.pop(b"", None)
                h = _digests(list(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), number, np.int32)), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(list(found.values()), pa.int64())],
                    ["batch", "h1", "h2", "n"])

    dealt = docs.select(F.pmod(F.xxhash64(docs[text]), F.lit(batches)).cast("int").alias("batch"), docs[text].alias("text"))
    counted = dealt.mapInArrow(run, "batch int, h1 bigint, h2 bigint, n bigint")
    return counted.groupBy("batch", *KEY).agg(F.sum("n").alias("n"))


class LineRuns:
    """Runs (h1, h2, n) by level. ``n`` is exact below ``least``; a key that a run has ``least`` times is common
    and no longer counted."""

    def __init__(self, spark: SparkSession, buckets: int, least: int = LEAST):
        self.spark, self.buckets, self.least = spark, buckets, least
        self.base = f"line_runs_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.base} LOCATION '{shared_folder(spark).rstrip('/')}/{self.base}'")
        self.levels: list[str | None] = []
        self.made = 0

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"{self.base}.run{self.made}"
        rows.select(*KEY, "n").write.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def runs(self) -> list[str]:
        return [name for name in self.levels if name]

    def merged(self, a: str, b: str) -> DataFrame:
        """Two runs as one, by a merge of their buckets without a shuffle."""
        left, right = self.spark.table(a), self.spark.table(b).withColumnRenamed("n", "m")
        total = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
        return left.hint("merge").join(right, KEY, "full_outer").select(*KEY, total.alias("n"))

    def unknown(self, counts: DataFrame) -> DataFrame:
        """``counts`` without the keys that some run has as common."""
        for name in self.runs():
            common = self.spark.table(name).where(F.col("n") >= self.least).select(*KEY)
            counts = counts.join(common.hint("merge"), KEY, "left_anti")
        return counts

    def add(self, counts: DataFrame) -> None:
        """Takes the (h1, h2, n) of a new batch in as a run, and merges levels as long as one has two."""
        run = self._write(self.unknown(counts.repartition(self.buckets, *KEY)))
        for level, other in enumerate(self.levels):
            if other is None:
                self.levels[level] = run
                return
            run, self.levels[level] = self._fold(other, run), None
        self.levels.append(run)

    def _fold(self, a: str, b: str) -> str:
        run = self._write(self.merged(a, b))
        for name in (a, b):
            self.spark.sql(f"DROP TABLE {name}")
        return run

    def common(self) -> DataFrame:
        """(h1, h2) of all common keys, after what is left was merged to one run."""
        while len(names := self.runs()) > 1:
            self.levels = [self._fold(names[0], names[1]), *names[2:]]
        rows = self.spark.table(self.runs()[0]) if self.runs() else self.spark.createDataFrame([], "h1 bigint, h2 bigint, n bigint")
        return rows.where(F.col("n") >= self.least).select(*KEY)

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.base} CASCADE")


def common_lines(docs: DataFrame, least: int = LEAST, batches: int = BATCHES, text: str = "text") -> DataFrame:
    """(h1, h2): keys of the lines found in at least ``least`` rows, as a written table. Null texts have no line key.
    The table is read once and its batches are fed to the runs one by one."""
    spark = docs.sparkSession
    counts = written(line_counts(docs, batches, text), "line-counts")
    runs = LineRuns(spark, min(MOST_BUCKETS, max(1, -(-counts.count() // BUCKET_KEYS))), least)
    for number in range(batches):
        runs.add(counts.where(F.col("batch") == number))
    found = written(runs.common(), "common-lines")
    runs.drop()
    return found


def _without(texts: list[bytes], common) -> pa.StructArray:
    """The texts without the lines that ``common(row, keys)`` marks, and how many lines they had and lost."""
    kept, lines, dropped = [], [], []
    for row, text in enumerate(texts):
        parts = text.split(b"\n")
        gone = common(row, _keys(text))
        lines.append(len(parts))
        dropped.append(sum(gone))
        kept.append(b"\n".join([p for p, g in zip(parts, gone, strict=True) if not g]) if dropped[-1] else text)
    whole = pa.array(kept, pa.binary()).view(pa.string())
    return pa.StructArray.from_arrays([whole, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["text", "n_lines", "n_dropped"])


_MADE = "text string, n_lines bigint, n_dropped bigint"


def drop_lines(docs: DataFrame, common: DataFrame, text: str = "text", sent_keys: int = SENT_KEYS) -> DataFrame:
    """``docs`` without the lines whose key is in ``common`` (distinct h1, h2), with n_lines (before) and n_dropped.

    Null and empty texts are one empty line, which stays; a text that loses all its lines is empty. Columns that
    are called n_lines or n_dropped are replaced, all others and repeated rows stay. Up to ``sent_keys`` common keys
    go to the executors and texts are not shuffled. Beyond that the keys of each distinct text are joined with
    them, and texts with their own common keys, of which there are no more than a text has lines.
    """
    docs = docs.drop("n_lines", "n_dropped")
    if common.count() <= sent_keys:
        known = frozenset((r.h1, r.h2) for r in common.collect())

        @F.arrow_udf(_MADE)
        def strip(column: pa.Array) -> pa.Array:
            texts = _texts(column)

            def gone(row: int, keys: list[bytes]) -> list[bool]:
                return [bool(k) and tuple(h) in known for k, h in zip(keys, _digests(keys).tolist(), strict=True)]

            return _without(texts, gone)

        made = docs.withColumn("_made", strip(docs[text]))
    else:
        own = {"t1": F.xxhash64(docs[text]), "t2": F.xxhash64(F.lit(1), docs[text])}

        def spread(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in by_bytes(arrived):
                lists = [list({k for k in _keys(t) if k}) for t in _texts(rows.column("text"))]
                which = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                h = _digests([k for x in lists for k in x])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("t1").take(pa.array(which)), rows.column("t2").take(pa.array(which)), pa.array(h[:, 0]), pa.array(h[:, 1])],
                    ["t1", "t2", "h1", "h2"])

        asked = docs.select(*(c.alias(n) for n, c in own.items()), docs[text].alias("text"))
        lines = asked.mapInArrow(spread, "t1 bigint, t2 bigint, h1 bigint, h2 bigint").distinct()
        hits = lines.join(common, KEY, "left_semi").groupBy("t1", "t2").agg(F.collect_list(F.struct(*KEY)).alias("_hits"))
        hits = hits.withColumnsRenamed({"t1": "_t1", "t2": "_t2"})

        @F.arrow_udf(_MADE)
        def strip(column: pa.Array, hits: pa.Array) -> pa.Array:
            found = [{(h["h1"], h["h2"]) for h in x or ()} for x in hits.to_pylist()]

            def gone(row: int, keys: list[bytes]) -> list[bool]:
                if not found[row]:
                    return [False] * len(keys)
                return [bool(k) and tuple(h) in found[row] for k, h in zip(keys, _digests(keys).tolist(), strict=True)]

            return _without(_texts(column), gone)

        joined = docs.join(hits, (own["t1"] == F.col("_t1")) & (own["t2"] == F.col("_t2")), "left")
        made = joined.withColumn("_made", strip(joined[text], F.col("_hits"))).drop("_t1", "_t2", "_hits")
    return made.withColumns({text: F.col("_made.text"), "n_lines": F.col("_made.n_lines"), "n_dropped": F.col("_made.n_dropped")}).drop("_made")


def dedup_lines(docs: DataFrame, least: int = LEAST, batches: int = BATCHES, text: str = "text", sent_keys: int = SENT_KEYS) -> DataFrame:
    """``docs`` without the lines found in at least ``least`` documents, with n_lines and n_dropped (see ``drop_lines``).
    An empty table gives an empty table."""
    return drop_lines(docs, common_lines(docs, least, batches, text), text, sent_keys)
