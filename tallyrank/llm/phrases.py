"""Phrases that hold together: word pairs counted in direct-addressed tiles, and longer phrases as pairs of pairs.

The commonest words get numbers by frequency rank. A text becomes a row of numbers; two neighbours are a cell of
a rank x rank matrix that is cut into square tiles. Tiles of the commonest ranks are arrays that
``bincount`` adds to; all other tiles are sorted coordinates with counts. Frequent pairs are ranked
again, two overlapping pairs are a phrase of three words, and so on, always with the same counter.

Numbers given by rank are bounded (``HEAD``), so the tables that tasks look them up in are too. Where more
symbols than that are frequent, the others go by a 64-bit hash, in the sorted coordinates: exact as well
(but for a collision of such hashes), and rare by Zipf's law. A bit table of fixed size (``BITS``) tells most symbols
that are not frequent from those; what it lets through is counted and found to be rare.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import by_bytes
from tallyrank.operators.ranking import position
from tallyrank.session import written

#: Occurrences that a phrase needs, words of the longest phrase, and rows of each language's report.
LEAST, LONGEST, ROWS = 30, 4, 2000
#: 100 * f(longer) >= COVERED * f(phrase) drops a phrase.
COVERED = 80
#: Symbols of one length that are numbered by rank.
HEAD = 1 << 18
#: Bits of the table of frequent symbols without a rank.
BITS = 1 << 26
#: Ranks along a tile's side, and tiles along the side of the square that is kept as arrays.
TILE, DENSE = 1024, 4
#: Pairs that a task collects outside that square before it counts them, and pairs that one bucket of the others gets on average.
BUFFER, BUCKET_PAIRS = 1 << 20, 1 << 21
#: Entries of one row of counts, and rows of counts that one task adds up before another task takes over.
ROW_ENTRIES, ROWS_TOGETHER = 4096, 16_384
#: Not a symbol: the border of a piece, or a word or phrase that is not frequent.
CUT = np.iinfo(np.int64).min
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_BORDER = b"\xff"


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case, and a border, which no text holds, between two pieces."""
    return text.lower().translate(_PIECES).replace(b"\n", b" \xff ").split()


def _hashed(lang: str, word: bytes) -> int:
    """A negative number, not CUT, for a word that has no rank."""
    return (xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\x00" + word) >> 1 | 1) - (1 << 63)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for pairs of symbols."""
    x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x | np.uint64(1 << 63)) | np.uint64(1)).view(np.int64)


def _bits(symbols: DataFrame) -> np.ndarray | None:
    """A bit for each hashed ``id``, or None where there is none. Its size is fixed, whatever the rows."""
    place = F.shiftright("id", 8).bitwiseAND(F.lit(BITS - 1))
    words = symbols.where(F.col("id") < 0).select(
        F.shiftright(place, 6).alias("w"), F.expr("shiftleft(1L, cast(shiftright(id, 8) & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    if not words.num_rows:
        return None
    out = np.zeros(BITS // 64, np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out


def _known(bits: np.ndarray | None, ids: np.ndarray) -> np.ndarray:
    """``ids``, with CUT where a hashed one has no bit."""
    if bits is None:
        return np.full(len(ids), CUT)
    place = ids >> 8 & BITS - 1
    return np.where(bits[place >> 6] >> (place & 63) & 1, ids, CUT)


class Words:
    """Numbers of the words of each language: ranks, then hashes of those that ``bits`` lets through."""

    def __init__(self, ranked: list[tuple[str, str]]):
        self.bits: np.ndarray | None = None
        self.ranks: dict[str, dict[bytes, int]] = defaultdict(dict)
        for rank, (lang, word) in enumerate(ranked):
            self.ranks[lang][word.encode("utf-8", "surrogatepass")] = rank

    def numbers(self, lang: str, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.ranks.get(lang, {}).get, words, repeat(CUT)), np.int64, len(words))
        if self.bits is not None:
            rest = [i for i in np.flatnonzero(out == CUT).tolist() if words[i] != _BORDER]
            out[rest] = _known(self.bits, np.array([_hashed(lang, words[i]) for i in rest], np.int64))
        return out


class Pairs:
    """Numbers of pairs of symbols, likewise."""

    def __init__(self, ranked: list[tuple[int, int]]):
        keys = np.array([a << 32 | b for a, b in ranked], np.int64)
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        self.bits: np.ndarray | None = None

    def numbers(self, a: np.ndarray, b: np.ndarray, every: bool = False) -> np.ndarray:
        """With ``every``, all pairs are known to be frequent."""
        out = _mixed(a, b) if every else _known(self.bits, _mixed(a, b)) if self.bits is not None else np.full(len(a), CUT)
        out[(a == CUT) | (b == CUT)] = CUT
        ranked = np.flatnonzero((a >= 0) & (b >= 0))
        if len(self.keys) and len(ranked):
            key = a[ranked] << 32 | b[ranked]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[ranked[hit]] = self.ranks[at[hit]]
        return out


def summed(a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (a, b) in order with the sum of their counts."""
    if len(a) == 0:
        return a, b, np.zeros(0, np.int64)
    if min(a.min(), b.min()) >= 0:
        key = a << 32 | b
        if n is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        left, right = key[new] >> 32, key[new] & 0xFFFFFFFF
    else:
        order = np.lexsort((b, a))
        left, right = a[order], b[order]
        new = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
        left, right = left[new], right[new]
    return left, right, np.diff(np.append(new, len(a))) if n is None else np.add.reduceat(n[order], new)


_PARTS = pa.schema([("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("n", pa.binary())])
_PARTS_DDL = "part int, a binary, b binary, n binary"
_SQUARE = TILE * DENSE


def _part_rows(part: int, a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    cut = range(0, len(a), ROW_ENTRIES)
    pieces = [[x[i : i + ROW_ENTRIES].tobytes() if x is not None else b"" for i in cut] for x in (a, b, n)]
    return pa.RecordBatch.from_arrays([pa.array([part] * len(cut), pa.int32()), *(pa.array(p, pa.binary()) for p in pieces)], schema=_PARTS)


class Tiles:
    """Counts of one task: arrays for the tiles of the commonest ranks, sorted coordinates in buckets for all others."""

    def __init__(self, buckets: int):
        self.buckets, self.dense = buckets, {}
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.added = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        near = (a >= 0) & (b >= 0) & (a < _SQUARE) & (b < _SQUARE)
        x, y = a[near], b[near]
        tile, code = x // TILE * DENSE + y // TILE, x % TILE * TILE + y % TILE
        for t in np.flatnonzero(np.bincount(tile, minlength=1)):
            cells = self.dense.setdefault(t, np.zeros(TILE * TILE, np.int32))
            cells += np.bincount(code[tile == t], minlength=TILE * TILE).astype(np.int32)
        self.added += len(x)
        if self.added >= 1 << 30:  # long before a cell is full
            yield from self.finish()
        self.waiting.append((a[~near], b[~near]))
        self.size += len(a) - len(x)
        if self.size >= BUFFER:
            yield from self.sparse()

    def sparse(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            a, b, n = summed(*(np.concatenate(x) for x in zip(*self.waiting, strict=True)))
            self.waiting, self.size = [], 0
            # a tile goes to one bucket as a whole, a pair with a hashed member by its own hash
            bucket = (_mixed(np.where(a < 0, a, a // TILE), np.where(b < 0, b, b // TILE)) >> 8) % self.buckets
            order = np.argsort(bucket, kind="stable")
            found, starts = np.unique(bucket[order], return_index=True)
            for k, rows in zip(found, np.split(order, starts[1:]), strict=True):
                yield _part_rows(DENSE * DENSE + int(k), a[rows], b[rows], n[rows])

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.sparse()
        for t, cells in self.dense.items():
            code = np.flatnonzero(cells)
            yield _part_rows(int(t), code.astype("<u4"), None, cells[code].astype(np.int64))
        self.dense, self.added = {}, 0


class _Sum:
    """Counts of one part from many rows."""

    def __init__(self, part: int):
        self.part, self.held, self.size = part, [], 0
        self.cells = np.zeros(TILE * TILE, np.int64) if part < DENSE * DENSE else None

    def add(self, a: bytes, b: bytes, n: bytes) -> None:
        counts = np.frombuffer(n, np.int64)
        if self.cells is not None:
            self.cells[np.frombuffer(a, "<u4")] += counts  # the codes of one row are distinct
            return
        self.held.append((np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), counts))
        self.size += len(counts)
        if self.size > 2 * BUFFER:
            self.held = [self.reduced()]
            self.size = min(len(self.held[0][0]), BUFFER)

    def reduced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))

    def pairs(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, n) of the pairs counted at least so often."""
        if self.cells is None:
            a, b, n = self.reduced()
            kept = n >= least
            return a[kept], b[kept], n[kept]
        code = np.flatnonzero(self.cells >= least)
        return self.part // DENSE * TILE + code // TILE, self.part % DENSE * TILE + code % TILE, self.cells[code]

    def rows(self) -> pa.RecordBatch:
        if self.cells is None:
            return _part_rows(self.part, *self.reduced())
        code = np.flatnonzero(self.cells)
        return _part_rows(self.part, code.astype("<u4"), None, self.cells[code])


def _add_up(parts: DataFrame, least: int, together: int) -> DataFrame:
    """(a, b, n) of all pairs counted at least ``least`` times, from rows of counts. A part with many rows is added
    up by several tasks first, again and again, so that a common tile is nobody's alone."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[_Sum]:
        key, held = None, None
        for batch in batches:
            for part, salt, a, b, n in zip(*(batch.column(c).to_pylist() for c in ("part", "salt", "a", "b", "n")), strict=True):
                if (part, salt) != key:
                    if held:
                        yield held
                    key, held = (part, salt), _Sum(part)
                held.add(a, b, n)
        if held:
            yield held

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in sums(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held.pairs(least)], ["a", "b", "n"])

    salts = None
    while True:
        largest = parts.groupBy("part").count().agg(F.max("count")).first()[0] or 0
        # rows of one part may all be distinct, so the number of tasks is halved at least
        salts = max(1, min(-(-largest // together), largest if salts is None else salts // 2))
        dealt = parts.withColumn("salt", F.pmod(F.xxhash64("a", "n"), F.lit(salts)))
        sorted_ = dealt.repartition("part", "salt").sortWithinPartitions("part", "salt")
        if salts == 1:
            return written(sorted_.mapInArrow(last, "a bigint, b bigint, n bigint"), "pairs")
        parts = written(sorted_.mapInArrow(lambda batches: (held.rows() for held in sums(batches)), _PARTS_DDL), "part-counts")


def _und(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(docs[text].alias("text"), F.coalesce(docs[lang], F.lit("und")).alias("lang"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    for rows in by_bytes(batches):
        yield rows.column("lang").to_pylist(), [t or b"" for t in rows.column("text").cast(pa.binary()).to_pylist()]


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) of all words of all texts, counted in slices of some MB before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _slices(batches):
            counts: dict[str, Counter] = defaultdict(Counter)
            for own, t in zip(langs, texts, strict=True):
                counts[own].update(tokens(t))
            for own, found in counts.items():
                found.pop(_BORDER, None)
                words = pa.array(list(found), pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(found), pa.string()), words, pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    return _und(docs, text, lang).mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, words: Words, pairs: list[Pairs], buckets: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of counts of neighbouring symbols, which are words and then, through ``pairs``, phrases of more words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(buckets)
        for langs, texts in _slices(batches):
            border = np.array([CUT])
            symbols = np.concatenate([x for own, t in zip(langs, texts, strict=True) for x in (words.numbers(own, tokens(t)), border)])
            for level in pairs:
                symbols = level.numbers(symbols[:-1], symbols[1:])
            a, b = symbols[:-1], symbols[1:]
            both = (a != CUT) & (b != CUT)
            yield from tiles.add(a[both], b[both])
        yield from tiles.finish()

    return _und(docs, text, lang).mapInArrow(run, _PARTS_DDL)


def _head(rows: DataFrame, order: list[str], least: int, head: int) -> list[tuple]:
    """At most ``head`` of the most frequent rows, by falling n, then ``order``."""
    while (kept := rows.where(F.col("n") >= least)).count() > head:
        least *= 2
    found = kept.select(F.negate("n").alias("n"), *order).toArrow()
    return [r[1:] for r in sorted(zip(*(c.to_pylist() for c in found.columns), strict=True))]


def _numbered(rows: DataFrame, numbers, columns: list[str]) -> DataFrame:
    """``rows`` with the number of each symbol as ``id``."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema = f"id bigint, {kinds}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = numbers(*(batch.column(c) for c in columns))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *batch.columns], ["id", *batch.schema.names])

    return rows.mapInArrow(run, schema)


def _score() -> Column:
    """(score, cut, l, r) of the cut with the lowest score, the earliest of equals; decimals hold what 64 bits would not."""
    return F.expr("""array_min(transform(sequence(1, size(pre) - 1), k -> named_struct(
        'score', (CAST(2000000 AS DECIMAL(7, 0)) * CAST(n AS DECIMAL(20, 0)))
                 div (CAST(pre[k - 1] AS DECIMAL(20, 0)) + CAST(suf[size(pre) - k - 1] AS DECIMAL(20, 0))),
        'cut', k, 'l', pre[k - 1], 'r', suf[size(pre) - k - 1])))""")


def mine_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, rows: int = ROWS, text: str = "text", lang: str = "lang",
    head: int = HEAD, together: int = ROWS_TOGETHER,
) -> DataFrame:
    """The ``rows`` strongest phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line breaks, pieces into words at blanks and
    tabs. A phrase is 2 to ``longest`` words of one piece that occur at least ``least`` times (a), overlaps
    included. Its score is the least of floor(2000000 a / (l + r)) over its cuts in two, l and r being how often the
    two sides occur; the earliest of equal cuts counts. Phrases inside a longer one with 100 f(longer) >= 80 a are
    dropped. Ranks go by score, then a, both falling, then the phrase's bytes. ``n`` counts all words of the language.
    A null text is empty, a null language is ``und``, equal rows all count, other columns are not read; an
    empty table gives an empty table. The texts are read once for each phrase length; nothing of their size is
    written or shuffled.
    """
    counts = written(word_counts(docs, text, lang), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("_words"))
    buckets = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // BUCKET_PAIRS))
    frequent = counts.where(F.col("n") >= least)
    words, pairs = Words(_head(frequent, ["lang", "word"], least, head)), []

    def number_words(langs: pa.Array, own: pa.Array) -> list[int]:
        each = zip(langs.to_pylist(), own.cast(pa.binary()).to_pylist(), strict=True)
        return [words.ranks[g][w] if w in words.ranks.get(g, ()) else _hashed(g, w) for g, w in each]

    symbols = written(_numbered(frequent, number_words, ["lang", "word"]).select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", F.array("n").alias("pre"), F.array("n").alias("suf")), "symbols")
    words.bits = _bits(symbols)
    levels = []
    for _ in range(longest - 1):
        found = _add_up(written(pair_counts(docs, words, pairs, buckets, text, lang), "part-counts"), least, together)
        # numbers by rank are for pairs of ranked symbols, whose key is exact
        level = Pairs(_head(found.where((F.col("a") >= 0) & (F.col("b") >= 0)), ["a", "b"], least, head))
        ids = _numbered(found, lambda a, b, level=level: level.numbers(a.to_numpy(), b.to_numpy(), True), ["a", "b"]).withColumnRenamed("n", "m")
        left = symbols.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("_p"), F.col("pre").alias("_pre"))
        right = symbols.select(F.col("id").alias("b"), "last", F.col("suf").alias("_suf"))
        symbols = written(ids.join(left, "a").join(right, "b").select(
            "id", "a", "b", "lang", F.concat_ws(" ", "_p", "last").alias("phrase"), "last", F.col("m").alias("n"),
            F.array_append("_pre", F.col("m")).alias("pre"), F.array_append("_suf", F.col("m")).alias("suf")), "symbols")
        level.bits = _bits(symbols)
        levels.append(symbols)
        pairs.append(level)
    kept = None
    for level, longer in zip(levels, [*levels[1:], None], strict=True):
        # what holds a phrase of k words holds one of k + 1 words around it, which is as frequent
        if longer is not None:
            around = longer.select(F.explode(F.array("a", "b")).alias("id"), F.col("n").alias("_n")).groupBy("id").agg(F.max("_n").alias("_n"))
            wide = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by)
            level = level.join(around, "id", "left").where(F.col("_n").isNull() | (wide("_n", 100) < wide("n", COVERED)))
        level = level.select("lang", "phrase", F.col("n").alias("a"), _score().alias("_s"))
        kept = level if kept is None else kept.unionByName(level)
    scored = kept.select("lang", "phrase", "a", "_s.l", "_s.r", "_s.score")
    placed = position(scored, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], name="rank")
    first = placed.where(F.col("rank") < rows).withColumn("rank", F.col("rank") + 1)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("_words").alias("n"), "score")
