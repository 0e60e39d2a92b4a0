"""Conversations with the fewest edits that make them alternate, by one streaming pass over sorted turns.

Rows are partitioned by conversation and sorted by turn inside partitions. A Python worker reads them in Arrow
batches and carries the state of a dynamic programme from batch to batch: four grammar states, each with its
cost, its place among equal costs and the running digest of what it would keep. What a row decided goes out as
four bytes of back pointers, in blocks, so a giant conversation is never held. Spark sorts the blocks backwards
inside the same partitions and a second pass reads the edits off them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyrank.llm.common import SPACE

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: What an undeleted truncated row adds.
TRUNCATED = 3
#: Grammar states: nothing yet, after system, after user, after assistant. A conversation may end in the first or the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that an edit can put after a state, and the state it leads to.
NEXT = {NONE: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}
#: Rows of one block of back pointers.
BLOCK_ROWS = 1 << 16
LEGAL = ("su", "ua", "au")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) as the remainder of crc32(``conv_id:turn``) by 20 damages them.

    0 drops a row, 1 empties its text, 2 takes the marks ``.!?`` out, 3 repeats it, 4 makes its role ``user``. A
    null in role, text or in the text that is hashed stands as one space; null ids and turns stay null.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(rows["conv_id"].cast("string"), blank), F.lit(":"), F.coalesce(rows["turn"].cast("string"), blank))
    case = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce(rows["role"], blank), F.coalesce(rows["text"], blank)
    out = rows.select(
        rows["conv_id"], rows["turn"], F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), case.alias("_case"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_case") == 3, 2).otherwise(1)))
    return out.where(F.col("_case") != 0).select("conv_id", "turn", "role", "text", copies.alias("_copy")).drop("_copy")


class Layer:
    """Costs and ranks of the four states after some rows, and how the next row changes them.

    A state's edits so far are those of the row before it, up to two inserts, and an edit of the row. Edits up to a
    row are never a prefix of one another, so their order is one rank per state, and equal costs are told
    apart by (rank, inserts + edit) alone. The changes depend on cost differences and ranks only, of which
    there are few, so they are kept and looked up again.
    """

    known: dict[tuple, tuple] = {}

    @staticmethod
    def step(state: tuple, kind: tuple[str, bool, bool]) -> tuple[tuple, int, tuple]:
        """From (cost, rank) of each state, or None, over a row (initial, must go, truncated) to the same after
        it, what the least cost grew by, and for each state (state before, inserts + edit), or None."""
        found = Layer.known.get((state, kind))
        if found is None:
            found = Layer.known[state, kind] = Layer._step(state, kind)
        return found

    @staticmethod
    def inserted(state: tuple) -> dict[int, tuple[int, int, str, int]]:
        """Each state with inserts before the next row: (cost, rank, inserts, state they began in)."""
        best = {s: (*state[s], "", s) for s in range(4) if state[s]}
        for target, origins in ((USER, (NONE, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            options = [(c + COST[INSERT], r, i + INSERT, o) for s in origins if s in best for c, r, i, o in [best[s]]]
            best |= {target: min([*options, *([best[target]] if target in best else [])])} if options else {}
        return best

    @staticmethod
    def _step(state: tuple, kind: tuple[str, bool, bool]) -> tuple[tuple, int, tuple]:
        initial, must_go, truncated = kind
        arrivals: dict[int, tuple] = {}

        def arrive(target: int, cost: int, rank: int, edits: str, origin: int) -> None:
            arrivals[target] = min(arrivals.get(target, (np.inf,)), (cost, rank, edits, origin))

        for s, (cost, rank, inserts, origin) in Layer.inserted(state).items():
            arrive(s, cost + COST[DELETE], rank, inserts + DELETE, origin)
            if not must_go:
                more = TRUNCATED * truncated
                arrive(NEXT[s][1], cost + COST[REROLE] + more, rank, inserts + REROLE, origin)
                if (s, initial) in AFTER:
                    arrive(AFTER[s, initial], cost + COST[KEEP] + more, rank, inserts + KEEP, origin)
        least = min(a[0] for a in arrivals.values())
        order = sorted(arrivals, key=lambda s: arrivals[s][1:3])
        state = tuple((arrivals[s][0] - least, order.index(s)) if s in arrivals else None for s in range(4))
        return state, least, tuple((arrivals[s][3], arrivals[s][2]) if s in arrivals else None for s in range(4))

    @staticmethod
    def end(state: tuple) -> tuple[int, int, str]:
        """(cost, state before the last inserts, the last inserts) of the best whole conversation."""
        best = Layer.inserted(state)
        cost, _, inserts, origin = min(best[s] for s in (NONE, ASSISTANT) if s in best)
        return cost, origin, inserts


START = ((0, 0), None, None, None)
#: Edits between two rows' ends: up to two inserts and the row's own edit. Number 0 marks a state that no edits reach.
_EDITS = ["", *(INSERT * n + e for n in range(3) for e in (KEEP, REROLE, DELETE))]
_NUMBER = {e: k for k, e in enumerate(_EDITS)}


def _packed(moves: tuple) -> int:
    """Four (state before, edits), six bits each."""
    return sum((m[0] | _NUMBER[m[1]] << 2) << 6 * s for s, m in enumerate(moves) if m)


def _extended(digest, state: int, edits: str, role: bytes, text: bytes):
    """The digest with the lines that ``edits`` leave after ``state``, for a row of this role and text."""
    digest = digest.copy()
    for edit in edits:
        if edit != DELETE:
            put, after = NEXT[state]
            line = role + b":" + text if edit == KEEP else f"{put}:".encode() + (text if edit == REROLE else b"")
            digest.update(line if state == NONE else b"\n" + line)
            state = after
    return digest


class Reader:
    """One conversation as its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost = conv_id, START, 0
        self.digests: list = [hashlib.sha256(), None, None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = None
        self.codes: list[int] = []
        self.block = 0

    def row(self, turn, role: str, text: str, repeated: bool) -> None:
        rest = text.rstrip(SPACE)
        blank = not rest
        truncated = not blank and not repeated and rest[-1] not in ".!?"
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += truncated
        self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.state, grown, moves = Layer.step(self.state, (role[:1] if role[:1] in "sua" else "", blank or repeated, truncated))
        self.cost += grown
        line = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
        self.digests = [_extended(self.digests[m[0]], *m, *line) if m else None for m in moves]
        self.codes.append(_packed(moves))

    def out(self, last: bool) -> dict:
        """The block so far; the last one of a conversation with its counts, last inserts and digest."""
        self.block += 1
        found = {"conv_id": self.conv_id, "block": self.block, "codes": np.array(self.codes, "<u4").tobytes()}
        self.codes = []
        if not last:
            return found
        cost, origin, inserts = Layer.end(self.state)
        return found | {
            "state": origin, "inserts": inserts, "gaps": self.high - self.low + 1 - self.turns if self.turns else 0, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost + cost,
            "repaired_sha256": _extended(self.digests[origin], origin, inserts, b"", b"").hexdigest()}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_SCHEMA = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("repaired_sha256", pa.string())])
_BLOCKS = pa.schema([*_SCHEMA, ("block", pa.int64()), ("codes", pa.binary()), ("state", pa.int32()), ("inserts", pa.string())])
_REPORT = pa.schema([*_SCHEMA, ("audit", pa.string())])
_DDL = ", ".join(["conv_id bigint", *(f"{c} bigint" for c in COUNTS), "repaired_sha256 string"])


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batches(found: Iterator[dict], schema: pa.Schema, limit: int = 256) -> Iterator[pa.RecordBatch]:
    while part := list(islice(found, limit)):
        yield pa.RecordBatch.from_pylist(part, schema)


def _forward(block_rows: int):
    """Sorted rows to blocks of back pointers; a conversation goes on over the borders of batches."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader = None
        for conv_id, turn, role, text, repeated in _rows(batches, "conv_id", "turn", "role", "text", "repeated"):
            if reader is None or conv_id != reader.conv_id:
                if reader is not None:
                    yield reader.out(True)
                reader = Reader(conv_id)
            elif len(reader.codes) >= block_rows:
                yield reader.out(False)
            reader.row(turn, role, text, repeated)
        if reader is not None:
            yield reader.out(True)

    return lambda batches: _batches(blocks(batches), _BLOCKS)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation, last one first, to its report: the edits are read off the back pointers."""

    def reports() -> Iterator[dict]:
        report, state, parts = None, NONE, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["state"] is not None:  # the last block of a conversation, which comes first
                    if report is not None:
                        yield report | {"audit": "".join(reversed(parts))}
                    report, state, parts = {c: row[c] for c in _SCHEMA.names}, row["state"], [row["inserts"]]
                block = []
                for code in np.frombuffer(row["codes"], "<u4")[::-1].tolist():
                    move = code >> 6 * state & 63
                    block.append(_EDITS[move >> 2])
                    state = move & 3
                parts.append("".join(reversed(block)))
        if report is not None:
            yield report | {"audit": "".join(reversed(parts))}

    return _batches(reports(), _REPORT)


def _whole(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text alone, with a space for a null role or text."""
    return rows.select(
        rows["conv_id"].cast("bigint").alias("conv_id"), rows["turn"].cast("bigint").alias("turn"),
        F.coalesce(rows["role"], F.lit(" ")).alias("role"), F.coalesce(rows["text"], F.lit(" ")).alias("text"))


def repair_conversations(rows: DataFrame, ids: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: its faults, and the cheapest edits after which its roles read ``(s?(ua)+)?``.

    ``rows`` has conv_id, turn, role and text; other columns are not read. Turns are ordered by turn (nulls first),
    then role and text. A row's first fault counts: blank, duplicate (same role and text earlier in the
    conversation) or truncated (no closing mark). ``gaps`` counts turns missing between the first and the last, ``illegal``
    neighbours whose roles may not follow each other. ``audit`` has one letter per edit: Keep 0, Rerole 3,
    Delete 4 (a must for blank and duplicate rows), Insert an empty turn 3; an undeleted truncated row costs 3
    more; of equally cheap ones the least in ASCII order. ``repaired_sha256`` is the digest of the repaired
    ``role:text`` lines. Rows with a null id are one conversation; a null role or text is a space. With
    ``ids`` the result has a row for each of its distinct conv_id, those without rows with zeros, an empty
    audit and the digest of nothing. An empty table gives an empty table.

    One shuffle, by conversation; a task streams its rows through external sorts and holds one character a row.
    """
    repeats = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    marked = _whole(rows).repartition("conv_id").withColumn("repeated", F.row_number().over(repeats) > 1)
    ordered = marked.sortWithinPartitions("conv_id", "turn", "role", "text", "repeated")
    blocks = ordered.mapInArrow(_forward(block_rows), f"{_DDL}, block bigint, codes binary, state int, inserts string")
    # the blocks of a conversation are in one partition still, so sorting them moves nothing
    report = blocks.sortWithinPartitions("conv_id", F.col("block").desc()).mapInArrow(_backward, f"{_DDL}, audit string")
    if ids is None:
        return report
    wanted = ids.select(ids["conv_id"].cast("bigint").alias("_id")).distinct()
    joined = wanted.join(report, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("_id", "conv_id")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"), F.coalesce("audit", F.lit("")).alias("audit"))


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the turns that the audits of ``report`` leave or put in, numbered from 0.

    An audit goes before the sorted rows of its conversation, and a worker applies it as they stream by.
    Conversations without a report give nothing."""
    turns = _whole(rows).withColumn("audit", F.lit(None).cast("string"))
    audits = report.select("conv_id", *(F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in ("turn", "role", "text")), "audit")
    both = turns.unionByName(audits).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text")

    def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv_id, edits, state, position = None, iter(""), NONE, 0

        def put(role: str, text: str) -> dict:
            nonlocal position
            position += 1
            return {"conv_id": conv_id, "position": position - 1, "role": role, "text": text}

        for own, role, text, audit in _rows(batches, "conv_id", "role", "text", "audit"):
            if audit is not None or own != conv_id:
                for _ in edits:  # what is left of an audit are inserts
                    yield put(NEXT[state][0], "")
                    state = NEXT[state][1]
                conv_id, edits, state, position = own, iter(audit or ""), NONE, 0
            if audit is None:
                for edit in edits:
                    if edit in (INSERT, REROLE):
                        yield put(NEXT[state][0], text if edit == REROLE else "")
                        state = NEXT[state][1]
                    elif edit == KEEP:
                        yield put(role, text)
                        state = AFTER[state, role[:1]]
                    if edit != INSERT:
                        break
        for _ in edits:
            yield put(NEXT[state][0], "")
            state = NEXT[state][1]

    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return ordered.mapInArrow(lambda batches: _batches(turns_of(batches), schema, 2000), "conv_id bigint, position bigint, role string, text string")
