"""SentencePiece encoding by one forward pass over a trie of distinct words, and decoding."""

from __future__ import annotations

import gc
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyrank.llm.common import by_bytes, offsets, texts_of

MARK = "▁"
#: Distinct words a worker remembers the ids of, and pairs of pieces it remembers the verdict on.
CACHE_WORDS, CACHE_PAIRS = 150_000, 300_000


class PieceTexts:
    """What the pieces of a model stand for: all that decoding needs."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        raw = {i: t.replace(MARK, " ").encode() for i, t in enumerate(self.text)}
        raw |= {i: b"" for i in range(size) if model.is_control(i)} | {i: bytes([b]) for b, i in self.byte.items()}
        raw[model.unk_id()] = " ⁇ ".encode()
        self.raw = [raw[i] for i in range(size)]
        self.plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {i: model.get_score(i) for i in self.plain}

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


class PieceModel(PieceTexts):
    """The pieces of a byte-pair SentencePiece model with byte fallback and identity normalisation.

    Such a model merges the neighbours whose joined piece has the best score until none is left. A
    sequence of pieces is what these merges give just if every two neighbours in it are: splitting a
    neighbour pair further never lets an earlier merge cross it. So the encoding of a prefix does not
    depend on what follows, and a Viterbi pass finds it: a piece may end at a place if it stands well
    beside the last piece of the prefix before it, with forward score 0, else minus infinity. Just one
    piece ends well at each place.
    """

    def __init__(self, path: str):
        super().__init__(path)
        plain = self.plain
        self.runs = {len(self.text[i]): i for i in plain if not self.text[i].strip(MARK)}
        if any(MARK in self.text[i].lstrip(MARK) or self.text[i].startswith(MARK * 2) for i in plain if self.text[i].strip(MARK)):
            raise ValueError("a piece holds a mark inside: words are not independent in this model")
        self.id = {self.text[i]: i for i in plain if self.text[i].strip(MARK) or len(self.text[i]) == 1}
        # Place in the order of merges; single characters are there from the start.
        order = sorted((i for t, i in self.id.items() if len(t) > 1), key=lambda i: -self.score[i])
        self.rank = {i: place for place, i in enumerate(order, 1)}
        self.split: dict[int, tuple[int, int] | None] = {i: None for t, i in self.id.items() if len(t) == 1}
        self.pairs: dict[int, bool] = {}
        for i in order:  # parts of a piece merge before it does
            self.split[i] = self._last_merge(i)
        for i in [i for i, parts in self.split.items() if parts is None and len(self.text[i]) > 1]:
            del self.id[self.text[i]]  # no merges lead to it
        self.trie: dict = {}
        for piece, i in self.id.items():
            node = self.trie
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = i
        self.words: dict[str, bytes] = {}
        self.mark = self.id[MARK]

    def _last_merge(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one, if the merges of its text end in it."""
        parts = [self.id.get(c, -1) for c in self.text[piece]]
        while len(parts) > 2:
            best, at = None, 0
            for k in range(len(parts) - 1):
                if parts[k] >= 0 and parts[k + 1] >= 0:
                    rank = self.rank.get(self.id.get(self.text[parts[k]] + self.text[parts[k + 1]], -1))
                    if rank is not None and (best is None or rank < best):
                        best, at = rank, k
            if best is None:
                return None
            parts[at : at + 2] = [self.id[self.text[parts[at]] + self.text[parts[at + 1]]]]
        return (parts[0], parts[1]) if len(parts) == 2 and min(parts) >= 0 else None

    def stands(self, left: int, right: int) -> bool:
        """Whether no merge across the boundary comes before the merges that made the two pieces.

        Undoes the merges next to the boundary from the last to the first. Of equal merges the left one
        comes first, so one across the boundary must be earlier than the left piece's and may be equal
        to the right piece's.
        """
        limit = len(self.text) + 1
        while True:
            joined = self.rank.get(self.id.get(self.text[left] + self.text[right], -1))
            if joined is not None and joined < limit:
                return False
            a, b = self.rank.get(left, 0), self.rank.get(right, 0)
            if a == 0 and b == 0:
                return True
            if a > b:
                limit, left = a, self.split[left][1]
            else:
                limit, right = b + 1, self.split[right][0]

    def encode_words(self, words: list[str]) -> None:
        """Adds the ids of marked words, each the mark and a text without spaces, to ``words``.

        The sorted words are the depth-first order of their trie: what two neighbours share at the
        front keeps its forward states, the stack of (last piece, where it starts).
        """
        if len(self.words) + len(words) > CACHE_WORDS:
            self.words.clear()
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        pairs, stands, root, byte = self.pairs, self.stands, self.trie, self.byte
        last, begin = [-1], [0]
        reach: list[list] = [[]]  # pieces under way: (where one starts, what may follow)
        before = ""
        for word in sorted(words):
            marked = MARK + word
            shared, most = 0, min(len(before), len(marked))
            while shared < most and before[shared] == marked[shared]:
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :], reach[shared + 1 :]
            for end in range(shared, len(marked)):
                character, ahead, chosen, origin = marked[end], [], -1, end
                for start, children in (*reach[end], (end, root)):  # the longest piece first
                    child = children.get(character)
                    if child is None:
                        continue
                    ahead.append((start, child))
                    piece = child.get("")
                    if piece is None or chosen >= 0:
                        continue
                    left = last[start]
                    if left >= 0:
                        key = left << 32 | piece
                        good = pairs.get(key)
                        if good is None:
                            good = pairs[key] = stands(left, piece)
                        if not good:
                            continue
                    chosen, origin = piece, start  # alone at the front or after a character without piece
                last.append(chosen)
                begin.append(origin)
                reach.append(ahead)
            before = marked
            found, end = array("i"), len(marked)
            while end:
                start = begin[end]
                if last[end] >= 0:
                    found.append(last[end])
                else:
                    found.extend([byte[b] for b in reversed(marked[start].encode())])
                end = start
            found.reverse()
            self.words[word] = found.tobytes()

    def _marks(self, n: int) -> list[int]:
        """Ids of n marks on end: the leftmost merge first, so the longest pieces from the left."""
        out, most = [], max(self.runs)
        while n:
            step = min(n, most)
            while step not in self.runs:
                step -= 1
            out.append(self.runs[step])
            n -= step
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [t.replace(MARK, " ").split(" ") if t else [] for t in texts]
        wanted = set().union(*split)
        wanted.discard("")
        missing = wanted - self.words.keys()
        if len(self.words) + len(missing) > CACHE_WORDS:
            self.words.clear()
            missing = wanted
        if missing:
            gc.disable()  # nothing here makes cycles, and the tables are large to walk
            try:
                self.encode_words(list(missing))
            finally:
                gc.enable()
        out, get = [], self.words.__getitem__
        mark = np.array([self.mark], "<i4").tobytes()
        for parts in split:
            if "" not in parts:
                out.append(b"".join(map(get, parts)))
                continue
            ids, run = [], 0
            for word in parts:
                run += 1
                if word:
                    own = get(word)
                    lone = own[:4] == mark  # its mark stays apart and joins the marks before
                    marks = self._marks(run if lone else run - 1)
                    ids += [np.array(marks, "<i4").tobytes(), own[4:] if lone else own]
                    run = 0
            out.append(b"".join(ids) + np.array(self._marks(run), "<i4").tobytes())
        return out


@lru_cache(maxsize=1)
def _texts(path: str) -> PieceTexts:
    return PieceTexts(path)


@lru_cache(maxsize=1)
def _model(path: str) -> PieceModel:
    """The model of this worker process, with what it remembers from earlier tasks."""
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, ids of every document, as the model's own encoder gives them.

    Per step of a few MB the distinct marked words are sorted and encoded once; a worker remembers a
    bounded number. Nothing is shuffled. A null text has null ids, an empty one none; null doc ids and
    repeated rows pass through; other columns are not read. Decoding gives the text again, but for
    the mark character itself, which is a space to the model.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for part in by_bytes(batches):
            found = model.encode(texts_of(part))
            ends = offsets(np.array([len(x) // 4 for x in found], np.int64)).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends), ids, mask=part.column("text").is_null() if len(found) else None)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), lists], ["doc_id", "text", "ids"])

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text string, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in column ``out``, which replaces one of that name. Null ids
    give a null text; control pieces are silent; bytes that are no UTF-8 become U+FFFD."""
    base = encoded.drop(out)
    schema = base.selectExpr("*", f"CAST(NULL AS STRING) AS {out}").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _texts(model_path)
        for batch in batches:
            column = batch.column(ids)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            null = column.is_null().to_numpy(zero_copy_only=False)
            texts = [None if null[k] else model.decode(flat[ends[k] : ends[k + 1]]) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=pa.schema([*batch.schema, (out, pa.string())]))

    return base.mapInArrow(run, schema)
