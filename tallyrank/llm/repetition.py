"""Quality rules by suffix arrays: how much of a text repeats, and how long its longest repeat is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyrank.llm.common import SPACE, by_bytes, numbered, offsets, per_run, texts_of, word_bytes

#: Shortest repeat, in words, whose spans count as covered.
MIN_REPEAT = 8
#: A text is rejected when more than this share of its words lies in repeats, ...
MAX_COVERED = 0.3
#: ... or when one repeat is longer than this many words.
MAX_REPEAT = 60
#: Texts under this many words have too little to judge.
MIN_WORDS = 50

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint"
)


def repeat_lengths(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word position the length of the longest run of words that starts there and is
    found at another position of the same text.

    ``words`` holds word numbers of texts laid end to end, ``bounds`` where each text starts. All
    suffixes are sorted by prefix doubling; a rank is the place of a group's first suffix, and only
    groups of several suffixes are sorted again. The longest common prefix of neighbours in the
    suffix array is then read off the ranks of all rounds, longest round first. Texts never match
    one another since the first ranks are those of (text, word).
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = text * (int(words.max()) + 1) + words
    active = np.argsort(key, kind="stable")
    places = np.arange(n)
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    ends = bounds[1:][text]
    rounds: list[np.ndarray] = []
    order = active.copy()
    sorted_key = key[active]
    length = 1
    while True:
        first = np.ones(len(active), bool)
        first[1:] = sorted_key[1:] != sorted_key[:-1]
        rank[active] = places[np.maximum.accumulate(np.where(first, np.arange(len(active)), 0))]
        order[places] = active
        rounds.append(rank.copy())
        tied = ~first
        tied[:-1] |= ~first[1:]
        active, places = active[tied], places[tied]
        if len(active) == 0:
            break
        after = active + length
        beyond = np.where(after < ends[active], rank[np.minimum(after, n)], -1)
        key = rank[active] * (n + 1) + beyond + 1
        shuffle = np.argsort(key, kind="stable")  # groups stay where they are: their rank leads the key
        active, sorted_key = active[shuffle], key[shuffle]
        length *= 2
    common = np.zeros(n, np.int64)  # of order[k] and order[k + 1]
    left, right = order[:-1], order[1:]
    pairs = np.flatnonzero(rounds[0][left] == rounds[0][right])
    for step in range(len(rounds) - 1, -1, -1):
        a, b = left[pairs] + common[pairs], right[pairs] + common[pairs]
        inside = (a < ends[left[pairs]]) & (b < ends[right[pairs]])
        same = inside & (rounds[step][np.minimum(a, n)] == rounds[step][np.minimum(b, n)])
        common[pairs[same]] += 1 << step
    longest = np.zeros(n, np.int64)
    longest[order] = common
    longest[right] = np.maximum(longest[right], common[:-1])
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of ``least`` words or more: the union of all spans."""
    edge = np.zeros(len(longest) + 1, np.int64)
    starts = np.flatnonzero(longest >= least)
    edge[starts] += 1
    np.subtract.at(edge, starts + longest[starts], 1)
    return np.cumsum(edge[:-1]) > 0


def judge_texts(texts: list[str], min_repeat: int, max_covered: float, max_repeat: int, min_words: int) -> dict[str, np.ndarray]:
    lists = [word_bytes(t) for t in texts]
    n_words = np.array([len(x) for x in lists], np.int64)
    bounds = offsets(n_words)
    words, _ = numbered(lists)
    longest = repeat_lengths(words, bounds)
    window = longest >= 3
    in_window = window.copy()
    in_window[1:] |= window[:-1]
    in_window[2:] |= window[:-2]
    repeat_words = per_run(in_window, bounds)
    covered_words = per_run(covered(longest, min_repeat), bounds)
    longest_repeat = np.zeros(len(texts), np.int64)
    full = n_words > 0
    if full.any():
        longest_repeat[full] = np.maximum.reduceat(longest, bounds[:-1][full])
    dup_lines = []
    for t in texts:
        lines = [line for line in t.split("\n") if line.strip(SPACE)]
        dup_lines.append(len(lines) - len(set(lines)))
    failed = (n_words < min_words) | (100 * repeat_words > 50 * n_words)
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t) - sum(map(t.count, SPACE)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, "#*$%&|<>")) for t in texts], np.int64),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": repeat_words,
        "base_failed": failed,
        "kept": ~failed & (covered_words <= max_covered * n_words) & (longest_repeat <= max_repeat),
        "covered_words": covered_words,
        "longest_repeat": longest_repeat,
    }


def repetition_report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per document with its base counts and the verdict of the suffix array.

    Each step lays texts of a few MB end to end and sorts all their word suffixes at once; nothing
    is shuffled and a text is never cut. A null or empty text has no words and fails (too few).
    Null ids and repeated rows pass through as they are; other columns are not read. An empty
    table gives an empty result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches):
            found = judge_texts(texts_of(part), min_repeat, max_covered, max_repeat, min_words)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, found.values())], ["doc_id", *found])

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, {FIELDS}")


def keep_unrepetitive(
    docs: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT, min_words: int = MIN_WORDS,
) -> DataFrame:
    """The rows that the rules keep, with all their columns; see ``repetition_report``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, text):
            yield part.filter(pa.array(judge_texts(texts_of(part, text), min_repeat, max_covered, max_repeat, min_words)["kept"]))

    return docs.mapInArrow(run, docs.schema)
