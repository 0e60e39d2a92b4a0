"""Secret scan: patterns, and a structural check of what decodes as a key or a signed token."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyrank.llm.common import by_bytes, texts_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# The runs are maximal, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{12,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?!\.?[A-Za-z0-9_-])")
# Lines join over line breaks, also those written \n in a string, and over the blanks that indent them; a PEM boundary ends them.
BREAK = r"(?:\r?\n|\\+(?:r\\+)?n)[\x20\t]*"
ENCODED = re.compile(rf"(?:(?<![A-Za-z0-9+/_-])(?!(?<=\\)n)|(?<=\\n))[A-Za-z0-9+/_-]{{40,}}(?:{BREAK}(?!-----)[A-Za-z0-9+/_-]+)*={{0,2}}")
LINE = re.compile(rf"{BREAK}|([A-Za-z0-9+/_-]+)")
#: Letters of a key's first line, at least.
FIRST_LINE = 40
HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")

BASE = ("assign", "access", "hex")
CONFIRMED = ("der", "openssh", "jwt")
ORDER = {kind: i for i, kind in enumerate((*BASE, *CONFIRMED))}
#: Nested encodings deeper than this are not keys.
DEEPEST = 16
#: What a private OpenSSH container starts with.
OPENSSH = b"openssh-key-v1\0"


def _der_element(data: bytes, at: int, end: int, depth: int = 0) -> int:
    """End of the element at ``at`` if its tag and length, and those of all elements in a
    constructed one, fit exactly; -1 otherwise."""
    if depth > DEEPEST or at + 2 > end:
        return -1
    tag, size, at = data[at], data[at + 1], at + 2
    if tag & 0x1F == 0x1F or tag == 0:
        return -1
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return -1
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
    if at + size > end:
        return -1
    if tag & 0x20:
        inner = at
        while inner < at + size:
            inner = _der_element(data, inner, at + size, depth + 1)
            if inner < 0:
                return -1
    return at + size


def is_der_key(data: bytes) -> bool:
    """A sequence that fills the data, whose parts nest exactly and begin with a small version
    number or a sequence (an algorithm or the signed part of a certificate)."""
    if len(data) < 24 or data[0] != 0x30 or _der_element(data, 0, len(data)) != len(data):
        return False
    first = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    return data[first] == 0x30 or (data[first] == 0x02 and data[first + 1] <= 2) or (data[first] == 0x02 and len(data) > 64)


def der_size(data: bytes) -> int:
    """Bytes that the sequence at the start of ``data`` covers by its own length; 0 if none starts there."""
    if len(data) < 6 or data[0] != 0x30:
        return 0
    n = data[1] & 0x7F if data[1] & 0x80 else 0
    if n > 4 or data[1] == 0x80:
        return 0
    return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1])


def is_openssh_key(data: bytes) -> bool:
    """The private container (its magic, then length-prefixed strings) or a public key blob (an
    algorithm name, then length-prefixed fields to the end)."""
    at, fields = (len(OPENSSH), 3) if data.startswith(OPENSSH) else (0, 0)
    if not at and data[4:8] not in (b"ssh-", b"ecds", b"sk-s"):
        return False
    seen = 0
    while at + 4 <= len(data) and (not fields or seen < fields):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        seen += 1
    return seen == fields and at <= len(data) if fields else seen >= 2 and at == len(data)


def openssh_sizes(number: Callable[[int], int], private: bool, available: int) -> list[int]:
    """Where a key may end: after each field of a public blob but its name, last first; after the private
    part of a container, or where the data ends if that part does. ``number`` reads the length at a place."""
    at, ends, fields = (len(OPENSSH) if private else 0), [], 0
    while at + 4 <= available:
        if private and fields == 3:  # how many public keys follow, and the private part
            left, at, private = number(at) + 1, at + 4, False
            while left and at + 4 <= available:
                at, left = at + 4 + number(at), left - 1
            return [at if left == 0 and at <= available else available]
        at += 4 + number(at)
        fields += 1
        if at <= available:
            ends.append(at)
    return [available] if private else ends[:0:-1]


def _unbase64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _letters(n_bytes: int) -> int:
    return (4 * n_bytes + 2) // 3


def _encoded_keys(m: re.Match[str]) -> Iterator[tuple[str, int, int]]:
    """The keys among the lines of an encoding. A key starts with a line and ends with one, so words
    on the line after it do not hide it, nor does a line before it; its own lengths say which line."""
    lines = [(x.start(1), x.end(1)) for x in LINE.finditer(m.string, m.start(), m.end()) if x[1]]
    before = [0, *accumulate(b - a for a, b in lines)]  # letters before each line, and all
    text = "".join(m.string[a:b] for a, b in lines)
    first = 0
    while first < len(lines):
        start, beyond = before[first], 0
        if lines[first][1] - lines[first][0] >= FIRST_LINE:
            kind, sizes, confirm = _reading(text, start)
            for size in sizes:
                end = start + _letters(size)
                k = bisect_left(before, end, first + 1)
                if k < len(before) and before[k] == end and confirm(_unbase64(text[start:end]) or b""):
                    beyond = k
                    yield kind, lines[first][0], m.end() if k == len(lines) else lines[k - 1][1]
                    break
        first = beyond or first + 1


def _reading(text: str, start: int) -> tuple[str, list[int], Callable[[bytes], bool]]:
    """What the letters from ``start`` on may be: a kind, its sizes in bytes, and how to confirm it."""

    def number(at: int) -> int:
        quad = start + at // 3 * 4
        data = _unbase64(text[quad : quad + 8]) or b""
        return int.from_bytes(data[at % 3 : at % 3 + 4], "big")

    head = _unbase64(text[start : start + 24]) or b""
    if size := der_size(head):
        return "der", [size], is_der_key
    if head.startswith(OPENSSH) or head[4:8] in (b"ssh-", b"ecds", b"sk-s"):
        return "openssh", openssh_sizes(number, head.startswith(OPENSSH), (len(text) - start) * 3 // 4), is_openssh_key
    return "", [], is_der_key


def _is_signed_token(header: str, payload: str) -> bool:
    parts = [_unbase64(x) for x in (header, payload)]
    try:
        head = json.loads(parts[0] or b"")
        return isinstance(head, dict) and isinstance(head.get("alg"), str) and parts[1] is not None
    except (ValueError, RecursionError):
        return False


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every finding by start, then kind; code points, end exclusive."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    found += [("jwt", m.start(), m.end()) for m in SIGNED.finditer(text) if _is_signed_token(m[1], m[2])]
    for m in ENCODED.finditer(text):
        found += _encoded_keys(m)
    for m in HEX_BYTES.finditer(text):
        data = bytes.fromhex(m[0])
        if is_der_key(data):
            found.append(("der", m.start(), m.end()))
        elif is_openssh_key(data):
            found.append(("openssh", m.start(), m.end()))
    return sorted(found, key=lambda x: (x[1], ORDER[x[0]], x[2]))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and ``secrets``, an array of (kind, start, end) by start, kind.

    assign, access and hex are patterns. der, openssh and jwt are reported only once the decoded
    bytes parse: nested lengths that fit exactly, a known container, or a JSON header that names a
    signing algorithm. The lines of a key may be indented or broken by a literal backslash-n; what
    follows the lines that its own length covers is not part of it. A null text is empty and has none; null ids and repeated rows pass through;
    other columns are not read. Texts are scanned whole, in the partitions they lie in.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    item = pa.struct([pa.field("kind", pa.string()), pa.field("start", pa.int64()), pa.field("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(t)] for t in texts_of(part)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(item))], ["doc_id", "secrets"])

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, secrets array<struct<kind:string,start:bigint,end:bigint>>")


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
