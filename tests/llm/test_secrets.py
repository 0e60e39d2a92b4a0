import base64
import json
import random

from tallyrank.llm import secrets
from tests_llm_brute import awkward, empty  # noqa: F401


def b64(data, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode()


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


KEY = der(0x30, der(0x02, b"\0") + der(0x02, bytes(range(1, 130))) + der(0x02, b"\1\0\1") + der(0x30, der(0x04, bytes(90))))
SSH = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))


def kinds(text):
    return [(k, text[a:b]) for k, a, b in secrets.scan_text(text)]


def test_base_patterns_drop_failures_without_retry():
    assert kinds("x PassWord = 'abcdefghijkl' y") == [("assign", "PassWord = 'abcdefghijkl")]
    assert kinds("secret: token: abcdefghijklmnop") == []  # the short value is part of the dropped match
    assert kinds("é AKIA0123456789ABCD.") == [("access", "AKIA0123456789ABCD")]
    assert kinds("AKIA0123456789ABC") == []
    assert kinds("g0123456789abcdefg 0123456789abcde") == [("hex", "0123456789abcdef")]
    assert kinds("ſecret=abcdefghijklmnop") == []  # letters of either case, in ASCII


def test_confirmed_only_when_the_structure_holds():
    good, broken = b64(KEY), b64(KEY[:-3] + b"\0\0\0\0")
    lines = "\n".join(good[i : i + 64] for i in range(0, len(good), 64))
    assert ("der", good) in kinds(f"a {good} b")
    assert ("der", lines) in kinds(f"-----BEGIN KEY-----\n{lines}\n-----END KEY-----")
    assert not kinds(f"a {broken} b")
    assert ("der", KEY.hex().upper()) in kinds(f"x {KEY.hex().upper()} y")
    assert ("openssh", b64(SSH)) in kinds(f"ssh-ed25519 {b64(SSH)} me")
    assert not kinds("z" * 200)
    head, body = (b64(json.dumps(x).encode(), True).rstrip("=") for x in ({"alg": "HS256", "typ": "JWT"}, {"sub": "12"}))
    assert kinds(f"is {head}.{body}.c2lnbmF0dXJl ok") == [("jwt", f"{head}.{body}.c2lnbmF0dXJl")]
    assert not kinds(f"is {body}.{body}.c2lnbmF0dXJl ok")


def wrapped(text, width=64, line="\n"):
    return line.join(text[i : i + width] for i in range(0, len(text), width))


def test_keys_of_every_length_in_every_layout():
    rng = random.Random(5)
    for n in range(126, 126 + 2 * 48 + 3):  # every length modulo 3 and 48, from one line's worth to several
        key = der(0x30, der(0x02, b"\0") + der(0x04, rng.randbytes(n)))
        for padded in (b64(key), b64(key).rstrip("=")):
            for line in ("\n", "\r\n", "\n    ", "\n\t", "\\n", "\\r\\n", "\\\\n"):
                body = wrapped(padded, line=line)
                for after in ("-----END KEY-----", "Then words", "Th", "", "- item"):
                    assert kinds(f"-----BEGIN KEY-----{line}{body}{line}{after}").count(("der", body)) == 1, (n, line, after)
            assert ("der", padded) in kinds(f"at {padded}\nwords follow")


def test_neighbouring_lines_hide_no_key():
    rng = random.Random(6)
    one, two = (b64(der(0x30, der(0x02, b"\0") + der(0x04, rng.randbytes(n)))).rstrip("=") for n in (150, 151))
    junk = "x" * 64
    assert [x for x in kinds(f"{junk}\n{one}\n{two}\n{junk}") if x[0] == "der"] == [("der", one), ("der", two)]
    assert ("openssh", b64(SSH)) in kinds(f"{b64(SSH)}\nwords")
    fields = (b"none", b"none", b"")
    private = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in fields) + (1).to_bytes(4, "big")
    for n in range(100, 148):
        body = wrapped(b64(private + len(SSH).to_bytes(4, "big") + SSH + n.to_bytes(4, "big") + rng.randbytes(n)).rstrip("="), 70)
        for after in ("-----END OPENSSH PRIVATE KEY-----", "words"):
            assert ("openssh", body) in kinds(f"-----BEGIN OPENSSH PRIVATE KEY-----\n{body}\n{after}")
    assert not [x for x in kinds(f"{junk}\n{one[:-8]}\n{junk}") if x[0] == "der"]


def test_signed_token_at_the_end_of_a_sentence():
    head, body = (b64(json.dumps(x).encode(), True).rstrip("=") for x in ({"alg": "HS256"}, {"sub": "12"}))
    token = f"{head}.{body}.c2lnbmF0dXJl"
    for after in (".", ". Then", "...", ".\n"):
        assert kinds(f"It is {token}{after}") == [("jwt", token)]
    assert not kinds(f"It is {token}.more")


def test_order_is_by_start_then_kind():
    text = "token=0123456789abcdef0123"
    assert [k for k, _, _ in secrets.scan_text(text)] == ["assign", "hex"]
    assert secrets.sha256_of([]) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_awkward_rows(spark, awkward, empty):
    assert secrets.find_secrets(awkward).count() == 7
    assert secrets.find_secrets(empty).count() == 0


def test_query_digest_matches_python(spark):
    from tallyrank.llm.queries import op5_secrets

    got = op5_secrets(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {r.doc_id: secrets.scan_text(r.text or "") for r in rows}
    assert len(got) == len(rows)
    for r in got:
        spans = want[r.doc_id]
        assert r.spans == secrets.joined(spans)
        assert r.base_sha256 == secrets.sha256_of([s for s in spans if s[0] in secrets.BASE])
        assert r.n_hex == sum(s[0] == "hex" for s in spans)
