import hashlib
import random

from pyspark.sql import functions as F

from tallyrank.llm import pii
from tallyrank.llm.queries import op10_pii
from tests_llm_brute import awkward, empty  # noqa: F401
from tests_llm_brute import PLAIN
from tests_llm_brute import personal as brute

def found(spark, texts, model=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    rows = pii.find_personal_data(docs, model or pii.SpanModel({"bias": -1.0}, {}, {})).orderBy("doc_id").collect()
    return [[tuple(s) for s in r.spans] for r in rows]


def test_base_spans_match_brute_force(spark):
    rng = random.Random(4)
    bits = ["a.b@c.de", "%x@d.e", "a@b", "1.2.3.4", "300.1.1.1", "0255.001.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "+1 (338) 555-7198",
            "+4930123456", "+1", "é", "\U0001f600", "\x01", "\x02", " ", "  ", ".", "-", "9", "12", "@", "word", "\n", "+49 (0)30.12-", "a-b.c@"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", ","]) for _ in range(rng.randrange(14))) for _ in range(600)]
    texts += ["4111111111111111 " * 300, "x" * 200_000, "1" * 100_000, "a." * 50_000 + "@b" + ".c" * 30_000, "+1" + " " * 50_000]
    assert found(spark, texts) == [brute(t) for t in texts]


def test_query_digest_on_documents(spark):
    got = op10_pii(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == joined or r.spans.startswith(joined + ",") or not joined
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in want) for kind in PLAIN)


def test_em_finds_the_reliable_labelers():
    rng = random.Random(9)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple((1 if truth else -1) if rng.random() < right else (0 if rng.random() < 0.5 else (-1 if truth else 1)) for right in (0.95, 0.9, 0.5, 0.35))
        counts["email", votes, 1] = counts.get(("email", votes, 1), 0) + 1
    model = pii.estimate([(k, v, s, float(n)) for (k, v, s), n in sorted(counts.items())])
    said = model.reliability
    assert said["shape"][1, 1] > 0.85 and said["validity"][0, -1] > 0.8
    assert said["context"][1, 1] < said["shape"][1, 1]
    assert abs(model.prior["email"] - 0.4) < 0.05
    assert model.weights["shape=1"] > model.weights["shape=-1"]


def test_classifier_adds_spans_and_masks_overlaps(spark):
    filler = "the number of the page is 12 and no more"
    texts = [f"call me: phone 338-555-{7000 + k} or mail a{k}@b.org {filler}" for k in range(60)]
    texts += [f"release 123.45.{6000 + k} of order 100 22 3333/x version 555.55.{k + 1000}a" for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    model = pii.train_spans(docs)
    spans = found(spark, texts, model)
    assert all([k for k, *_ in s] == ["email", "number"] for s in spans[:60])
    assert not any(spans[60:])
    masked = pii.mask_personal_data(docs, model).orderBy("doc_id").collect()
    assert masked[0].text == f"call me: phone [NUMBER] or mail [EMAIL] {filler}"
    assert [r.text for r in masked[60:]] == texts[60:]


def test_awkward_rows(spark, awkward, empty):
    model = pii.train_spans(awkward)
    assert pii.find_personal_data(awkward, model).count() == 7
    assert pii.find_personal_data(empty, pii.train_spans(empty)).count() == 0
    masked = pii.mask_personal_data(awkward.withColumn("_clean", F.lit(1)).withColumn("_parts", F.lit(1)).withColumn("_found", F.lit(1)), model)
    assert masked.columns == [*awkward.columns, "_clean", "_parts", "_found"]
    assert masked.where("text is null").count() == 1
