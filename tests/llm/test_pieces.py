import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyrank.llm import pieces
from tests_llm_brute import awkward, empty  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="session")
def model():
    return pieces.PieceModel(PATH)


@pytest.fixture(scope="session")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(model, texts):
    import numpy as np

    return [np.frombuffer(x, "<i4").tolist() for x in model.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abehtinorsTHE'éñ,. \n\t▁\U0001f60012"), max_size=40), min_size=1, max_size=4))
def test_ids_are_the_librarys(model, own, texts):
    assert ids(model, texts) == own.encode(texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(model, own, text):
    text = text.replace("\0", "")
    assert ids(model, [text]) == own.encode([text])
    if "▁" not in text and text:
        assert model.decode(__import__("numpy").array(own.encode(text))) == text


def test_real_documents_and_very_long_words(spark, model, own):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert ids(model, texts) == own.encode(texts, num_threads=1)
    long = ["thethere" * 3000, "a" * 5000, " " * 100 + "x" + " " * 37]
    assert ids(model, long) == own.encode(long)


def test_awkward_rows(spark, awkward, empty, model):
    got = pieces.decode_documents(pieces.encode_documents(awkward, PATH), PATH)
    rows = got.withColumn("same", F.col("decoded").eqNullSafe(F.col("text"))).collect()
    assert len(rows) == 7 and all(r.same for r in rows)
    assert [r.ids for r in rows if r.doc_id in (1, 2)] == [None, [], []]
    assert pieces.decode_documents(pieces.encode_documents(empty, PATH), PATH).count() == 0
    odd = spark.createDataFrame([(1, [1, 2, 0, model.mark], "x"), (2, None, "y"), (3, [3 + 0xC3], "z")], "doc_id LONG, ids ARRAY<INT>, decoded STRING")
    assert [r.decoded for r in pieces.decode_documents(odd, PATH).orderBy("doc_id").collect()] == ["⁇  ", None, "�"]
