import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyrank.llm import packing
from tests_llm_brute import awkward, empty  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.just(1), st.integers(0, 9)), max_size=40))
def test_bins_respect_every_limit(items):
    vectors = np.array(items, np.int64).reshape(-1, 3)
    bins, place = packing.dot_product_bins(vectors, (10, 4, 8))
    for b in set(bins.tolist()):
        inside = vectors[bins == b]
        assert len(inside) == 1 or (inside.sum(0) <= (10, 4, 8)).all()
        assert sorted(place[bins == b].tolist()) == list(range(len(inside)))


def test_bins_leave_little_padding():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 1024, 8192)
    bins, _ = packing.dot_product_bins(np.stack([size, np.ones_like(size), size], 1), packing.LIMITS)
    assert size.sum() / (1024 * (bins.max() + 1)) > 0.99


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sS é1!,. \n\t\x1c\x85  \U0001f600<|>") , max_size=30), min_size=1, max_size=4))
def test_ids_by_units_are_the_tokenizers(texts):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    units = test_ids_by_units_are_the_tokenizers.__dict__.setdefault("units", packing._Units(*RANKS))
    want = [np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert units.encode(texts) == want


def check(pieces, docs):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, text in docs:
        ids = np.asarray(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    return sum(x for m in sequences.values() for _, x in m) / (1024 * len(sequences))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert check(packing.pack_documents(docs, *RANKS, group_docs=64).collect(), rows) > 0.93


def test_awkward_rows(spark, awkward, empty):
    got = packing.pack_documents(awkward, *RANKS).collect()
    assert sum(1 for p in got if p.doc_id == 2) == 2
    assert sorted(p.length for p in got if p.doc_id in (1, 2)) == [1, 1, 1]
    assert packing.pack_documents(empty, *RANKS).count() == 0


def test_examples_under_three_limits(spark):
    rows = [(i, i % 37, i % 11, "x") for i in range(500)] + [(900, 70, 1, "x"), (901, None, None, None), (902, 5, -3, None)]
    table = spark.createDataFrame(rows, "id LONG, tokens LONG, loss_tokens LONG, offset STRING")
    got = packing.pack_examples(table, limits=(64, 6, 20), group_rows=100).toPandas()
    assert len(got) == 503 and got[got.oversize].id.tolist() == [900]
    loads = got[~got.oversize].assign(loss=got.loss_tokens.clip(lower=0)).groupby("sequence_id").agg(t=("tokens", "sum"), n=("id", "size"), l=("loss", "sum"))
    assert (loads.t <= 64).all() and (loads.n <= 6).all() and (loads.l <= 20).all()


@pytest.mark.parametrize("limits", [(1024, 512, 1024)])
def test_full_pieces_stand_alone(spark, limits):
    docs = spark.createDataFrame([(1, "word " * 5000)], "doc_id LONG, text STRING")
    got = packing.pack_documents(docs, *RANKS, limits=limits).collect()
    assert {p.offset for p in got} == {0} and len({p.sequence_id for p in got}) == len(got)


HOLDING = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", " <|endoftext|>\n\n <|endoftext", "x  <|endoftext|>  y's <|ENDOFTEXT|>", ""]


def test_added_tokens_have_their_ids():
    whole = Tokenizer.from_file(PATH)
    units = packing._Units(*RANKS, packing.added_tokens(PATH))
    want = [whole.encode(t, add_special_tokens=False).ids for t in HOLDING]
    assert want[0] == [505, 220, 50256, 734]
    assert units.encode(HOLDING) == [np.asarray(x, "<u4").tobytes() for x in want]


def test_query_and_pipeline_keep_added_tokens(spark, tmp_path):
    from corpus_pipeline import pack
    from tallyrank.llm.queries import op2_packing

    docs = spark.createDataFrame(list(enumerate(HOLDING)), "doc_id LONG, text STRING")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    whole = Tokenizer.from_file(PATH)
    want = {k: zlib.crc32(np.asarray([*whole.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for k, t in enumerate(HOLDING)}
    for found in (op2_packing(spark, str(tmp_path)), pack(spark, docs, str(tmp_path))):
        assert {r.doc_id: r.ids_crc32 for r in found.collect()} == want
