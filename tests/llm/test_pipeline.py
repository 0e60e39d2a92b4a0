from collections import defaultdict
from fractions import Fraction

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tallyrank.llm import quality, repetition
from tests_llm_brute import components, personal

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]
    model = quality.train_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.score(*quality.passage_features([r["text"] or "" for r in rows]))
    wanted = {"quality classifier": [r for r, s in zip(rows, score, strict=True) if s >= 0.5]}
    left = wanted["quality classifier"]
    verdict = repetition.judge_texts([r["text"] or "" for r in left], 8, 0.3, 60, 50)["kept"]
    wanted["quality rules"] = [r for r, kept in zip(left, verdict, strict=True) if kept]
    left = wanted["quality rules"]
    order = sorted(left, key=lambda r: r["doc_id"])
    group = components([r["text"] for r in order], 5, Fraction(4, 5))
    wanted["near duplicates"] = [r for i, r in enumerate(order) if group[i] == i]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        got = stage(spark, docs, SF)
        assert got.columns == columns
        found = got.collect()
        if name in wanted:
            assert sorted(r.doc_id for r in found) == sorted(r["doc_id"] for r in wanted[name])
            docs = spark.createDataFrame(found, docs.schema)
        else:
            before = {r["doc_id"]: r["text"] for r in wanted["near duplicates"]}
            assert len(found) == len(before)
            for r in found:
                spans = personal(before[r.doc_id])
                assert (r.text != before[r.doc_id]) >= bool(spans)
                assert all(before[r.doc_id][a:b] not in r.text for _, a, b in spans)
                assert r.n_chars == len(r.text)
            masked = found
    pieces = corpus_pipeline.pack(spark, spark.createDataFrame(masked, docs.schema), SF).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size, filled = defaultdict(int), defaultdict(int)
    for p in pieces:
        size[p.doc_id] += p.length
        filled[p.sequence_id] += p.length
    assert dict(size) == {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in masked}
    assert max(filled.values()) <= 1024


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(got) and got.groupby("sequence_id").length.sum().max() <= 1024
    assert (got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first()).all()


def test_awkward_rows(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(90))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, text, "en", "a", 5), (3, text, None, "a", 9), (3, text, None, "a", 9), (4, text + " a@b.de", "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, str(tmp_path))
            assert table.columns == docs.columns
            table = spark.createDataFrame(table.collect(), docs.schema)
        corpus_pipeline.pack(spark, table, str(tmp_path)).collect()
