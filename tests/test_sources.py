import pytest

from tallyrank.functions import features as fx
from tallyrank.operators import profiles as pf
from tallyrank.sources import files
from pyspark.sql import functions as F


@pytest.mark.parametrize("sep", ["\t", "::", ","])
def test_ratings_keep_their_first_line(spark, tmp_path, sep):
    path = tmp_path / "ratings"
    path.write_text("\n".join(sep.join(map(str, r)) for r in [(1, 2, 5, 880), (1, 3, 4, 881)]))
    got = [tuple(r) for r in files.read_ratings(spark, str(path), sep).collect()]
    assert got == [(1, 2, 5.0, 880), (1, 3, 4.0, 881)]


def test_header_is_skipped_only_when_asked(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,v\n1,2\n")
    assert [tuple(r) for r in files.read_skip_header(spark, str(path), "id LONG, v LONG").collect()] == [(1, 2)]


def test_latin_items_and_users(spark, tmp_path):
    items = tmp_path / "movies.dat"
    items.write_bytes("7::Misérables, Les (1995)::Drama|Musical\n".encode("iso-8859-1"))
    row = files.read_items(spark, str(items)).first()
    assert (row.title, row.genres) == ("Misérables, Les (1995)", ["Drama", "Musical"])
    users = tmp_path / "u.user"
    users.write_text("1|24|M|technician|85711\n")
    assert tuple(files.read_users(spark, str(users)).first()) == (1, 24, "M", "technician", "85711")
    other = tmp_path / "users.dat"
    other.write_text("1::F::1::10::48067\n")
    assert tuple(files.read_users(spark, str(other), "::").first()) == (1, "F", 1, 10, "48067")


def test_search_log_drops_short_rows_and_label_zero(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text('ab\t{"abc": 0.5, "abd": 0.25}\tabc\ttag\t1\nab\t{"x": 1}\tx\ttag\t0\nshort\t{}\n')
    rows = files.read_search_log(spark, str(path)).collect()
    assert len(rows) == 1 and rows[0].query_prediction == {"abc": 0.5, "abd": 0.25} and rows[0].label == 1


def test_edges_events_categories_and_context(spark, tmp_path):
    path = tmp_path / "clicks"
    path.write_text("pc,hp.com\npc,hp.com\ntv,bestbuy.com\n")
    got = {(r.src, r.dst): r.w for r in files.read_edges(spark, str(path)).collect()}
    assert got == {("pc", "hp.com"): 2, ("tv", "bestbuy.com"): 1}
    events = tmp_path / "events"
    events.write_text("1,9,100\n")
    assert tuple(files.read_events(spark, str(events)).first()) == (1, 9, 100)
    cats = tmp_path / "cats"
    cats.write_text("9,3\n")
    assert tuple(files.read_item_category(spark, str(cats)).first()) == (9, 3)
    context = tmp_path / "context"
    context.write_text("109498  0.5 1.25  2\n\n")
    rows = files.read_context_log(spark, str(context)).collect()
    assert [(r.key, r.features) for r in rows] == [("109498", [0.5, 1.25, 2.0])]


def test_writers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.123456, "a")], "id LONG, p DOUBLE, c STRING")
    files.write_csv_noheader(df, str(tmp_path / "plain"))
    assert [r.value for r in spark.read.text(str(tmp_path / "plain")).collect()] == ["0.123456,a"]
    files.write_submission(df, str(tmp_path / "sub"), "id", "p")
    sub = spark.read.csv(str(tmp_path / "sub"), header=True)
    assert sub.columns == ["id", "target"] and [tuple(r) for r in sub.collect()] == [("1", "0.12346")]
    vectors = spark.createDataFrame([(1, [0.5, 0.25])], "id LONG, vec ARRAY<DOUBLE>")
    files.export_embeddings(vectors, str(tmp_path / "vec"), "id", "vec")
    back = spark.read.parquet(str(tmp_path / "vec"))
    assert dict(back.dtypes)["vec"] == "array<float>" and back.first().vec == [0.5, 0.25]
    lines = spark.createDataFrame([(1, 0, 0, 0, "2.5"), (1, 0, 1, 3, "x")], "id LONG, y INT, field_id INT, feat_id LONG, value STRING")
    files.write_lines(files.libsvm_lines(lines, ["id"], "y"), str(tmp_path / "svm"))
    assert spark.read.text(str(tmp_path / "svm")).first().value == "0 0:2.5 3:x"
    assert files.libffm_lines(lines, ["id"], "y").first().line == "0 0:0:2.5 1:3:x"


def test_profile_documents_and_sink(spark, tmp_path):
    users = spark.createDataFrame([(1, None, None, "M"), (2, "[35,39]", 3.5, "F")], "user_id LONG, age STRING, income DOUBLE, sex STRING")
    docs = pf.build_profiles(users, "user_id", ["age", "income"])
    got = {r.user_id: (r.user_info.age, r.user_info.income) for r in docs.collect()}
    assert got == {1: ("", 0.0), 2: ("[35,39]", 3.5)}
    files.write_profiles(docs.withColumn("part", F.pmod("user_id", F.lit(2))), str(tmp_path / "docs"), "part")
    assert spark.read.parquet(str(tmp_path / "docs")).count() == 2


def test_upsert_keeps_the_newest_and_honours_deletes(spark):
    base = spark.createDataFrame([(1, 0, "upsert", "a"), (2, 0, "upsert", "b")], "k LONG, v LONG, op STRING, x STRING")
    changes = spark.createDataFrame([(1, 2, "upsert", "c"), (1, 1, "upsert", "old"), (2, 5, "delete", ""), (3, 1, "upsert", "n")], base.schema)
    got = sorted(tuple(r) for r in pf.upsert(base, changes, "k", ["v"], ["x"]).collect())
    assert got == [(1, 2, "c"), (3, 1, "n")]


def test_phrase_search_and_highlight(spark):
    docs = spark.createDataFrame([(1, "All OF  the day"), (2, "loft the end")], "id LONG, t STRING")
    rows = pf.match_phrase(docs, "t", "of the").collect()
    assert [(r.id, r.highlight) for r in rows] == [(1, "All <em>OF  the</em> day")]
    assert [r.id for r in pf.match_term(docs, "t", "LOFT").collect()] == [2]


def test_encoders(spark):
    ages = {1: 1, 17: 1, 18: 2, 24: 2, 25: 3, 34: 3, 35: 4, 44: 4, 45: 5, 55: 5, 56: 6, 90: 6}
    df = spark.createDataFrame([(a,) for a in ages], "a INT")
    assert {r.a: r.c for r in df.select("a", fx.age_code("a").alias("c")).collect()} == ages
    buckets = {r.a: r.b for r in spark.createDataFrame([(0,), (10,), (11,), (100,), (101,)], "a INT").select(
        "a", fx.age_bucket("a").alias("b")).collect()}
    assert buckets == {0: None, 10: "0-10", 11: "10-20", 100: "90-100", 101: None}
    row = spark.createDataFrame([("Toy, Story; (1995)", "01-Jan-1995", ["Comedy", "Drama"])], "t STRING, d STRING, g ARRAY<STRING>").select(
        fx.clean_title("t").alias("clean"), fx.year_from_title("t").alias("year"), fx.year_from_date("d").alias("date"),
        fx.item_vector(F.lit(1995), "g").alias("vector"), fx.user_vector(F.lit("F"), F.lit(30), F.lit(7)).alias("user")).first()
    assert row.clean == "Toy  Story   1995" and row.year == 1995 and row.date == "1995"
    assert row.vector == [2] + [int(g in ("Comedy", "Drama")) for g in fx.GENRES]
    assert row.user == [2, 3, 7]


def test_interactions_are_written_once(spark):
    from tallyrank.sources.tables import Tables

    from conftest import SMALL

    rows = Tables(spark, SMALL).interactions
    assert all("/interactions-" in f for f in rows.inputFiles()) and rows.inputFiles()
    assert rows.columns == ["user_id", "item_id", "rating", "ts"] and rows.count() == rows.dropDuplicates(["user_id", "item_id"]).count()
