"""Queries take every document and client (the names with _whole are second names of the same queries)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewheel.operators import annotations as A
from tidewheel.sources.stand_ins import Tables

SF = "/root/testdata/sf0.01"
QUERIES = entry.queries()


def test_an_export_row_is_one_document(spark):
    rows = [("p", i, f'd "{i}"', "t\n", 1, "7", "w", 0, 1, True, {"Time": "Past"}) for i in range(5)]
    df = spark.createDataFrame(rows, "project string, document_id long, document_name string, text string, annotation_id long, cui string, value string, start int, end int, correct boolean, meta map<string, string>")
    out = A.rows_to_export(df)
    assert out.count() == 5
    back = A.export_to_rows(out)
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("name, column", [("flatten_annotations_whole", "doc_id"), ("annotations_table_whole", "doc_id"), ("export_to_rows_whole", "document_id")])
def test_all_documents(spark, name, column):
    a = Tables(spark, SF).annotations()
    a = a.where(F.col("cui").isin(7, 8, 10, 11)) if name == "annotations_table_whole" else a
    want = {r[0] for r in a.select("doc_id").distinct().collect()}
    assert max(want) >= 300 and {r[0] for r in QUERIES[name](spark, SF).select(column).distinct().collect()} == want


def test_all_documents_exported(spark):
    a = Tables(spark, SF).annotations()
    got = {r["project"]: (r["documents"], r["annotations"]) for r in QUERIES["rows_to_export_whole"](spark, SF).collect()}
    assert sum(d for d, _ in got.values()) == a.select("doc_id").distinct().count() and sum(n for _, n in got.values()) == a.count()


def test_whole_notes_are_split(spark):
    """Every document, and a chunk for each 100 characters but the last."""
    got = {r["doc_id"]: r["n"] for r in QUERIES["split_notes_whole"](spark, SF).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    docs = Tables(spark, SF).documents().where("text is not null").select("doc_id", F.length("text").alias("size")).collect()
    want = {r["doc_id"]: 1 if r["doc_id"] % 10 == 0 or r["size"] <= 100 else -(-r["size"] // 100) - 1 for r in docs}
    assert got == want and max(want.values()) > 300


def test_marks_side_by_side(spark):
    day, mark = "05-Jan-2024 08:30", "Entered on -"
    text = f"a {mark} {day}{mark} {day} {mark}{mark} {day}x tail"
    df = spark.createDataFrame([(1, text)], "id long, text string").selectExpr("id", "text", "timestamp_ntz'2024-02-01 00:00:00' as ts", "'d' as d")
    got = [r["text"] for r in A.split_notes(df, "id", "text", "ts", "d").orderBy("chunk").collect()]
    assert got == [f"a {mark} {day}E", f"ntered on - {day} ", "", f"{mark}{mark} {day}x"]


def test_all_annotations_meet_the_labels(spark):
    got = {r[0] % 10 for r in QUERIES["match_human_labels_whole"](spark, SF).select("doc_id").distinct().collect()}
    assert got == set(range(10))


@pytest.mark.parametrize("name", ["index_event_whole", "index_events_whole"])
def test_all_customers_have_an_index_event(spark, name):
    t = Tables(spark, SF)
    want = t.raw("customer").count() + t.documents().select("client_id").distinct().count()
    assert want > 1000 and QUERIES[name](spark, SF).count() == want
