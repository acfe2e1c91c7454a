"""Common values, samples, shares by type, splits told apart by sums, deletions, several first rows."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import anonymise as N
from tidewheel.operators import joins as J
from tidewheel.operators import matrix as M
from tidewheel.operators import search as S
from tidewheel.sources import tables as T


def tops(values, k):
    counts = {}
    for v in values:
        if v is not None:
            counts[str(v)] = counts.get(str(v), 0) + 1
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("tracked, candidates", [(10_000, 1000), (64, 20)])
def test_top_values_are_exact(spark, monkeypatch, tracked, candidates):
    """Skewed, flat and unique columns; with few tracked items the sketch can't vouch for the flat ones."""
    monkeypatch.setattr(M, "TRACKED", tracked)
    monkeypatch.setattr(M, "CANDIDATES", candidates)
    r = random.Random(3)
    rows = [(int(r.paretovariate(1.1)), r.randint(0, 300), i, r.choice(["x", "y", None]), None) for i in range(4000)]
    df = spark.createDataFrame(rows, "skewed long, flat long, unique long, few string, none string").repartition(5)
    got = {}
    for x in M.top_values(df, df.columns, 4).orderBy("column", "place").collect():
        got.setdefault(x["column"], []).append((x["value"], x["n"]))
    assert got == {c: tops([row[i] for row in rows], 4) for i, c in enumerate(df.columns[:4])}
    told = {x["column"]: x["top"] for x in M.profile(df, df.columns, top=2).collect()}
    assert told["none"] is None and told["few"] == ", ".join(f"{v}:{n}" for v, n in tops([row[3] for row in rows], 2))


def test_shares_by_type(spark):
    df = spark.createDataFrame([("a", "heart", ["disorder"]), ("a", "heart", ["disorder", "finding"]), ("a", "arm", ["body"]), ("a", "leg", None), ("b", "arm", [])], "client string, name string, types array<string>")
    got = {(x["type"], x["name"]): round(x["share"], 3) for x in M.shares_by_type(df, "client", "name", "types").where("client = 'a'").collect()}
    assert got == {("all", "heart"): 0.5, ("all", "other"): 0.5, ("disorder", "other"): 1.0, ("finding", "other"): 1.0, ("body", "other"): 1.0}


@pytest.mark.parametrize("change", ["none", "row", "key", "both ways", "twice"])
def test_split_told_apart_by_sums(spark, change):
    rows = [(f"k{i % 7}", i, f"t{i % 3}" if i % 5 else None) for i in range(200)] + [("k1", 1, "t1"), (None, 5, "x"), (None, 5, "x")]
    new = list(rows)
    if change == "row":
        new[10] = ("k3", 10, "other")
    elif change == "key":
        new = [x for x in rows if x[0] not in ("k2", None)] + [("new", 1, "z")]
    elif change == "both ways":
        new = rows[3:] + [("k4", 1000, "t"), ("k4", 1000, "t")]
    elif change == "twice":
        new = [*rows, rows[0]]
    schema = "k string, n long, t string"
    a, b = spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame(new, schema).repartition(4)
    got = sorted(map(tuple, T.verify_split(a, b, "k").collect()), key=str)
    want = []
    for problem, x, y in (("missing", rows, new), ("extra", new, rows)):
        want += [(k, f"{problem} key", 1) for k in {r[0] for r in x} - {r[0] for r in y}]
        left = list(x)
        for r in y:
            if r in left:
                left.remove(r)
        want += [(k, f"{problem} row", sum(r[0] == k for r in left)) for k in {r[0] for r in left}]
    assert got == sorted(want, key=str)


def test_keys_of_a_table_are_deleted_from_it(spark, tmp_path):
    tables = {}
    for name, key in (("one", "client_id"), ("two", "HospitalID")):
        path = f"{tmp_path}/{name}"
        T.write_keyed(spark.range(50).select(F.concat(F.lit("c"), F.col("id") % 10).alias(key), "id"), path, key, 4)
        tables[name] = (path, key)
    keys = T.read_keyed(spark, tables["one"][0], "client_id").where("id < 3").select("client_id")
    T.delete_everywhere(spark, tables, keys, 4)
    for name, (path, key) in tables.items():
        assert {r[0] for r in T.read_keyed(spark, path, key).select(key).collect()} == {f"c{i}" for i in range(3, 10)}
    assert {n: r.count() for n, r in T.lookup(spark, tables, "c5", 4).items()} == {"one": 5, "two": 5}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["one", "two"]


def test_first_rows_of_several_results(spark):
    make = lambda rows: spark.createDataFrame(rows, "client_id string, t long, tie long, text string")
    a = make([("x", 1, 1, "same"), ("x", 2, 1, "later"), ("y", 1, 1, "one"), ("z", 1, 1, "only")])
    b = make([("x", 5, 1, "same"), ("y", 1, 2, "two"), ("y", 1, 1, "one")])
    c = make([("x", 1, 1, "same"), ("y", 1, 1, "three"), ("w", 1, 1, None)])
    got = sorted(map(tuple, J.first_rows_differ({"a": a, "b": b, "c": c}, "text", "t", "tie").collect()))
    assert got == [("y", "one", "one", "three")]


def test_ner_measures(spark):
    part = lambda rows: spark.createDataFrame(rows, "cui long, value long")
    got = {r["cui"]: tuple(r)[1:] for r in J.ner_results(part([(1, 2)]), part([(1, 1), (2, 3)]), part([(1, 6)]), "cui", part([(1, 9), (2, 3), (3, 1)])).collect()}
    assert got == {1: (2.0, 1.0, 6.0, 0.75, 6 / 7, 0.8, 9.0), 2: (None, 3.0, None, None, 0.0, 0.0, 3.0), 3: (None, None, None, None, None, None, 1.0)}


def test_best_date_column(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-01", "1", "a"), ("2024-02-01", "n/a", "2", "b"), ("2024-03-01", None, "3", "2024-01-01")], "a string, b string, c string, d string")
    got = {r["column"]: (r["kind"], r["best"]) for r in M.best_date_column(df, ["d", "b", "a", "c"]).collect()}
    assert got == {"a": ("date", True), "b": ("date", False), "c": ("number", False), "d": ("text", False)}
    assert not any(r["best"] for r in M.best_date_column(df, ["c", "d"]).collect())


def test_report_of_a_sample(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "mail a@b.org").alias("t"))
    whole, part = ({r["label"]: r["entities"] for r in N.report(df, "id", "t", sample=n).collect()} for n in (None, 60))
    assert whole["EMAIL"] == 100 and 5 < part["EMAIL"] < 40
    assert part == {r["label"]: r["entities"] for r in N.report(df.repartition(7), "id", "t", sample=60).collect()}


def test_annotations_without_nulls(spark):
    df = spark.createDataFrame([("a", 6, ["Disorder X"], 0.9), ("a", 6, ["disorder"], None), (None, 6, ["disorder"], 0.9), ("b", 6, ["disorder"], 0.9), ("a", 7, ["disorder"], 0.9), ("a", 6, ["finding"], 0.9)], "client_idcode string, cui long, types array<string>, acc double")
    cohort = spark.createDataFrame([("a",)], "client_idcode string")
    assert [tuple(r)[:2] for r in S.select_annotations(df, types=["disorder"], codes=[6], clients=cohort).collect()] == [("a", 6)]
    assert S.select_annotations(df).count() == 4


def test_entries_are_filtered_by_their_own_time(spark):
    mark = "Entered on -"
    text = f"first {mark} 05-Jan-2024 08:30 second {mark} 20-Mar-2024 09:00 "
    df = spark.createDataFrame([(1, text, datetime(2024, 3, 1), "note"), (2, "no mark", datetime(2024, 1, 6), "note"), (3, None, datetime(2024, 1, 6), "note")], "id long, text string, ts timestamp, d string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = sorted((r["id"], r["chunk"]) for r in T.fetch_documents(df, "id", "text", "ts", "d", date(2024, 1, 1), date(2024, 1, 31), split=True).collect())
    assert got == [(1, 0), (2, None)]
    assert [r["id"] for r in T.fetch_documents(df, "id", "text", "ts", "d", date(2024, 1, 1), date(2024, 1, 31)).collect()] == [2]
