"""Vectors: rows are dealt by client and slice once, and put in order where they lie; large slices go over many tasks."""

import random
from datetime import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewheel.operators import carry, quantiles
from tidewheel.operators import features as X

SF = "/root/testdata/sf0.001"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_features_are_not_dealt_again(spark):
    """Before: every feature's row was shuffled by client, slice and feature, and medians made buffers of objects."""
    plan = executed(entry.queries()["assemble_vectors"](spark, SF))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(client_id" in line]
    assert dealt and not any("feature" in line and "pretty_name" not in line for line in (d.split("hashpartitioning(")[1].split(")")[0] for d in dealt))
    assert "ObjectHashAggregate" not in plan


def test_slices_are_the_same_either_way(spark, monkeypatch):
    r = random.Random(9)
    items = {"bmi": "B", "height": "H", "weight": "W"}
    rows = [(r.choice("abcd"), r.choice([*"BHWST", None]), r.choice([None, float(r.randint(0, 60))]), r.choice(["x-%", "y", None])) for _ in range(600)]
    rows += [("e", "B", 20.0, None), ("f", "S", None, "y"), ("g", "W", 3.0, "y")]
    df = spark.createDataFrame(rows, "client_id string, item string, value double, text string").withColumn("slice_start", F.lit("2024-01-01").cast("date"))
    parts = lambda: [X.body_part(items), X.presence_part("s_", "S", clean=True), X.presence_part("t_", "T"), X.flags_part({"has_y": "y"}, False, "T"), X.counts_part({"n_y": "y"}, "S")]
    both = []
    for large in (10**6, 60):
        monkeypatch.setattr(quantiles, "LARGE", large)
        monkeypatch.setattr(carry, "HOT", 10)
        both.append(sorted(map(tuple, X.by_slice(df, parts()).withColumn("value", F.round("value", 9)).collect())))
    assert both[0] == both[1]
    got = {(c, f): v for c, _, f, v in both[0]}
    for c in "abcd":
        own = sorted(v for k, i, v, _ in rows if k == c and i == "B" and v is not None and 6 < v < 200)
        n = len(own)
        assert got[c, "bmi_median"] == (own[(n - 1) // 2] + own[n // 2]) / 2
        assert got[c, "s_x_pct"] == got[c, "s_y"] == got[c, "t_x-%"] == got[c, "has_y"] == 1
        assert got[c, "n_y"] == sum(k == c and i == "S" and t == "y" for k, i, _, t in rows)
    assert got["e", "bmi_median"] == 20 and {f for c, f in got if c == "f"} == {"s_y", "n_y"} and not any(c == "g" for c, _ in got)


def test_groups_are_counted_by_hash_first(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 2)  # so that groups share a hash's bucket
    df = spark.range(900).select(F.when(F.col("id") < 500, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("k"), "id")
    assert [x["k"] for x in quantiles.large_groups(df, ["k"], 100).collect()] == ["big"]
    assert quantiles.large_groups(df.where("k <> 'big'"), ["k"], 100) is None and quantiles.large_groups(df, ["k"], 500) is None


def test_middle_values(spark):
    rows = [(k, v, datetime(2024, 1, 1)) for k, vs in {"a": [3.0, 1.0], "b": [5.0], "c": [2.0, 2.0, 1.0, 1.0, 9.0], "d": [4.0, None, 8.0, 6.0]}.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double, ts timestamp")
    got = {x["k"]: (x["n"], x["median"], x["mode"]) for x in quantiles.with_order_statistics(df, ["k"], "v", [F.count("v").alias("n")]).collect()}
    assert got == {"a": (2, 2.0, 1.0), "b": (1, 5.0, 5.0), "c": (5, 2.0, 1.0), "d": (3, 6.0, 4.0)}


def test_maps_are_made_where_features_lie(spark):
    """Before: the union of all features was shuffled."""
    lines = executed(entry.queries()["run_cohort"](spark, SF)).splitlines()
    at = next(i for i, line in enumerate(lines) if line.strip(" :+-*").startswith("Union") and i < 30)
    assert not any("Exchange" in line for line in lines[:at])
