"""Filling and nearest results: clients cut into ranges of time give what one range gives, and what a plain loop gives."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewheel.functions.times import DAY
from tidewheel.operators import carry
from tidewheel.operators import joins as J
from tidewheel.operators import matrix as M


def fill(rows, forward, backward):
    """(key, t, tie, x, y) in order, filled by hand."""
    out = []
    for k in {r[0] for r in rows}:
        own = sorted((list(r) for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for c in (3, 4):
            if forward:
                last = None
                for r in own:
                    last = r[c] = r[c] if r[c] is not None else last
            if backward:
                last = None
                for r in reversed(own):
                    last = r[c] = r[c] if r[c] is not None else last
        out += [tuple(r) for r in own]
    return sorted(out, key=str)


def sparse(seed=1):
    r = random.Random(seed)
    rows = [("hot", r.choice([r.randint(0, 400), None]) if i % 50 == 0 else r.randint(0, 400), i, r.choice([None, None, None, float(i)]), None if i % 9 else float(-i)) for i in range(900)]
    rows += [(None, i % 7, i, None if i % 3 else 1.0 * i, None) for i in range(30)]
    return rows + [("cold", i, i, None if i != 4 else 7.0, None) for i in range(9)]


@pytest.mark.parametrize("hot", [20, 300, 10**6])
@pytest.mark.parametrize(("forward", "backward"), [(True, True), (True, False), (False, True)])
def test_filled(spark, forward, backward, hot):
    rows = sparse()
    df = spark.createDataFrame(rows, "k string, t long, tie long, x double, y double").repartition(5)
    got = carry.filled(df, "k", ["t", "tie"], ["x", "y"], forward, backward, hot)
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == fill(rows, forward, backward)
    assert carry.filled(df.limit(0), "k", ["t", "tie"], ["x"], forward, backward, hot).count() == 0


def test_a_hot_client_goes_over_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("one").alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), "id")
    ranged, several = carry.in_ranges(df, ["k"], "t", hot=1000)
    sizes = [r["count"] for r in ranged.groupBy("tw_range").count().collect()]
    assert several and len(sizes) > 20 and max(sizes) < 2000


def test_impute_is_linear(spark):
    """Half a million rows of one client, mostly null; a frame to the partition's end for each row took a minute for 40,000."""
    df = spark.range(500_000).select(F.lit("one").alias("k"), "id", F.when(F.col("id") % 1000 == 500, F.col("id") * 1.0).alias("x"))
    began = time.time()
    got = M.impute(df, "k", "id", ["x"], mean=False).agg(F.count("x"), F.sum("x")).first()
    assert got[0] == 500_000 and time.time() - began < 60
    assert got[1] == sum((500 if i < 500 else (i - 500) // 1000 * 1000 + 500) for i in range(500_000))


def near(template, results, low, high):
    out = {}
    for row, client, t in template:
        if t is None or client is None:
            continue
        for test in {x[1] for x in results if x[0] == client and x[1] is not None}:
            inside = [(abs(r - t), r, v is not None, v or 0.0, v) for c, k, r, v in results if c == client and k == test and r is not None and t - low < r < t + high]
            if inside:
                out[row, test] = min(inside)[4]
    return out


@pytest.mark.parametrize("hot", [10, 150, 10**6])
@pytest.mark.parametrize(("before", "after"), [(3, 1), (0.5, 8), (2, 2)])
def test_nearest_results(spark, monkeypatch, before, after, hot):
    monkeypatch.setattr(carry, "HOT", hot)
    r, start = random.Random(7), datetime(2024, 1, 1)
    at = lambda: start + timedelta(hours=r.randint(0, 24 * 40))
    template = [(i, r.choice(["a", "a", "b", "lonely", None]), r.choice([at(), at(), at(), None])) for i in range(150)]
    results = [(r.choice(["a", "a", "b", "c", None]), r.choice(["hb", "na", None]), r.choice([at(), at(), at(), None]), r.choice([1.0, 2.0, 3.5])) for _ in range(500)]
    t = spark.createDataFrame(template, "row long, client_id string, ts timestamp").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    s = spark.createDataFrame(results, "client_id string, test string, ts timestamp, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    micros = lambda x: None if x is None else (x - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    want = near([(i, c, micros(x)) for i, c, x in template], [(c, k, micros(x), v) for c, k, x, v in results], before * DAY, after * DAY)
    assert {(x["row"], x["test"]): x["value"] for x in J.nearest_results(t, s, "row", before, after).collect()} == want
    assert {(x["row"], x["test"]): x["value"] for x in J.nearest_results(t, s, "row", before, after, ["hb"]).collect()} == {k: v for k, v in want.items() if k[1] == "hb"}


def test_dense_results_are_not_paired(spark):
    """100,000 results of one client inside the window of 2,000 template rows: rows, not pairs."""
    minutes = lambda c: (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(mins=c)).cast("timestamp_ntz")
    results = spark.range(100_000).select(F.lit("a").alias("client_id"), F.lit("hb").alias("test"), minutes(F.col("id").cast("int")).alias("ts"), (F.col("id") * 1.0).alias("value"))
    template = spark.range(2000).select(F.col("id").alias("row"), F.lit("a").alias("client_id"), (minutes((F.col("id") * 50).cast("int")) + F.make_interval(secs=F.lit(20))).cast("timestamp_ntz").alias("ts"))
    began = time.time()
    got = J.nearest_results(template, results, "row", 400, 400).agg(F.count("*"), F.sum("value")).first()
    assert tuple(got) == (2000, sum(50.0 * i for i in range(2000))) and time.time() - began < 30
