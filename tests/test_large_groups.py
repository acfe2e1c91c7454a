"""Medians and modes of groups that don't fit in a task, overlapping concepts, contexts, pairs that can't be among the top."""

import random
from datetime import datetime
from statistics import median

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import annotations as A
from tidewheel.operators import carry, quantiles
from tidewheel.operators import features as X


@pytest.mark.parametrize("hot", [5, 40, 10**6])
def test_order_statistics(spark, hot):
    r = random.Random(2)
    rows = [(g, r.choice([None, round(r.gauss(0, 30), 1), float(r.randint(0, 5))])) for g in ["big"] * 600 + ["even"] * 40 + ["one", None, None, None] for _ in range(1)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    for share in (0.5, 0.25, 1.0, 0.0):
        got = {x["g"]: (x["quantile"], x["mode"]) for x in quantiles.order_statistics(df, ["g"], "v", share, hot).collect()}
        for g in {g for g, v in rows if v is not None}:
            own = sorted(v for k, v in rows if k == g and v is not None)
            at = (len(own) - 1) * share
            low, high = own[int(at)], own[min(int(at) + 1, len(own) - 1)]
            assert got[g] == (pytest.approx(low + (high - low) * (at - int(at))), min(sorted(set(own)), key=lambda v: (-own.count(v), v)))
            assert share != 0.5 or got[g][0] == pytest.approx(median(own))
        assert set(got) == {g for g, v in rows if v is not None}


def test_bloods_are_the_same_either_way(spark, monkeypatch):
    r = random.Random(5)
    rows = [(r.choice("ab"), "2024-01-01", datetime(2024, 1, 1, r.randint(0, 23)), r.choice(["hb", "na"]), float(r.randint(0, 40))) for _ in range(800)]
    rows += [("c", "2024-01-01", datetime(2024, 1, 1), "hb", float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "client_id string, slice_start string, ts timestamp, item string, value double").withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "slice_start": F.col("slice_start").cast("date")})
    both = []
    for large in (10**6, 150):
        monkeypatch.setattr(quantiles, "LARGE", large)
        monkeypatch.setattr(carry, "HOT", 10)
        both.append(sorted(map(tuple, X.bloods(df, datetime(2024, 2, 1)).withColumn("value", F.round("value", 9)).collect())))
        both.append(sorted(map(tuple, X.scores(df, {"hb": "h"}).withColumn("value", F.round("value", 9)).collect())))
    assert both[0] == both[2] and both[1] == both[3] and len(both[0]) > 40


def test_longest_of_overlapping_matches(spark):
    vocabulary = spark.createDataFrame([("heart", 1), ("heart failure", 2), ("failure of growth", 3), ("growth", 4), ("heart failure", 5), ("of", 6), ("growth of heart", 7)], "word string, cui long")
    docs = spark.createDataFrame([(1, "heart failure of growth"), (2, "heart failure heart"), (3, "of heart growth"), (4, "growth of heart failure"), (5, None)], "id long, text string")
    got = sorted((r["id"], r["position"], r["cui"]) for r in A.longest(A.annotate(docs, vocabulary, "id", "text"), "id").collect())
    assert got == [(1, 1, 3), (2, 0, 2), (2, 0, 5), (2, 2, 1), (3, 0, 6), (3, 1, 1), (3, 2, 4), (4, 0, 7)]


def test_context_of_mentions(spark):
    docs = spark.createDataFrame([(1, "No sign of fever. Mother had fever, previously; he will not have fever"), (2, "fever"), (3, "no a b c d e fever")], "id long, text string")
    vocabulary = spark.createDataFrame([("fever", 1)], "word string, cui long")
    rows = A.in_context(docs, A.annotate(docs, vocabulary, "id", "text"), "id", "text").orderBy("id", "position").collect()
    assert [(r["id"], r["Presence_Value"], r["Time_Value"], r["Subject_Value"]) for r in rows] == [
        (1, "False", "Recent", "Patient"), (1, "True", "Recent", "Family"), (1, "False", "Future", "Patient"), (2, "True", "Recent", "Patient"), (3, "True", "Recent", "Patient"),
    ]


@pytest.mark.parametrize("tried", [2, 4, 200])
@pytest.mark.parametrize("top", [1, 7, 1000])
def test_top_pairs_without_all_pairs(spark, top, tried):
    r = random.Random(8)
    rows = [(f"c{i}", int(r.paretovariate(0.7)) % 40) for i in range(60) for _ in range(6)]
    df = spark.createDataFrame([*rows, ("x", None)], "client_id string, cui long")
    got = [tuple(x) for x in A.cooccurring(df, top, tried).collect()]
    want = sorted(map(tuple, A.cooccurring(df).collect()), key=lambda x: (-x[2], x[0], x[1]))[:top]
    assert got == want
