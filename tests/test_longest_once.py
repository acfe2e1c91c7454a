"""Longest matches: texts are read once, and each word meets the vocabulary without what follows it."""

import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewheel.operators import annotations as A


def test_texts_are_read_once(spark):
    """Before: matches were made three times."""
    plan = entry.queries()["annotate_longest"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "documents.parquet" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("broadcast", [True, False])
def test_longest_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(A, "VOCABULARY", 500_000 if broadcast else 0)
    r = random.Random(11)
    concepts = sorted({" ".join(r.choice("abcd") for _ in range(r.choice((1, 2, 2, 3, 4)))) for _ in range(40)})
    texts = [(i if i < 28 else None, " ".join(r.choice("abcdx") for _ in range(r.randrange(14)))) for i in range(29)] + [(40, None), (41, "")]
    vocabulary = spark.createDataFrame([(w, i) for i, w in enumerate(concepts)], "word string, cui long")
    docs = spark.createDataFrame(texts, "id long, text string")
    matches = A.annotate(docs, vocabulary, "id", "text")
    assert sorted(matches.columns) == ["cui", "id", "position", "word"]
    want, kept = [], []
    for i, t in texts:
        own = (t or "").split()
        met = [(p, len(w.split()), w) for p in range(len(own)) for w in concepts if own[p : p + len(w.split())] == w.split()]
        want += [(str(i), p, w) for p, _, w in met]
        beaten = lambda p, n: any(q < p + n and q + m > p and (m > n or (m == n and q < p)) for q, m, _ in met)
        kept += [(str(i), p, w) for p, n, w in met if i is None or not beaten(p, n)]
    rows = lambda df: sorted((str(x["id"]), x["position"], x["word"]) for x in df.collect())
    assert rows(matches) == sorted(want) and len(want) > 100
    got = rows(A.longest(matches, "id"))
    assert got == sorted(kept)  # without an id, all stay, as in the SQL


def test_long_texts_take_linear_time(spark):
    vocabulary = spark.createDataFrame([("heart", 1), ("heart failure", 2), ("failure of growth", 3)], "word string, cui long")
    docs = spark.range(1).select("id", F.repeat(F.lit("heart failure of growth x "), 60_000).alias("text"))
    started = time.monotonic()
    assert A.longest(A.annotate(docs, vocabulary, "id", "text"), "id").count() == 60_000
    assert time.monotonic() - started < 60
