"""Searches by pieces and automata against comparing everything with everything."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import matching as G
from tidewheel.operators import search as S


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def alike(a, b):
    n = max(len(a), len(b))
    return 100.0 if n == 0 else (1 - edits(a, b) / n) * 100


def partly(term, text):
    n = len(term)
    return 100.0 if term in text else max(alike(term, text[i : i + n]) for i in range(max(len(text) - n, 0) + 1))


def strings(seed, n, letters="abcé"):
    r = random.Random(seed)
    return sorted({"".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 3, 5, 8, 12, 13]))) for _ in range(n)})


@pytest.mark.parametrize("least", [100, 90, 80, 61, 50, 30])
def test_similar_pairs(spark, least):
    values, terms = strings(1, 120), strings(2, 60)
    got = G.similar_pairs(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(t,) for t in terms], "term string"), least)
    want = {(v, t) for v in values for t in terms if alike(v, t) >= least}
    assert {(r["value"], r["term"]) for r in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("few", [1000, 0])
@pytest.mark.parametrize("size", [10**6, 20])
def test_contained(spark, monkeypatch, few, size):
    """By expression and by automaton, in one pass and in several; terms as a list and as a table."""
    monkeypatch.setattr(G, "FEW", few)
    monkeypatch.setattr(G, "PASS", size)
    terms = [*strings(3, 50, "abÉ"), "A", "AB", None]
    texts = [None, "", *strings(4, 80, "aBÉc"), "xxAbxx", "ab" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    own = {t for t in terms if t is not None}
    want = sorted((i, t) for i, x in enumerate(texts) if x is not None for t in own if t.lower() in x.lower())
    assert sorted((r["id"], r["search_term"]) for r in G.contained(df, "body", terms).collect()) == want
    table = spark.createDataFrame([(t, 1) for t in terms], "term string, other int")
    assert sorted((r["id"], r["search_term"]) for r in S.multi_term(df.union(df.limit(20)), "body", table).collect()) == want


@pytest.mark.parametrize("few", [1000, 0])
@pytest.mark.parametrize("least", [100, 80, 60])
def test_partly_like(spark, monkeypatch, few, least):
    monkeypatch.setattr(G, "FEW", few)
    terms, texts = strings(5, 30), [None, *strings(6, 60), "abcabcéabbc" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    got = {(r["id"], r["search_term"]) for r in G.partly_like(df, "body", terms, least).collect()}
    assert got == {(i, t) for i, x in enumerate(texts) if x is not None for t in terms if partly(t, x) >= least}


def test_no_terms_and_no_rows(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, body string")
    assert S.multi_term(df, "body", []).count() == 0 == G.partly_like(df, "body", [], 80).count() == S.fuzzy_terms(df, "body", [], 80).count()
    assert S.multi_term(df.limit(0), "body", ["a"]).count() == 0
    with pytest.raises(ValueError):
        G.partly_like(df, "body", ["a"], 0)


def test_columns_of_many_terms(spark):
    df = spark.createDataFrame([(1, "aspirin 75mg", "oral"), (2, "ASPIRN", None), (3, "iron", "aspirim drip"), (1, "aspirin again", "other")], "id long, a string, b string")
    got = {r["id"]: (r["a"], r["b"], r["search_terms"], r["matched"]) for r in S.matched_columns_multi(df, ["Aspirin", "iron"], ["a", "b"], "id", 80).collect()}
    assert got == {1: ("aspirin 75mg", "oral", "Aspirin", "a"), 2: ("ASPIRN", None, "Aspirin", "a"), 3: ("iron", "aspirim drip", "Aspirin, iron", "a, b")}


def test_many_terms_in_one_pass(spark):
    """100,000 terms, 2,000 texts of 50 of them: no term is looked for in each text by itself."""
    terms = spark.range(100_000).select(F.concat(F.lit("drug"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("x")).alias("term"))
    texts = spark.range(2000).select("id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(49)), lambda k: F.concat(F.lit("Drug"), F.lpad(((F.col("id") * 50 + k) % 100_000).cast("string"), 6, "0"), F.lit("X"))), " ").alias("body"))
    began = time.time()
    assert S.multi_term(texts, "body", terms).count() == 100_000 and time.time() - began < 60


def test_many_similar_strings(spark):
    """50,000 values against 5,000 terms, each with one value a letter off and one that is not near: 250 million pairs are not made."""
    name = lambda k: F.substring(F.md5(k.cast("string")), 1, 16)
    terms = spark.range(5000).select(name(F.col("id")).alias("term"))
    values = spark.range(50_000).select(F.when(F.col("id") < 5000, F.overlay(name(F.col("id")), F.lit("z"), F.lit(5))).otherwise(F.reverse(name(F.col("id") + 100_000))).alias("value"))
    began = time.time()
    assert G.similar_pairs(values, terms, 85).count() == 5000 and time.time() - began < 90


def test_equal_rows_once_without_shuffling_texts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "a")], "id long, body string")
    assert sorted(map(tuple, G.once(df).collect()), key=str) == [(1, "a"), (2, None), (3, "a")]
