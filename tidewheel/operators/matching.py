"""Many terms against many texts: terms contained in a text, strings within an edit distance, stretches of a text like a term.

No value is compared with all terms. A term within d edits of a value has, cut into d + 1 pieces, one piece that stands
in the value unchanged and near its place, so pieces are joined by equality and only such pairs are measured. Where a
piece may stand anywhere in a text, an automaton over all pieces reads each text once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewheel.functions.text import partial_similarity, similarity

#: Terms up to which texts are searched by an expression, without Python workers.
FEW = 32
#: Terms of one automaton; more are searched in several passes.
PASS = 1_000_000
_EPS = 1e-9
#: The automaton of this worker, by number.
_AUTOMATA: dict[str, object] = {}


def term_table(spark: SparkSession, terms: list[str] | DataFrame) -> DataFrame:
    """term, low (in lower case), of a list or a table's column term: distinct, without nulls."""
    rows = spark.createDataFrame([(t,) for t in terms], "term string") if isinstance(terms, list) else terms.select("term")
    return rows.where("term is not null").distinct().withColumn("low", F.lower("term"))


def _passes(terms: DataFrame, size: int) -> Iterator[list[tuple[str, str]]]:
    """The terms in lists of about size, each held by the driver and the workers in turn."""
    n = max(1, -(-terms.count() // size))
    for k in range(n):
        yield [tuple(r) for r in terms.where(F.pmod(F.xxhash64("low"), F.lit(n)) == k).select("term", "low").orderBy("term").collect()]


def _automaton(number: str, patterns: dict[str, list[int]]):
    """The automaton of this worker, made when the first text comes."""
    if number not in _AUTOMATA:
        import ahocorasick

        made = ahocorasick.Automaton()
        for pattern, numbers in patterns.items():
            made.add_word(pattern, numbers)
        made.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[number] = made
    return _AUTOMATA[number]


def _finder(spark: SparkSession, patterns: dict[str, list[int]]):
    """A function of a text column: the numbers (distinct, rising) that belong to the patterns found in it."""
    held, number = spark.sparkContext.broadcast(patterns), uuid.uuid4().hex

    @pandas_udf("array<int>")
    def find(texts: pd.Series) -> pd.Series:
        automaton = _automaton(number, held.value)
        return texts.map(lambda t: sorted({n for _, numbers in automaton.iter(t) for n in numbers}) if t else [])

    return find


def _found(spark: SparkSession, text: Column, pieces: list[list[str]]) -> Column:
    """An array of the numbers of those lists of pieces of which the text holds one; an empty piece is in every text."""
    if len(pieces) <= FEW:
        hits = []
        for i, own in enumerate(pieces):
            held = F.lit(False)
            for p in dict.fromkeys(own):
                held = held | text.contains(p)
            hits.append(F.when(held, F.lit(i)))
        return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<int>")
    patterns: dict[str, list[int]] = {}
    everywhere = [i for i, own in enumerate(pieces) if "" in own]
    for i, own in enumerate(pieces):
        for p in own:
            if p:
                patterns.setdefault(p, []).append(i)
    found = _finder(spark, patterns)(F.coalesce(text, F.lit("")))
    found = F.when(text.isNotNull(), found)
    return F.array_union(found, F.array(*map(F.lit, everywhere))) if everywhere else found


def contained(rows: DataFrame, text: str, terms: list[str] | DataFrame) -> DataFrame:
    """A row for each row and term that its text contains, in any case, with search_term. Terms may be a table (term)."""
    spark, out, low = rows.sparkSession, None, F.lower(F.col(text))
    for own in _passes(term_table(spark, terms), PASS):
        at = F.explode(_found(spark, low, [[x] for _, x in own]))
        if len(own) <= FEW:
            part = rows.withColumn("search_term", at).withColumn("search_term", F.get(F.array(*(F.lit(t) for t, _ in own)).cast("array<string>"), F.col("search_term")))
        else:
            names = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(own)], "tw_at int, search_term string")
            part = rows.withColumn("tw_at", at).join(F.broadcast(names), "tw_at").drop("tw_at")
        out = part if out is None else out.unionByName(part)
    return out


def once(rows: DataFrame) -> DataFrame:
    """rows without those that repeat. Only rows whose hash comes more than once are compared, so texts are not shuffled."""
    hashed = rows.withColumn("tw_hash", F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)))
    twice = hashed.groupBy("tw_hash").agg(F.count("*").alias("tw_n")).where("tw_n > 1").select("tw_hash")
    some = hashed.join(twice, "tw_hash", "left_semi").drop("tw_hash").dropDuplicates()
    return hashed.join(twice, "tw_hash", "left_anti").drop("tw_hash").unionByName(some)


# --- whole strings ------------------------------------------------------------------------------------


def _edits(a: Column, b: Column, least: float) -> Column:
    """The most edits at which strings of these lengths are similar enough."""
    return F.floor(F.greatest(a, b) * (1 - least / 100) + _EPS).cast("int")


def _lengths(n: Column, least: float) -> Column:
    """The lengths that a string similar to one of length n may have."""
    return F.sequence(F.ceil(n * (least / 100) - _EPS).cast("int"), F.floor(n / (least / 100) + _EPS).cast("int"))


def _piece_bounds(length: Column, d: Column, i: Column) -> tuple[Column, Column]:
    start = F.floor(i * length / (d + 1)).cast("int")
    return start, (F.floor((i + 1) * length / (d + 1)).cast("int") - start)


def similar_pairs(values: DataFrame, terms: DataFrame, least: float) -> DataFrame:
    """value, term, score: all pairs of the distinct values and terms of a similarity (0 to 100) of least or more.

    least is above 0. Strings so short that a piece would be empty meet by their lengths alone.
    """
    if not 0 < least <= 100:
        raise ValueError("least is above 0 and 100 at most")
    t, v = F.length("term"), F.length("value")
    term_lengths = [r[0] for r in terms.select(t.alias("n")).distinct().limit(10_001).collect()]
    key = lambda i, piece: F.xxhash64("tl", "vl", i, piece).alias("key")
    d, i = _edits(F.col("tl"), F.col("vl"), least), F.col("i")
    numbers = F.when(d < F.col("tl"), F.sequence(F.lit(0), d)).otherwise(F.array(F.lit(-1)))
    start, size = _piece_bounds(F.col("tl"), d, i)
    # a term's pieces, for each length of value
    by_term = terms.select("term", t.alias("tl"), F.explode(_lengths(t, least)).alias("vl")).where(F.abs(F.col("tl") - F.col("vl")) <= d)
    by_term = by_term.withColumn("i", F.explode(numbers))
    by_term = by_term.select("term", key("i", F.when(i < 0, "").otherwise(F.substring(F.col("term"), start + 1, size))))
    # a value's stretches that could be one: with i edits at most before it, and d - i after it
    by_value = values.select("value", v.alias("vl"), F.explode(_lengths(v, least)).alias("tl")).where(F.abs(F.col("tl") - F.col("vl")) <= d)
    if len(term_lengths) <= 10_000:
        by_value = by_value.where(F.array_contains(F.lit(term_lengths or [-1]), F.col("tl")))
    by_value = by_value.withColumn("i", F.explode(numbers))
    gap = F.col("vl") - F.col("tl")
    low = F.greatest(F.lit(0), start - i, start + gap - (d - i))
    high = F.least(F.col("vl") - size, start + i, start + gap + (d - i))
    spots = F.when(i < 0, F.array(F.lit(-1))).when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    by_value = by_value.withColumn("at", F.explode(spots))
    by_value = by_value.select("value", key("i", F.when(i < 0, "").otherwise(F.substring(F.col("value"), F.col("at") + 1, size))))
    pairs = by_value.join(by_term, "key").select("value", "term").distinct()
    return pairs.withColumn("score", similarity(F.col("value"), F.col("term"))).where(F.col("score") >= least)


# --- stretches of a text ------------------------------------------------------------------------------


def _pieces(term: str, least: float) -> list[str]:
    d = int(len(term) * (1 - least / 100) + _EPS)
    return [term[i * len(term) // (d + 1) : (i + 1) * len(term) // (d + 1)] for i in range(d + 1)]


def partly_like(rows: DataFrame, text: str, terms: list[str] | DataFrame, least: float) -> DataFrame:
    """A row for each row and term that is similar (least or more, above 0) to a stretch of its text, in any case, with
    search_term (as it is given) and score. Rows whose text is null are left out."""
    if not 0 < least <= 100:
        raise ValueError("least is above 0 and 100 at most")
    spark, out, low = rows.sparkSession, None, F.lower(F.col(text))
    for own in _passes(term_table(spark, terms), PASS):
        names = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(own)], "tw_at int, search_term string, tw_low string")
        held = rows.where(F.col(text).isNotNull()).withColumn("tw_at", F.explode(_found(spark, low, [_pieces(x, least) for _, x in own])))
        part = held.join(F.broadcast(names), "tw_at").withColumn("score", partial_similarity(F.col("tw_low"), low)).where(F.col("score") >= least).drop("tw_at", "tw_low")
        out = part if out is None else out.unionByName(part)
    return out
