"""Searches over texts: terms, fuzzy terms, patterns, headed sections, filters on annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.text import partial_similarity
from tidewheel.operators.matching import contained, once, partly_like, similar_pairs, term_table
from tidewheel.operators.numbering import first_by_mark


def multi_term(docs: DataFrame, text: str, terms: list[str] | DataFrame) -> DataFrame:
    """A row for each document and term it contains (any case), with search_term; equal rows once.

    A hundred thousand terms, as a list or a table (term), take one pass over the texts (operators/matching.py).
    """
    return once(contained(docs, text, terms))


def fuzzy_terms(rows: DataFrame, column: str, terms: list[str] | DataFrame, least: float = 80.0, best: int | None = 5) -> DataFrame:
    """Rows whose value is similar (above 0, to 100) to a term; of each term only the best values count, unless best is None.

    Distinct values are scored, not rows, and only those that share a piece with a term.
    """
    values = rows.select(F.lower(column).alias("value")).where("value is not null").distinct()
    scored = similar_pairs(values, term_table(rows.sparkSession, terms).select(F.col("low").alias("term")).distinct(), least)
    if best is not None:
        scored = scored.withColumn("r", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("score"), "value"))).where(F.col("r") <= best)
    kept = scored.select("value").distinct()
    return rows.join(kept, F.lower(rows[column]) == kept["value"], "left_semi")


def regex_counts(rows: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """A column for each pattern: how often it occurs, in any case."""
    return rows.select("*", *(F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"(?i){p}")).alias(n) for n, p in patterns.items()))


def regex_findall(text: Column, pattern: str) -> Column:
    """All matches, lower-cased, joined by a comma and a line break."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0)), ",\n")


def regex_extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match's group; empty if there is none."""
    return F.regexp_extract(text, pattern, group)


def section(text: Column, heading: str, others: list[str]) -> Column:
    """Text after a heading, up to any of the others or the end."""
    ends = "|".join([*others, "$"])
    return F.regexp_extract(text, f"(?is){heading}(.*?)(?:{ends})", 1)


def id_numbers(text: Column, mark: str = "NHS", digits: int = 10) -> Column:
    """Numbers of so many digits (spaces allowed between) after a mark, without the spaces."""
    found = F.regexp_extract_all(text, F.lit(rf"{mark}\s*((?:\d\s*){{{digits}}})"), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, r"\s", ""))


def annotation_filter(rows: DataFrame, types: list[str] | None = None, values: dict[str, list[str]] | None = None, least: dict[str, float] | None = None, loose: bool = False) -> DataFrame:
    """types: some type is in the list (loose: contains an entry), in any case; values: the text is in the list; least:
    the number is so large or larger. Columns that the table lacks are passed over; null or malformed ones fail."""
    keep = F.lit(True)
    if types and "types" in rows.columns:
        low = [t.lower() for t in types]
        if loose:
            keep = keep & F.exists("types", lambda t: _any(F.lower(t).contains(x) for x in low))
        else:
            keep = keep & F.arrays_overlap(F.transform("types", F.lower), F.array(*map(F.lit, low)))
    for c, own in (values or {}).items():
        if c in rows.columns:
            keep = keep & F.col(c).isin(own)
    for c, limit in (least or {}).items():
        if c in rows.columns:
            keep = keep & (F.col(c).try_cast("double") >= limit)
    return rows.where(keep)


#: The columns of an annotation that must not be null for it to count.
NEEDED = (
    "client_idcode", "pretty_name", "cui", "type_ids", "types", "source_value", "detected_name", "acc", "id",
    "Time_Value", "Time_Confidence", "Presence_Value", "Presence_Confidence", "Subject_Value", "Subject_Confidence", "updatetime",
)


def select_annotations(rows: DataFrame, context: dict[str, list[str]] | None = None, least: dict[str, float] | None = None, types: list[str] | None = None, codes: list | None = None, clients: DataFrame | None = None, needed: tuple[str, ...] = NEEDED) -> DataFrame:
    """Annotations without a null in the needed columns (those the table has), of a cohort (one column client_idcode), that
    pass the context filter (as annotation_filter has it, loosely) and are of one of the codes; what isn't given does not count."""
    from tidewheel.sources.tables import keyed

    out = rows.na.drop(subset=[c for c in needed if c in rows.columns])
    if clients is not None:
        out = keyed(out, clients, "client_idcode")
    out = annotation_filter(out, types, context, least, loose=True)
    return out if codes is None else out.where(F.col("cui").isin(codes))


def _any(tests) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def list_column(text: Column) -> Column:
    """Lists as text, with either quote (['a', "b"]), as arrays; malformed ones are null."""
    return F.from_json(F.replace(text, F.lit("'"), F.lit('"')), "array<string>", {"mode": "PERMISSIVE"})


def first_last(rows: DataFrame, column: str, values: list, n: int, ts: str, mode: str = "earliest", by: str | None = None, tie: str | None = None) -> DataFrame:
    """Rows with one of the values, by time: the first or last n, of all or of each key."""
    if mode not in ("earliest", "latest"):
        raise ValueError("mode is earliest or latest")
    order = [F.col(c).asc() if mode == "earliest" else F.col(c).desc() for c in (ts, tie) if c]
    kept = rows.where(F.col(column).isin(values))
    if by is None:
        return kept.orderBy(*order).limit(n)
    return kept.withColumn("tw_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("tw_n") <= n).drop("tw_n")


def has_any_code(rows: DataFrame, column: str, codes: list[str], key: str) -> DataFrame:
    """key, has_code: whether any of the key's values contains any code."""
    held = _any(F.col(column).cast("string").contains(c) for c in codes)
    return rows.groupBy(key).agg(F.coalesce(F.bool_or(held), F.lit(False)).alias("has_code"))


def in_all_lists(rows: DataFrame, column: str, lists: list[list]) -> DataFrame:
    keep = F.lit(True)
    for own in lists:
        keep = keep & F.col(column).isin(own)
    return rows.where(keep)


def term_groups(docs: DataFrame, key: str, text: str, groups: dict[str, list[str]], least: int, total: int, threshold: float = 75.0) -> DataFrame:
    """key, matched_group: rows like a term of a group, at least so many of each group, and the rest of the total in proportion.

    Rows are taken in the order of a hash, so a rerun takes the same; no group meets in one task (first_by_mark).
    """
    spark = docs.sparkSession
    names = spark.createDataFrame([(t.lower(), g) for g, ts in groups.items() for t in ts], "search_term string, matched_group string").distinct()
    found = partly_like(docs.select(key, text), text, names.select(F.col("search_term").alias("term")), threshold).select(key, "search_term")
    hits = found.join(F.broadcast(names), "search_term").select(key, "matched_group").distinct()  # names: the caller's
    counts = hits.groupBy("matched_group").agg(F.count("*").alias("n"))
    sums = counts.agg(F.sum("n").alias("all"), F.sum(F.least("n", F.lit(least))).alias("first"))
    quota = F.col("first_n") + F.floor(F.greatest(F.lit(total) - F.col("first"), F.lit(0)) * F.col("n") / F.col("all"))
    quotas = counts.join(F.broadcast(sums)).select("matched_group", F.least("n", F.lit(least)).alias("first_n"), "n", "all", "first").select("matched_group", quota.alias("quota"))
    return first_by_mark(hits, ["matched_group"], key, quotas).groupBy(key).agg(F.min("matched_group").alias("matched_group"))


def _like_columns(rows: DataFrame, terms: list[str] | DataFrame, columns: list[str], key: str, least: float) -> DataFrame:
    """key, tw_column, search_term: the columns of each row that are partly like a term; one scan for all terms and columns."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("tw_column"), F.col(c).cast("string").alias("tw_text")) for c in columns)))
    return partly_like(rows.select(key, each.alias("e")).select(key, "e.*"), "tw_text", terms, least).select(key, "tw_column", "search_term")


def matched_columns(rows: DataFrame, term: str, columns: list[str], least: float = 80.0) -> DataFrame:
    """Rows where a column is partly like a term, with search_term and the matched columns."""
    hit = lambda c: F.when(partial_similarity(F.lit(term.lower()), F.lower(F.coalesce(F.col(c), F.lit("")))) >= least, F.lit(c))
    found = F.array_compact(F.array(*map(hit, columns)))
    return rows.withColumn("matched", found).where(F.size("matched") > 0).withColumn("search_term", F.lit(term))


def matched_columns_multi(rows: DataFrame, terms: list[str] | DataFrame, columns: list[str], key: str, least: float = 80.0) -> DataFrame:
    """One row a key: the least of each column over the key's matched rows, the sorted terms, the set of matched columns."""
    carried = F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias("tw_row")
    found = _like_columns(rows.select(F.struct(F.col(key).alias("key"), carried).alias("tw_key"), *columns), terms, columns, "tw_key", least)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ", ")
    return found.groupBy(F.col("tw_key.key").alias(key)).agg(*(F.min(f"tw_key.tw_row.{c}").alias(c) for c in columns), joined("search_term").alias("search_terms"), joined("tw_column").alias("matched"))
