"""Joins in time: nearest results, rows before or after an index; joins of annotations with what describes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.times import DAY
from tidewheel.operators.carry import nearest


def nearest_results(template: DataFrame, results: DataFrame, row: str, before: float = 42, after: float = 350, tests: list[str] | None = None) -> DataFrame:
    """row, test, value: of each test the result nearest to ts inside the open interval (ts - before, ts + after) days.

    template: row (a key), client_id, ts; results: client_id, test, ts, value; tests: those looked for, else all that a
    client has. Of equally near results the earlier one counts, then the smaller value. Each template row is compared
    with the results next to it in time, one on either side, however many lie in the interval (operators/carry.py).
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    left = template.where("ts is not null and client_id is not null").select(F.col(row).alias("row"), "client_id", micros.alias("t"))
    right = results.where("ts is not null and client_id is not null and test is not null").select("client_id", "test", "value", micros.alias("t"))
    if tests is None:
        left = left.join(right.select("client_id", "test").distinct(), "client_id")
    else:
        right, left = right.where(F.col("test").isin(tests)), left.withColumn("test", F.explode(F.array(*map(F.lit, tests))))
    return nearest(left, right, ["client_id", "test"], round(before * DAY), round(after * DAY)).select("row", "test", "value")


def matcher(template: DataFrame, results: DataFrame, row: str, tests: list[str], before: float = 42, after: float = 350) -> DataFrame:
    """The template with a column for each test, null where none is near; rows without a time are left out."""
    found = nearest_results(template, results, row, before, after, tests).groupBy("row").pivot("test", tests).agg(F.first("value"))
    kept = template.where("ts is not null")
    return kept.join(found, kept[row] == found["row"], "left").drop("row") if row != "row" else kept.join(found, "row", "left")


def relative_to_index(rows: DataFrame, index: DataFrame, when: str = "after", candidates: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Rows strictly after (or before) their client's index time; the time is the first candidate column that is not null."""
    if when not in ("after", "before"):
        raise ValueError("when is after or before")
    time = F.coalesce(*(F.col(c) for c in candidates if c in rows.columns))
    marks = index.select("client_id", F.col("index_ts").alias("tw_index"))
    joined = rows.withColumn("tw_time", time).join(marks, "client_id")
    return joined.where(F.col("tw_time") > F.col("tw_index") if when == "after" else F.col("tw_time") < F.col("tw_index")).drop("tw_time", "tw_index")


def anchors(rows: DataFrame, column: str, codes: list, mode: str = "earliest", ts: str = "ts") -> DataFrame:
    """column, ts: the earliest or latest time of each code."""
    if mode not in ("earliest", "latest"):
        raise ValueError("mode is earliest or latest")
    return rows.where(F.col(column).isin(codes)).groupBy(column).agg((F.min if mode == "earliest" else F.max)(ts).alias(ts))


def relative_to_codes(rows: DataFrame, column: str, codes: list, mode: str = "earliest", temporal: str = "before", ts: str = "ts") -> DataFrame:
    """All rows up to the first (before) or from the last (after) of the codes' anchor times."""
    if temporal not in ("before", "after"):
        raise ValueError("temporal is before or after")
    marks = anchors(rows, column, codes, mode, ts)
    one = marks.agg((F.min if temporal == "before" else F.max)(ts).alias("tw_mark"))  # a single row
    held = rows.join(F.broadcast(one))
    return held.where(F.col(ts) <= F.col("tw_mark") if temporal == "before" else F.col(ts) >= F.col("tw_mark")).drop("tw_mark")


def join_codes(annotations: DataFrame, codes: DataFrame, inner: bool = False) -> DataFrame:
    """Annotations with external codes (concept_id, target); 1:n, unmatched ones kept unless inner."""
    return annotations.join(codes, annotations["cui"] == codes["concept_id"], "inner" if inner else "left").drop("concept_id")


def join_documents(annotations: DataFrame, documents: DataFrame, key: str = "document_guid") -> DataFrame:
    """Annotations left-joined with their document; a document's column that annotations have, too, is left out."""
    own = [c for c in documents.columns if c == key or c not in annotations.columns]
    return annotations.join(documents.select(*own), key, "left")


def human_labels(annotations: DataFrame, labels: DataFrame, window: int, label: Column) -> DataFrame:
    """Annotations with the label of a person's row whose text window and value are equal."""
    near = lambda c: F.substring(F.col(c), 1, window)
    a = annotations.withColumn("tw_near", near("text_sample"))
    b = labels.select(near("text_sample").alias("tw_near"), F.col("source_value").alias("tw_value"), label.alias("label")).distinct()
    return a.join(b, (a["tw_near"] == b["tw_near"]) & (a["source_value"] == b["tw_value"])).drop("tw_near", "tw_value")


def first_rows_differ(results: dict[str, DataFrame], column: str, ts: str, tie: str) -> DataFrame:
    """client_id and a column for each result: the texts of clients' first rows, where those of two results differ. Clients
    that a result lacks are compared over the others."""
    long = None
    for name, rows in results.items():
        own = rows.select("client_id", F.lit(name).alias("tw_name"), F.struct(F.col(ts), F.col(tie)).alias("tw_at"), F.col(column).alias("tw_text"))
        long = own if long is None else long.unionByName(own)
    firsts = long.groupBy("client_id").agg(*(F.min_by(F.struct("tw_text"), F.when(F.col("tw_name") == n, F.col("tw_at"))).alias(n) for n in results))
    texts = F.array_compact(F.array(*(F.col(n) for n in results)))
    return firsts.where(F.size(F.array_distinct(texts)) > 1).select("client_id", *(F.col(f"{n}.tw_text").alias(n) for n in results))


def ner_results(fp: DataFrame, fn: DataFrame, tp: DataFrame, key: str, counts: DataFrame | None = None) -> DataFrame:
    """key, fp, fn, tp, precision, recall, f1 and count by concept, from tables (key, value) of the three kinds and of how
    often it occurs; what a concept lacks is null, and counts as 0 in the ratios."""
    parts = {"fp": fp, "fn": fn, "tp": tp} | ({"count": counts} if counts is not None else {})
    m, z = merge_measures(parts, key), lambda c: F.coalesce(F.col(c), F.lit(0.0))
    ratio = lambda c: F.try_divide(z("tp"), z("tp") + z(c))
    f1 = F.try_divide(2 * z("tp"), 2 * z("tp") + z("fp") + z("fn"))
    return m.select(key, "fp", "fn", "tp", ratio("fp").alias("precision"), ratio("fn").alias("recall"), f1.alias("f1"), *(["count"] if counts is not None else []))


def merge_measures(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Outer join of (key, value) tables as one aggregation, a column each."""
    long = None
    for name, rows in parts.items():
        own = rows.select(key, F.lit(name).alias("tw_name"), F.col("value").cast("double").alias("tw_value"))
        long = own if long is None else long.unionByName(own)
    return long.groupBy(key).pivot("tw_name", list(parts)).agg(F.first("tw_value"))
