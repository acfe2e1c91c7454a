"""Places within groups, found over many tasks however large a group is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a group's rows are cut into.
RANGES = 512


def offset_by(rows: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """group, bucket, n, before: rows of each bucket, and of the group's buckets before it. A group has a bounded number
    of buckets, so one task can run through them."""
    counts = rows.groupBy(*group, bucket).agg(F.count("*").alias("n"))
    past = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(past), F.lit(0)))


def numbered(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """rows with their place in the group by a column of numbers (from 0): ranges of the order are numbered apart, then
    moved by the rows that lie in the ranges before. Ties are numbered in any order, nulls of the order come first."""
    cuts = sorted(set(rows.where(F.col(order).isNotNull()).select(F.col(order).cast("double").alias("o")).approxQuantile("o", [i / RANGES for i in range(1, RANGES)], 0.001)))
    at = F.coalesce(F.size(F.filter(F.lit(cuts or [0.0]).cast("array<double>"), lambda c: c < F.col(order).cast("double"))), F.lit(-1))
    at = F.when(F.col(order).isNull(), -1).otherwise(at)
    ranged = rows.withColumn("tw_range", at)
    offsets = offset_by(ranged.select(group, "tw_range"), [group], "tw_range").select(F.col(group).alias("tw_group"), F.col("tw_range").alias("tw_at"), "before")
    joined = ranged.join(offsets, F.col(group).eqNullSafe(F.col("tw_group")) & (F.col("tw_range") == F.col("tw_at")))
    place = F.row_number().over(Window.partitionBy(group, "tw_range").orderBy(order)) - 1 + F.col("before")
    return joined.withColumn(name, place.cast("int")).drop("tw_range", "tw_group", "tw_at", "before")


def mark(key: Column, seed: int = 42) -> Column:
    """A hash by which rows are drawn: md5 of seed and key, in hex."""
    return F.md5(F.concat_ws("|", F.lit(seed), key.cast("string")).cast("binary"))


def first_by_mark(rows: DataFrame, group: list[str], key: str, quota: Column | DataFrame, seed: int = 42) -> DataFrame:
    """The first rows of each group in the order of their marks: as many as quota says (a number, or a DataFrame of
    group and quota). Marks fall into 4096 buckets: those before the last that is needed are whole, and only the rows
    of one are put in order."""
    marked = rows.withColumn("tw_mark", mark(F.col(key), seed)).withColumn("tw_bucket", F.substring("tw_mark", 1, 3))
    counts = offset_by(marked.select(*group, "tw_bucket"), group, "tw_bucket")
    counts = counts.withColumn("quota", quota) if isinstance(quota, Column) else counts.join(quota, group)
    limits = counts.where("before < quota").select(*group, "tw_bucket", (F.col("quota") - F.col("before")).alias("tw_rest"))
    held = marked.join(limits, [*group, "tw_bucket"])
    place = F.row_number().over(Window.partitionBy(*group, "tw_bucket").orderBy("tw_mark", key))
    return held.withColumn("tw_place", place).where("tw_place <= tw_rest").drop("tw_mark", "tw_bucket", "tw_rest", "tw_place")
