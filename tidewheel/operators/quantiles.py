"""Exact medians, quantiles and modes of groups of any size.

Groups are dealt to tasks and sorted there. A group of very many rows would be one task's: its equal values are counted first,
over all tasks; a group's distinct values are cut into ranges (operators/carry.py), the ranges' counts say
in which one a rank lies, and only the values of that range are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.carry import in_ranges

#: Rows of a group up to which it is put in order in one task.
LARGE = 5_000_000
#: Hashes by which groups are counted first.
BUCKETS = 65_536


def large_groups(rows: DataFrame, keys: list[str], large: int | None = None) -> DataFrame | None:
    """The keys of groups of more than large rows (fewer than all rows over large), or None if there are none. Tables of
    fewer bytes than eight a row for so many are not counted; of others, groups are counted only where a hash's are many."""
    large = LARGE if large is None else large
    known = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of its files; very much where unknown
    if known <= 8 * large:
        return None
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    many = [r["b"] for r in rows.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).where(F.col("n") > large).collect()]
    if not many:
        return None
    groups = rows.where(bucket.isin(many)).groupBy(*keys).agg(F.count("*").alias("tw_n")).where(F.col("tw_n") > large).select(*keys)
    return None if groups.isEmpty() else groups


def split_large(rows: DataFrame, keys: list[str], large: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of large rows or fewer, and all others, or None if there are none."""
    groups = large_groups(rows, keys, large)
    if groups is None:
        return rows, None
    named, same = groups.select(*(F.col(c).alias(f"tw_g{i}") for i, c in enumerate(keys))), F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"tw_g{i}"))
    return rows.join(F.broadcast(named), same, "left_anti"), rows.join(F.broadcast(named), same, "left_semi")


def with_middle(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """rows with a column that holds the values in the middle of their group, one or two, in their own rows: a group's median
    is half the sum of the column's least and greatest value. Groups are put in order where they lie; a sort may spill."""
    over = Window.partitionBy(*keys).orderBy(F.col(name).asc_nulls_last())
    n = F.count(name).over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = rows.withColumn(name, value).withColumns({"tw_place": F.row_number().over(over), "tw_n": n})
    at = (F.col("tw_place") * 2 >= F.col("tw_n")) & (F.col("tw_place") * 2 <= F.col("tw_n") + 2)
    return placed.withColumn(name, F.when(at, F.col(name))).drop("tw_place", "tw_n")


def with_medians(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """The same column for rows of large groups: their median, in every row."""
    valued = rows.withColumn(name, value)
    stats = order_statistics(valued, keys, name)
    named, same = stats.select(*(F.col(c).alias(f"tw_g{i}") for i, c in enumerate(keys)), F.col("quantile").alias("tw_median")), F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"tw_g{i}"))
    return valued.join(named, same, "left").withColumn(name, F.col("tw_median")).drop("tw_median", *(f"tw_g{i}" for i in range(len(keys))))


def order_statistics(rows: DataFrame, keys: list[str], value: str, share: float = 0.5, hot: int | None = None) -> DataFrame:
    """keys, quantile (interpolated between neighbours) and mode (the smallest of the commonest) of each group's values that
    are not null."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("tw_v")).agg(F.count("*").alias("tw_c"))
    ranged, _ = in_ranges(counts, keys, "tw_v", hot=hot)
    sums = ranged.groupBy(*keys, "tw_range").agg(F.sum("tw_c").alias("tw_in"))
    over = Window.partitionBy(*keys)  # ranges of a group, few
    before = F.coalesce(F.sum("tw_in").over(over.orderBy("tw_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = (F.sum("tw_in").over(over) - 1) * F.lit(share)
    spans = sums.select(*keys, "tw_range", "tw_in", before.alias("tw_before"), at.alias("tw_at"))
    low, high = F.floor("tw_at"), F.ceil("tw_at")
    held = lambda start, n: ((low >= start) & (low < start + n)) | ((high >= start) & (high < start + n))
    spans = spans.where(held(F.col("tw_before"), F.col("tw_in"))).drop("tw_in")
    same, named = F.lit(True), spans.select(*(F.col(c).alias(f"tw_k{i}") for i, c in enumerate((*keys, "tw_range"))), "tw_before", "tw_at")
    for i, c in enumerate((*keys, "tw_range")):
        same = same & ranged[c].eqNullSafe(named[f"tw_k{i}"])
    some = ranged.join(named, same)
    so_far = F.coalesce(F.sum("tw_c").over(Window.partitionBy(*keys, "tw_range").orderBy("tw_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("tw_before")
    placed = some.withColumn("tw_start", so_far)
    pick = lambda rank: F.max(F.when((rank >= F.col("tw_start")) & (rank < F.col("tw_start") + F.col("tw_c")), F.col("tw_v")))
    found = placed.groupBy(*keys).agg(pick(low).alias("tw_low"), pick(high).alias("tw_high"), F.first("tw_at").alias("tw_at"))
    between = F.when(low == high, F.col("tw_low").cast("double")).otherwise((high - F.col("tw_at")) * F.col("tw_low") + (F.col("tw_at") - low) * F.col("tw_high"))
    modes = counts.groupBy(*keys).agg(F.max_by("tw_v", F.struct("tw_c", -F.col("tw_v"))).alias("mode"))
    same, other = F.lit(True), modes.select(*(F.col(c).alias(f"tw_k{i}") for i, c in enumerate(keys)), "mode")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"tw_k{i}"))
    return found.select(*keys, between.alias("quantile")).join(other, same).select(*keys, "quantile", "mode")


def with_order_statistics(rows: DataFrame, keys: list[str], value: str, aggregates: list, large: int | None = None, unit: list[str] | None = None) -> DataFrame:
    """rows by keys: the aggregates, and median and mode of value. Rows are dealt by unit (some of the keys; all, if not
    given) once and put in order where they lie; those of units of more than large rows are aggregated over all tasks and
    get these two from order_statistics. The results are the same, and lie by unit in any case."""
    unit, v = unit or keys, F.col(value)
    small, others = split_large(rows, unit, large)
    over = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = small.repartition(*unit).withColumns({"tw_place": F.row_number().over(over), "tw_rank": F.rank().over(over), "tw_n": F.count(v).over(whole)})
    place, n = F.col("tw_place"), F.col("tw_n")
    middle = F.when((place * 2 >= n) & (place * 2 <= n + 2), v)
    alike = F.min(F.when(v.isNotNull(), F.struct((F.col("tw_rank") - place).alias("k"), v.alias("v"))))  # the last of equal values has them all before it
    out = placed.groupBy(*keys).agg(*aggregates, F.min(middle).alias("tw_low"), F.max(middle).alias("tw_high"), alike.alias("tw_alike"))
    out = out.withColumns({"median": (F.col("tw_low") + F.col("tw_high")) / 2, "mode": F.col("tw_alike.v")}).drop("tw_low", "tw_high", "tw_alike")
    if others is None:
        return out
    stats = order_statistics(others, keys, value)
    stats, same = stats.select(*(F.col(c).alias(f"tw_g{i}") for i, c in enumerate(keys)), F.col("quantile").alias("median"), "mode"), F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"tw_g{i}"))
    joined = others.groupBy(*keys).agg(*aggregates).join(stats, same, "left").drop(*(f"tw_g{i}" for i in range(len(keys))))
    return out.unionByName(joined.repartition(*unit))
