"""Values carried along time within clients, over many tasks however many rows a client has.

A client of more than HOT rows is cut into ranges of time. Each range's last and first values make a small table; they
are carried over its ranges, and come back as one more row at the start of each range, so that filling stays inside
ranges. No row is joined, and every client else is one range. Frames grow from the start only, so time is linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a client up to which it is one range; ranges at most.
HOT, RANGES = 1_000_000, 512


def as_number(rows: DataFrame, column: str) -> Column:
    """A column of numbers, dates or times as a double in the same order."""
    kind = rows.schema[column].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def in_ranges(rows: DataFrame, keys: list[str], order: str, name: str = "tw_range", hot: int | None = None) -> tuple[DataFrame, bool]:
    """(rows with the number of their range, whether there is more than one). Only keys of more than hot rows have several,
    cut at quantiles of all such keys' rows, so that no range has much more than hot rows, or all of them over RANGES."""
    hot = HOT if hot is None else hot
    counts = rows.groupBy(*keys).agg(F.count("*").alias("tw_n")).where(F.col("tw_n") > hot)
    total, many = counts.agg(F.coalesce(F.sum("tw_n"), F.lit(0)), F.count("*")).first()
    if not many:
        return rows.withColumn(name, F.lit(0)), False
    known = counts.select(*(F.col(k).alias(f"tw_hot_{i}") for i, k in enumerate(keys)))  # fewer than all rows over hot
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"tw_hot_{i}"))
    large = rows.join(F.broadcast(known), same, "left_semi").select(as_number(rows, order).alias("o"))
    n = min(RANGES, -(-2 * total // max(1, hot)))
    cuts = sorted(set(large.where("o is not null").approxQuantile("o", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    at = F.coalesce(F.size(F.filter(F.lit(cuts or [0.0]).cast("array<double>"), lambda c: c < as_number(rows, order))), F.lit(-1))
    at = F.when(F.col(order).isNull(), -1).otherwise(at)
    marked = rows.join(F.broadcast(known.withColumn("tw_is_hot", F.lit(True))), same, "left")
    return marked.withColumn(name, F.when(F.col("tw_is_hot"), at).otherwise(0)).drop("tw_is_hot", *(f"tw_hot_{i}" for i in range(len(keys)))), True


def filled(rows: DataFrame, key: str, order: list[str], columns: list[str], forward: bool = True, backward: bool = True, hot: int | None = None) -> DataFrame:
    """rows with each column's nulls filled: forward by the last value before, then backward by the next one.

    Both together are the last value so far, else the client's first. order: time, then what tells rows of one time apart.
    """
    if not columns or not (forward or backward):
        return rows
    ranged, several = in_ranges(rows, [key], order[0], hot=hot)
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    if several:
        own = lambda c: F.when(F.col(c).isNotNull(), place)
        edges = ranged.groupBy(key, "tw_range").agg(*(F.max_by(c, own(c)).alias(f"tw_last_{c}") for c in columns), *(F.min_by(c, own(c)).alias(f"tw_first_{c}") for c in columns))
        over = Window.partitionBy(key).orderBy("tw_range")  # ranges of one client, RANGES at most
        before, after, whole = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(1, Window.unboundedFollowing), over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carried = {f"tw_past_{c}": F.last(f"tw_last_{c}", ignorenulls=True).over(before) for c in columns} if forward else {}
        carried |= {f"tw_next_{c}": F.first(f"tw_first_{c}", ignorenulls=True).over(whole if forward else after) for c in columns} if backward else {}
        marks = edges.select(key, "tw_range", *(c.alias(n) for n, c in carried.items())).withColumn("tw_row", F.lit(0))
        both = ranged.withColumn("tw_row", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    else:
        both = ranged.withColumn("tw_row", F.lit(1)).withColumns({f"{n}{c}": F.lit(None).cast(rows.schema[c].dataType) for c in columns for n in ("tw_past_", "tw_next_")})
    group = Window.partitionBy(key, "tw_range")
    past = group.orderBy("tw_row", *order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = group.orderBy("tw_row", *(F.col(c).desc() for c in order)).rowsBetween(Window.unboundedPreceding, 0)
    whole_range = group.orderBy("tw_row", *order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = {}
    for c in columns:
        steps = [F.col(c)]
        if forward:
            steps += [F.last(c, ignorenulls=True).over(past)] + [F.first(f"tw_past_{c}", ignorenulls=True).over(past)] * several
        if backward and forward:
            steps.append((F.first(f"tw_next_{c}", ignorenulls=True) if several else F.first(c, ignorenulls=True)).over(past if several else whole_range))
        elif backward:
            steps += [F.last(c, ignorenulls=True).over(ahead)] + [F.first(f"tw_next_{c}", ignorenulls=True).over(ahead)] * several
        out[c] = F.coalesce(*steps)
    return both.withColumns(out).where("tw_row = 1").select(*rows.columns)


def nearest(template: DataFrame, results: DataFrame, keys: list[str], low: int, high: int, hot: int | None = None) -> DataFrame:
    """row, keys, value: to each template row (row, keys, t) of the results (keys, t, value) of equal keys the one nearest
    to t inside the open interval (t - low, t + high); t in microseconds. Of equally near ones the earlier counts, then
    the smaller value.

    Both tables make one in order of time; a row looks at the last result before it and the first after it, nothing else.
    """
    value = results.schema["value"].dataType
    rows = template.select(*keys, "t", "row", F.lit(None).cast(value).alias("value"), F.lit(1).alias("kind"))
    both = rows.unionByName(results.select(*keys, "t", F.lit(None).cast(template.schema["row"].dataType).alias("row"), "value", F.lit(0).alias("kind")))
    ranged, several = in_ranges(both, keys, "t", hot=hot)
    hit = F.when(F.col("kind") == 0, F.struct("t", "value"))
    none = F.lit(None).cast(T.StructType([T.StructField("t", T.LongType()), T.StructField("value", value)]))
    if several:
        found = ranged.where("kind = 0").groupBy(*keys, "tw_range").agg(F.max("t").alias("last"), F.min_by("value", F.struct(-F.col("t"), "value")).alias("last_value"), F.min(F.struct("t", "value")).alias("first"))
        spans = ranged.select(*keys, "tw_range").distinct()
        same = F.lit(True)
        for k in (*keys, "tw_range"):
            same = same & spans[k].eqNullSafe(found[k])
        edges = spans.join(found, same, "left").select(*(spans[k] for k in (*keys, "tw_range")), F.when(F.col("last").isNotNull(), F.struct(F.col("last").alias("t"), F.col("last_value").alias("value"))).alias("last"), "first")
        over = Window.partitionBy(*keys).orderBy("tw_range")
        marks = edges.select(
            *keys, "tw_range", F.last("last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("tw_past"),
            F.first("first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("tw_next"), F.lit(-1).alias("kind"),
        )
        ranged = ranged.unionByName(marks, allowMissingColumns=True)
    else:
        ranged = ranged.withColumns({"tw_past": none, "tw_next": none})
    group, so_far = Window.partitionBy(*keys, "tw_range"), (Window.unboundedPreceding, 0)
    first = (F.col("kind") >= 0).cast("int")  # a carried row comes before all others in either direction
    back = group.orderBy(first, "t", "kind", F.desc("value")).rowsBetween(*so_far)
    ahead = group.orderBy(first, F.desc("t"), F.desc("kind"), F.desc("value")).rowsBetween(*so_far)
    own = lambda name, over: F.coalesce(F.last(hit, ignorenulls=True).over(over), *([F.first(name, ignorenulls=True).over(over)] * several))
    seen = ranged.withColumns({"before": own("tw_past", back), "after": own("tw_next", ahead)}).where("kind = 1")
    t, b, a = F.col("t"), F.col("before"), F.col("after")
    b = F.when(b["t"] > t - low, b)
    a = F.when(a["t"] < t + high, a)
    best = F.when(a.isNull() | (t - b["t"] <= a["t"] - t), b).otherwise(a)
    return seen.select("row", *keys, best.alias("best")).where("best is not null").select("row", *keys, F.col("best.value").alias("value"))
