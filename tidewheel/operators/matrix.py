"""Feature matrices: imputation, profiles, means, shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.carry import filled


def impute(rows: DataFrame, key: str, ts: str, columns: list[str], forward: bool = True, backward: bool = True, mean: bool = True, tie: str | None = None) -> DataFrame:
    """Fills each client's nulls forward, then backward in time, then by the mean of the column so filled.

    Forward then backward over a client is: the last value so far, else the first there is. tie: what orders rows of
    equal time; without it the columns' own values do, so that a rerun fills alike. Clients of very many rows go over
    many tasks (operators/carry.py).
    """
    out = filled(rows, key, [ts, tie] if tie else [ts, *(c for c in columns if c != ts)], columns, forward, backward)
    if not mean:
        return out
    means = out.agg(*(F.avg(c).alias(f"tw_{c}") for c in columns))  # a single row
    return out.join(F.broadcast(means)).withColumns({c: F.coalesce(F.col(c), F.col(f"tw_{c}")) for c in columns}).drop(*(f"tw_{c}" for c in columns))


def split_of(key: str, test: float = 0.2, val: float = 0.2, seed: int = 42):
    """train, val or test by a hash of the key."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return F.when(u < test, "test").when(u < test + val, "val").otherwise("train")


def impute_train_mean(rows: DataFrame, columns: list[str], split: str = "split") -> DataFrame:
    """Null columns go; the others are filled with the mean over train rows, or 0 if these have none."""
    counts = rows.agg(*(F.count(c).alias(c) for c in columns)).first()
    kept = [c for c in columns if counts[c]]
    means = rows.agg(*(F.coalesce(F.avg(F.when(F.col(split) == "train", F.col(c))), F.lit(0.0)).alias(f"tw_{c}") for c in kept)) if kept else None
    out = rows.drop(*(c for c in columns if c not in kept))
    if not kept:
        return out
    return out.join(F.broadcast(means)).withColumns({c: F.coalesce(F.col(c), F.col(f"tw_{c}")) for c in kept}).drop(*(f"tw_{c}" for c in kept))


def missing_percentage(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, missing: percent of null values, in one pass."""
    columns = columns or rows.columns
    one = rows.agg(*(F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), (F.coalesce(F.col(c), F.lit(0.0)) * 100).alias("missing")) for c in columns))).alias("r")).select("r.*")


def drop_all_null(rows: DataFrame) -> DataFrame:
    counts = rows.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns)).first()
    return rows.drop(*(c for c in rows.columns if not counts[c]))


def true_to_number(rows: DataFrame, columns: list[str]) -> DataFrame:
    """"True" is 1, "False" 0, other text its number, else null."""
    of = lambda c: F.when(F.lower(F.col(c).cast("string")) == "true", 1.0).when(F.lower(F.col(c).cast("string")) == "false", 0.0).otherwise(F.col(c).cast("string").try_cast("double"))
    return rows.withColumns({c: of(c) for c in columns})


def mean_per_client(rows: DataFrame, key: str, numeric: list[str], others: list[str], order: str) -> DataFrame:
    """Means of numbers, first values (by order) of the rest."""
    return rows.groupBy(key).agg(*(F.avg(c).alias(c) for c in numeric), *(F.min_by(c, order).alias(c) for c in others))


def merge_means(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """The earlier output, and what is new of clients not in it."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def item_coverage(rows: DataFrame, item: str, key: str, top: int = 50) -> DataFrame:
    """item, rows, lacking: the items of most rows, and how many clients lack each."""
    everyone = rows.agg(F.count_distinct(key).alias("everyone"))  # a single row
    g = rows.groupBy(item).agg(F.count("*").alias("rows"), F.count_distinct(key).alias("have")).orderBy(F.desc("rows"), item).limit(top)
    return g.join(F.broadcast(everyone)).select(F.col(item).alias("item"), "rows", (F.col("everyone") - F.col("have")).alias("lacking"))


#: Items that a sketch of common values tracks, candidates taken from it, and its error as a share of rows times tracked items.
TRACKED, CANDIDATES, SKETCH_ERROR = 10_000, 1000, 3.5


def top_values(rows: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """column, value (as text), n, place: each column's k most common values with exact counts, ties by the smaller value.

    One pass sketches all columns (heavy hitters, mergeable), a second counts the candidates exactly. Where the sketch
    can't vouch for the k-th one (a column of mostly different values), the column is counted whole.
    """
    text = {c: F.col(f"`{c}`").cast("string") for c in columns}
    found = rows.agg(F.count("*").alias("rows"), *(F.expr(f"approx_top_k(cast(`{c}` as string), {CANDIDATES}, {TRACKED})").alias(f"top_{i}") for i, c in enumerate(columns))).first()
    error = SKETCH_ERROR * found["rows"] / TRACKED
    tops = {c: [(x["item"], x["count"]) for x in found[f"top_{i}"] or [] if x["item"] is not None] for i, c in enumerate(columns)}
    tracked_all = found["rows"] <= TRACKED // 2
    missing = {c: error + min(n for _, n in own) if len(own) >= CANDIDATES - 1 else 0 if tracked_all else error for c, own in tops.items()}  # what a value that is no candidate may reach
    spark = rows.sparkSession
    candidates = spark.createDataFrame([(c, v) for c, own in tops.items() for v, _ in own], "column string, value string")  # CANDIDATES a column
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), text[c].alias("value")) for c in columns))).alias("e")
    counted = rows.select(each).select("e.*").join(F.broadcast(candidates), ["column", "value"]).groupBy("column", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    best = spark.createDataFrame(counted.withColumn("place", place).where(F.col("place") <= k).collect(), "column string, value string, n long, place int")  # k a column
    kth = {r["column"]: r["n"] for r in best.groupBy("column").agg(F.min("n").alias("n")).collect()}
    unsure = [c for c in missing if kth.get(c, 0) <= missing[c] and missing[c] > 0]
    out = best.where(~F.col("column").isin(unsure)) if unsure else best
    for c in unsure:
        whole = rows.where(text[c].isNotNull()).groupBy(text[c].alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)
        whole = whole.select(F.lit(c).alias("column"), "value", "n").withColumn("place", place)
        out = out.unionByName(whole)
    return out


def profile(rows: DataFrame, columns: list[str], exact: bool = False, top: int = 0) -> DataFrame:
    """column, rows, nulls, distinct (approximate unless exact), low and high as text: one pass. With top, also the most
    common values, as text (value:count, ...), which takes another pass or two."""
    of = lambda c: F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), (F.count_distinct(c) if exact else F.approx_count_distinct(c)).alias("distinct"), F.min(F.col(c).cast("string")).alias("low"), F.max(F.col(c).cast("string")).alias("high"))
    out = rows.agg(F.array(*map(of, columns)).alias("all")).select(F.explode("all").alias("r")).select("r.*")
    if not top:
        return out
    said = F.transform(F.sort_array(F.collect_list(F.struct("place", "value", "n"))), lambda t: F.concat(t["value"], F.lit(":"), t["n"]))
    tops = top_values(rows, columns, top).groupBy("column").agg(F.array_join(said, ", ").alias("top"))  # a row a column
    return out.join(F.broadcast(tops), "column", "left")


def shares(rows: DataFrame, key: str | list[str], name: str, rare: float = 0.25) -> DataFrame:
    """key, name, share: each concept's share of a client's mentions (or those of a client and semantic type); those with
    a count up to the quantile are pooled as `other`."""
    keys = [key] if isinstance(key, str) else key
    counts = rows.groupBy(*keys, name).agg(F.count("*").alias("n"))
    bars = counts.groupBy(*keys).agg(F.percentile("n", rare).alias("bar"), F.sum("n").alias("all"))
    pooled = counts.join(bars, keys).select(*keys, F.when(F.col("n") <= F.col("bar"), "other").otherwise(F.col(name)).alias(name), "n", "all")
    return pooled.groupBy(*keys, name).agg((F.sum("n") / F.first("all")).alias("share"))


def shares_by_type(rows: DataFrame, key: str, name: str, types: str, rare: float = 0.25) -> DataFrame:
    """key, type, name, share: over all of a client's mentions (type `all`), and over those of each semantic type."""
    kinds = F.array_union(F.array(F.lit("all")), F.coalesce(F.col(types), F.array().cast("array<string>")))
    return shares(rows.select(key, name, F.explode(kinds).alias("type")), [key, "type"], name, rare)


def infer_types(rows: DataFrame, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """column, kind, number_share, date_share: what most of a text column's non-null values parse as, in one pass."""
    share = lambda c, kind: F.coalesce(F.avg(F.when(F.col(c).isNotNull(), F.col(c).cast("string").try_cast(kind).isNotNull().cast("int"))), F.lit(0.0))
    of = lambda c: F.struct(F.lit(c).alias("column"), share(c, "double").alias("number_share"), share(c, "timestamp").alias("date_share"))
    out = rows.agg(F.array(*map(of, columns)).alias("all")).select(F.explode("all").alias("r")).select("r.*")
    kind = F.when((F.col("number_share") >= F.col("date_share")) & (F.col("number_share") >= threshold), "number").when(F.col("date_share") >= threshold, "date").otherwise("text")
    return out.select("column", kind.alias("kind"), "number_share", "date_share")


def best_date_column(rows: DataFrame, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """What infer_types says of the columns, and best: true for the one of the largest share of dates (the first of
    equals), if that is threshold or more."""
    order = F.array_position(F.lit(columns), F.col("column"))
    first = Window.orderBy(F.desc("date_share"), order)  # as many rows as columns
    kinds = infer_types(rows, columns, threshold)
    return kinds.withColumn("best", (F.row_number().over(first) == 1) & (F.col("date_share") >= threshold))
