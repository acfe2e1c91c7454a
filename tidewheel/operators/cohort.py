"""Cohorts: ids, controls, samples. Random choices follow hashes, so they can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.numbering import first_by_mark

#: Fixed value: a hospital id.
ID = r"^[a-zA-Z]\d{6}$"


def id_column(rows: DataFrame, pattern: str = ID) -> str:
    """The column whose values look like ids most often; ties go to the first."""
    sums = rows.agg(*(F.count_if(F.col(f"`{c}`").cast("string").rlike(pattern)).alias(c) for c in rows.columns)).first()
    return max(rows.columns, key=lambda c: sums[c])


def drawn(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of a hash of seed and key, over many tasks."""
    return first_by_mark(rows.withColumn("tw_all", F.lit(0)), ["tw_all"], key, F.lit(n), seed).drop("tw_all")


def cohort_ids(rows: DataFrame, column: str | None = None, sample: int | None = None, seed: int = 42) -> DataFrame:
    """client_id: distinct and not null; column None picks the one that looks most like ids."""
    ids = rows.select(F.col(column or id_column(rows)).cast("string").alias("client_id")).where("client_id is not null").distinct()
    return ids if sample is None else drawn(ids, "client_id", sample, seed)


def controls(everyone: DataFrame, treated: DataFrame, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """ratio controls for each treated client, drawn from everyone else."""
    rest = everyone.select("client_id").where("client_id is not null").distinct().join(treated.select("client_id").distinct(), "client_id", "left_anti")
    return drawn(rest, "client_id", int(ratio * treated.select("client_id").distinct().count()), seed)


def sanitised(ids: DataFrame, pattern: str = ID) -> DataFrame:
    """client_id in upper case if it is well-formed, and well_formed."""
    good = F.coalesce(F.col("client_id").rlike(pattern), F.lit(False))
    return ids.select(F.when(good, F.upper("client_id")).otherwise(F.col("client_id")).alias("client_id"), good.alias("well_formed"))


def existing(ids: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """The ids that some source has."""
    out = None
    for s in sources:
        own = s.select(F.col("client_id").cast("string").alias("client_id")).distinct()
        out = own if out is None else out.unionByName(own)
    return ids.select("client_id").distinct().join(out, "client_id", "left_semi")


def build(treated: DataFrame, everyone: DataFrame, sources: list[DataFrame], ratio: float = 1.0, sample: int | None = None, seed: int = 42, pattern: str = ID) -> DataFrame:
    """client_id, treated: the treated and their controls, in upper case, that exist in a source; a sample of them if
    asked for. Ids that are no well-formed ids go."""
    both = treated.select("client_id", F.lit(True).alias("treated")).unionByName(controls(everyone, treated, ratio, seed).select("client_id", F.lit(False).alias("treated")))
    clean = both.where(F.col("client_id").rlike(pattern)).select(F.upper("client_id").alias("client_id"), "treated").groupBy("client_id").agg(F.max("treated").alias("treated"))
    out = clean.join(existing(clean, sources), "client_id", "left_semi")
    return out if sample is None else drawn(out, "client_id", sample, seed)


def id_profile(ids: DataFrame, pattern: str = ID) -> DataFrame:
    """prefix, digit_sum, n for well-formed ids; prefix null counts the others."""
    good = F.coalesce(F.col("client_id").rlike(pattern), F.lit(False))
    digits = F.aggregate(F.filter(F.split("client_id", ""), lambda c: c.rlike(r"^\d$")), F.lit(0), lambda s, c: s + c.cast("int"))
    return ids.select(F.when(good, F.upper(F.substring("client_id", 1, 1))).alias("prefix"), F.when(good, digits).alias("digit_sum")).groupBy("prefix", "digit_sum").agg(F.count("*").alias("n"))


def id_clusters(ids: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """prefix, digit_sum, n, cluster: the profile of well-formed ids with its rows grouped by first letter and sum of
    digits (k-means, k at most; each letter a dimension of its own, as are the sums scaled to 0..1).

    The means are fitted on the profile, which has at most 26 x 55 rows however many ids there are."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    profile = id_profile(ids).where("prefix is not null")
    letters = F.transform(F.sequence(F.lit(65), F.lit(90)), lambda c: (F.ascii("prefix") == c).cast("double"))
    placed = profile.withColumn("features", array_to_vector(F.concat(letters, F.array(F.col("digit_sum") / F.lit(54.0)))))
    points = placed.count()
    if points < 2:
        return profile.withColumn("cluster", F.lit(0))
    model = KMeans(k=min(k, points), seed=seed, predictionCol="cluster", weightCol="n").fit(placed.withColumn("n", F.col("n").cast("double")))
    return model.transform(placed).select("prefix", "digit_sum", "n", "cluster")


def mapped_ids(numbers: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """key, client_id: distinct clients of external numbers; null where a number leads to none."""
    return numbers.select(key).distinct().join(mapping.select(key, "client_id").distinct(), key, "left")


def per_group(rows: DataFrame, group: list[str], n: int, order: list[Column]) -> DataFrame:
    """At most n rows of each group, first ones by an order."""
    from pyspark.sql import Window

    return rows.withColumn("tw_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("tw_n") <= n).drop("tw_n")


def latest(rows: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Each key's last row by time: one aggregation, no sort."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c != key)), F.struct(ts, tie)).alias("r")).select(key, "r.*")
