"""Slice features of an event stream: the batch slicing, then an aggregation that a watermark closes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.slicing import events_in_slices
from tidewheel.spec import RunSpec


def slice_stats(events: DataFrame, spec: RunSpec, late: str = "2 days") -> DataFrame:
    """client_id, slice_start, item, day, n, total, min, max, last_ts of a stream (or a table) of events.

    Steps of whole days deal events to slices without a join or state. A row is what one day of events adds to a slice:
    days are the windows in event time, so in append mode a day is sent once the watermark (late behind the newest
    event) has passed it; rows later than that are dropped. slices_of_days makes slices of the days in the sink: a slice
    is whole once all its days have been sent. Median, mode and std stay with the batch extractor, which sees all values.
    """
    if not spec.step.only_days:
        raise ValueError("a stream needs a step of whole days")
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    sliced = events_in_slices(timed.withColumn("at", F.col("ts").cast("timestamp_ntz")), spec, "at").where("value is not null")
    day = F.window("ts", "1 day")
    g = sliced.groupBy("client_id", "slice_start", "item", day).agg(F.count("value").alias("n"), F.sum("value").alias("total"), F.min("value").alias("min"), F.max("value").alias("max"), F.max("at").alias("last_ts"))
    return g.select("client_id", "slice_start", "item", F.col("window.start").cast("date").alias("day"), "n", "total", "min", "max", "last_ts")


def slices_of_days(parts: DataFrame) -> DataFrame:
    """The days of a slice as one row: what a stream's sink is read back with."""
    g = parts.groupBy("client_id", "slice_start", "item").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("min").alias("min"), F.max("max").alias("max"), F.max("last_ts").alias("last_ts"))
    return g.withColumn("mean", F.col("total") / F.col("n"))
