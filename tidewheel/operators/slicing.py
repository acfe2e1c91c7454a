"""Time slices, and which events lie in which."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, time, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions.times import ntz, plus
from tidewheel.operators.numbering import mark, offset_by
from tidewheel.spec import RunSpec, Span


def slice_table(spark: SparkSession, spec: RunSpec) -> DataFrame:
    """slice_start, slice_end (the last day, which belongs to the slice)."""
    if k := spec.step.only_days:
        starts = spark.range(spec.n).select(F.date_add(F.lit(spec.first), (F.col("id") * k).cast("int")).alias("slice_start"))
        return starts.withColumn("slice_end", F.date_add("slice_start", k))
    return spark.createDataFrame(spec.windows(), "slice_start date, slice_end date")


def in_window(ts: Column, first: date, last: date) -> Column:
    """A closed window of whole days; reversed bounds are swapped. Null times are never in one."""
    low, high = min(first, last), max(first, last)
    return (ts >= F.lit(datetime.combine(low, time())).cast("timestamp_ntz")) & (ts < F.lit(datetime.combine(high + timedelta(days=1), time())).cast("timestamp_ntz"))


def events_in_slices(events: DataFrame, spec: RunSpec, ts: str = "ts") -> DataFrame:
    """Each event once for each slice whose closed window holds it, with slice_start.

    Steps of whole days need no join: the slices of a day follow from its number, and an event goes to two at
    most (for a step of k days from start s, slices ceil((day - s) / k) - 1 to floor((day - s) / k)). Calendar
    steps join a broadcast table of days and slices. A plain range on the time reaches the scan either way.
    """
    spark, n, first_day = events.sparkSession, spec.n, spec.first
    if not n:
        return events.where(F.lit(False)).withColumn("slice_start", F.lit(None).cast("date"))
    k = spec.step.only_days
    if k:
        held = events.where(in_window(F.col(ts), first_day, first_day + timedelta(days=n * k)))
        day = F.datediff(F.col(ts).cast("date"), F.lit(first_day))
        first = F.greatest(F.ceil((day - k) / F.lit(k)), F.lit(0)).cast("int")
        last = F.least(F.floor(day / F.lit(k)), F.lit(n - 1)).cast("int")
        at = F.explode(F.when(first == last, F.array(first)).when(first < last, F.array(first, last)))
        return held.withColumn("slice_start", at).withColumn("slice_start", F.date_add(F.lit(first_day), F.col("slice_start") * k))
    windows = spec.windows()
    held = events.where(in_window(F.col(ts), windows[0][0], windows[-1][1]))
    days = slice_table(spark, spec).select("slice_start", F.explode(F.sequence("slice_start", "slice_end")).alias("slice_day"))
    return held.withColumn("slice_day", F.col(ts).cast("date")).join(F.broadcast(days), "slice_day").drop("slice_day")


def client_windows(rows: DataFrame, client: str, start: str, order: str, offset: Span | None = None) -> DataFrame:
    """client_id, win_from, win_to: one window a client; rows without id or time are skipped, the last row wins."""
    kept = rows.where(F.col(client).isNotNull() & F.col(start).isNotNull())
    last = kept.groupBy(F.col(client).cast("string").alias("client_id")).agg(F.max_by(F.col(start), F.struct(order, start)).alias("win_from"))
    o = offset or Span(years=1)
    return last.withColumn("win_to", ntz(plus(F.col("win_from"), o.years, o.months, o.days)))


def individual_slices(windows: DataFrame, spec: RunSpec, lookback: bool | None = None) -> DataFrame:
    """client_id, slice_start, slice_end inside each client's own window, clamped to the global bounds.

    Slices are stepped forward from the window's start; with lookback (that of spec unless given) from the day that lies
    spec.span before the window's end, up to that end. Each start follows from its number, as if starts were stepped one
    from the other: whole days are added; months are added with the day of the month held back to the shortest month met
    so far. Steps of both months and days are stepped.
    """
    back = spec.lookback if lookback is None else lookback
    s, o = spec.step, spec.span
    from_, to = F.least("win_from", "win_to").cast("date"), F.greatest("win_from", "win_to").cast("date")
    begin = F.add_months(F.date_sub(to, o.days), -(12 * o.years + o.months)) if back else from_
    low, high = F.greatest(begin, F.lit(spec.global_start)), F.least(to, F.lit(spec.global_end))
    months = 12 * s.years + s.months
    step = lambda d: F.date_add(F.add_months(d, months), s.days)
    held = windows.select("client_id", low.alias("low"), high.alias("high")).where("low <= high")
    if not months:
        numbers = F.sequence(F.lit(0), F.floor(F.datediff("high", "low") / s.days).cast("int"))
        starts = held.select("client_id", "low", F.explode(numbers).alias("i")).select("client_id", F.date_add("low", F.col("i") * s.days).alias("slice_start"))
    elif not s.days:
        n = F.greatest(F.floor(F.months_between(F.trunc("high", "month"), F.trunc("low", "month")) / months), F.lit(0)).cast("int")
        numbers = F.sequence(F.lit(0), n)
        length = lambda j: F.dayofmonth(F.last_day(F.add_months("low", j * months)))
        # from the first month of so few days on, starts lie no later than its last day
        first = lambda most: F.array_min(F.filter(numbers, lambda j: length(j) <= most))
        at = held.select("*", *(first(m).alias(f"to_{m}") for m in (28, 29, 30)), F.explode(numbers).alias("i"))
        day = F.least(F.dayofmonth("low"), *(F.when(F.col("i") >= F.col(f"to_{m}"), m).otherwise(31) for m in (28, 29, 30)))
        start = F.date_add(F.trunc(F.add_months("low", F.col("i") * months), "month"), day - 1)
        starts = at.select("client_id", "high", start.alias("slice_start")).where("slice_start <= high")
    else:
        starts = held.mapInArrow(_stepped(s), "client_id string, slice_start date")
    return starts.select("client_id", "slice_start", step(F.col("slice_start")).alias("slice_end"))


def _stepped(step: Span):
    """(client_id, low, high) -> a row for each start; for steps of months and days, which no expression has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clients, starts = [], []
            for client, low, high in zip(*(batch.column(k).to_pylist() for k in range(3))):
                while low <= high:
                    clients.append(client)
                    starts.append(low)
                    low = step.after(low)
                    if len(starts) == 65_536:
                        yield pa.RecordBatch.from_arrays([pa.array(clients, pa.string()), pa.array(starts, pa.date32())], ["client_id", "slice_start"])
                        clients, starts = [], []
            yield pa.RecordBatch.from_arrays([pa.array(clients, pa.string()), pa.array(starts, pa.date32())], ["client_id", "slice_start"])

    return run


def events_in_client_slices(events: DataFrame, slices: DataFrame, ts: str = "ts", band: int = 16) -> DataFrame:
    """Events in the slices of their own client: one equi-join on client and band of so many days, and then by day.

    A slice has a row for each band that it touches, not for each of its days. Both sides are always dealt: how many bands a
    slice has is not known when the plan is made, so that sizes guessed from the slices would broadcast too much.
    """
    number = lambda d: F.floor(F.unix_date(d) / F.lit(band)).cast("int")
    bands = slices.select("client_id", "slice_start", "slice_end", F.explode(F.sequence(number(F.col("slice_start")), number(F.col("slice_end")))).alias("slice_band"))
    day = F.col(ts).cast("date")
    met = events.withColumn("slice_band", number(day)).join(bands.hint("merge"), ["client_id", "slice_band"])
    return met.where((day >= F.col("slice_start")) & (day <= F.col("slice_end"))).drop("slice_band", "slice_end")


def control_windows(controls: DataFrame, windows: DataFrame, seed: int = 42) -> DataFrame:
    """client_id, win_from, win_to: gives each control a treated client's window. Windows are numbered by a hash of
    their client, from 0; a control takes the one whose number is its own hash modulo how many there are."""
    marked = windows.select("win_from", "win_to", mark(F.col("client_id"), seed).alias("m")).withColumn("bucket", F.substring("m", 1, 3))
    offsets = offset_by(marked.select(F.lit(0).alias("all"), "bucket"), ["all"], "bucket")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("m")) - 1 + F.col("before")
    known = marked.join(offsets, "bucket").select(place.cast("long").alias("number"), "win_from", "win_to")
    n = windows.agg(F.count("*").alias("windows"))  # a single row
    own = F.conv(F.substring(mark(F.col("client_id"), seed + 1), 1, 15), 16, 10).cast("long") % F.col("windows")
    return controls.select("client_id").join(F.broadcast(n)).where("windows > 0").withColumn("number", own).join(known, "number").select("client_id", "win_from", "win_to")


def one_hot(slices: DataFrame, spec: RunSpec, start: str = "slice_start") -> DataFrame:
    """A column d_yyyy_MM_dd for each slice, 1 in the row's own and 0 elsewhere."""
    marks = [F.when(F.col(start) == F.lit(d), 1).otherwise(0).alias(f"d_{d:%Y_%m_%d}") for d in spec.starts()]
    return slices.select("*", *marks)


def decode_one_hot(rows: DataFrame, keep: bool = False) -> DataFrame:
    """slice_start from the columns d_yyyy_MM_dd; null where none is 1. The columns go unless kept."""
    marks = [c for c in rows.columns if c.startswith("d_") and c.count("_") == 3]
    found = [F.when(F.col(c).cast("string").try_cast("double") == 1, F.lit(date(*map(int, c[2:].split("_"))))) for c in marks]
    out = rows.withColumn("slice_start", F.coalesce(*found) if found else F.lit(None).cast("date"))
    return out if keep else out.drop(*marks)
