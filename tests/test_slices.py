"""Slices without a silent end: numbers of slices, months that stick, the lookback anchor, against stepping one by one."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewheel.operators.slicing import events_in_slices, individual_slices, slice_table
from tidewheel.spec import RunSpec, Span


def test_forty_years_of_days(spark):
    spec = RunSpec(start=date(1995, 1, 1), span=Span(years=40))
    assert spec.n == len(spec.starts()) == slice_table(spark, spec).count() == 14_611
    late = spark.createDataFrame([(datetime(2034, 12, 30, 12),)], "ts timestamp").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert [r["slice_start"] for r in events_in_slices(late, spec).orderBy("slice_start").collect()] == [date(2034, 12, 29), date(2034, 12, 30)]


def test_too_many_calendar_steps_are_an_error():
    spec = RunSpec(start=date(1, 1, 1), span=Span(years=3000), step=Span(months=1), global_start=date(1, 1, 1), global_end=date(3000, 1, 1))
    with pytest.raises(ValueError, match="more than 10000 slices"):
        spec.starts()
    assert RunSpec(start=date(1995, 1, 1), span=Span(), global_start=date(2000, 1, 1)).n == 0


def stepped(low, high, step):
    while low <= high:
        yield low
        low = step.after(low)


@pytest.mark.parametrize("step", [Span(days=1), Span(days=91), Span(months=1), Span(months=3), Span(years=1), Span(years=4), Span(months=1, days=3)])
@pytest.mark.parametrize("lookback", [False, True])
def test_individual_slices(spark, step, lookback):
    spec = RunSpec(start=date(1, 1, 1), span=Span(years=9, months=1, days=2), step=step, lookback=lookback, global_start=date(1996, 1, 30), global_end=date(2029, 3, 31))
    windows = [(str(i), datetime(1996, 1, 1) + timedelta(days=97 * i % 4000, hours=i), datetime(2001, 1, 31) + timedelta(days=311 * i % 9000)) for i in range(60)]
    windows += [("end of month", datetime(2023, 10, 31), datetime(2027, 12, 31)), ("leap day", datetime(2000, 2, 29), datetime(2024, 2, 29)), ("reversed", datetime(2020, 1, 1), datetime(2019, 1, 31)), ("outside", datetime(2040, 1, 1), datetime(2041, 1, 1))]
    df = spark.createDataFrame(windows, "client_id string, win_from timestamp, win_to timestamp").select("client_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("win_from", "win_to")))
    want = []
    for client, a, b in windows:
        a, b = min(a, b).date(), max(a, b).date()
        low = max(Span(years=9, months=1).before(b - timedelta(days=2)) if lookback else a, spec.global_start)
        want += [(client, d, step.after(d)) for d in stepped(low, min(b, spec.global_end), step)]
    assert sorted(map(tuple, individual_slices(df, spec).collect())) == sorted(want)


def test_long_windows_are_not_cut(spark):
    df = spark.createDataFrame([("a", datetime(1990, 1, 1), datetime(2030, 1, 1))], "client_id string, win_from timestamp, win_to timestamp").select("client_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("win_from", "win_to")))
    spec = RunSpec(start=date(1990, 1, 1), span=Span(years=40), global_start=date(1990, 1, 1))
    assert individual_slices(df, spec).count() == (date(2030, 1, 1) - date(1990, 1, 1)).days + 1
