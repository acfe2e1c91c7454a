"""A stream's slices, read back, are the batch's."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewheel.sources.stand_ins import DAILY, Tables
from tidewheel.spec import RunSpec, Span
from tidewheel.streaming.daily import slice_stats, slices_of_days

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    events = Tables(spark, SF).obs().drop("obs_id")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    q = slice_stats(stream, DAILY).writeStream.outputMode("complete").format("memory").queryName("slices").start()
    q.processAllAvailable()
    q.stop()
    columns = ["client_id", "slice_start", "item", "n", "min", "max", "last_ts", F.round("mean", 6)]
    got, want = slices_of_days(spark.table("slices")), slices_of_days(slice_stats(events, DAILY))
    assert got.select(*columns).exceptAll(want.select(*columns)).count() == 0 and got.count() == want.count() > 0


def test_months_are_refused(spark):
    with pytest.raises(ValueError):
        slice_stats(Tables(spark, SF).obs(), RunSpec(start=date(2024, 1, 1), span=Span(years=1), step=Span(months=1)))
