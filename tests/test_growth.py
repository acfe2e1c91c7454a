"""Work and memory that grow no faster than the input: plans, and texts long enough to show it."""

import random
import time
from datetime import date, datetime, timedelta

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewheel.functions.text import near_phrase
from tidewheel.functions.times import FORMS, MORE_FORMS, NO_DATE, _in_form, parsed
from tidewheel.operators import annotations as A
from tidewheel.operators.slicing import events_in_client_slices

from tidewheel.sources import tables as T

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_client_slices_are_never_broadcast(spark):
    r, start = random.Random(3), date(1969, 11, 20)
    slices = [(f"c{r.randrange(5)}", d, d + timedelta(days=r.choice((0, 1, 15, 16, 40, 91)))) for d in (start + timedelta(days=r.randrange(120)) for _ in range(60))]
    events = [(i, f"c{r.randrange(6)}", datetime(1969, 11, 15) + timedelta(hours=r.randrange(24 * 230))) for i in range(400)]
    s = spark.createDataFrame(slices, "client_id string, slice_start date, slice_end date")
    e = spark.createDataFrame([*events, (-1, "c1", None)], "id long, client_id string, ts timestamp").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = events_in_client_slices(e, s)
    assert found.columns == ["client_id", "id", "ts", "slice_start"]
    want = sorted((i, a) for i, c, t in events for k, a, b in slices if c == k and a <= t.date() <= b)
    assert sorted((x["id"], x["slice_start"]) for x in found.collect()) == want
    assert "Broadcast" not in plan_of(found)


def test_ids_of_six_digits_match_sql(spark, tmp_path):
    spark.createDataFrame([(7,), (20,), (100_000,), (123_450,), (123_457,)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = sorted(tuple(r) for r in QUERIES["sanitize_ids"](spark, str(tmp_path)).select("client_id", "well_formed").collect())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got == sorted(duck.execute(ORACLES["sanitize_ids"]).fetchall())
    assert ("x100000", False) in got


def test_splitting_takes_linear_time(spark):
    """A note of very many entries, made in the plan: entries found again for each of them would take hours."""
    n = 40_000
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("entry "), i, F.lit(" Entered on - 05-Jan-2024 10:30 "))))
    made = spark.range(1).select("id", text.alias("t"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit("d").alias("d"))
    started = time.monotonic()
    r = A.split_notes(made, "id", "t", "ts", "d").agg(F.count("*"), F.count_distinct("t"), F.max("chunk"), F.max("ts")).first()
    assert tuple(r) == (n, n, n - 1, datetime(2024, 1, 5, 10, 30))
    assert time.monotonic() - started < 60


def test_near_phrase_takes_linear_time(spark):
    r, words = random.Random(5), ("of", "off", "that", "than", "license", "licence", "x")
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(12))) for _ in range(150)]
    near = lambda a, b: abs(len(a) - len(b)) <= 1 and (a == b or any(a[:i] + a[i + 1 :] in (b, b[:i] + b[i + 1 :]) for i in range(len(a))) or any(b[:i] + b[i + 1 :] == a for i in range(len(b))))

    def found(tokens, phrase, slop):
        ends = {i for i, t in enumerate(tokens) if near(t, phrase[0])}
        for w in phrase[1:]:
            ends = {i for i, t in enumerate(tokens) if near(t, w) and any(j < i <= j + 1 + slop for j in ends)}
        return bool(ends)

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for phrase, slop in (("license that", 2), ("off that", 0), ("off license than", 1), ("that", 1)):
        assert [x[0] for x in df.select(near_phrase(F.col("t"), phrase, slop, 1)).collect()] == [found(t.split(), phrase.split(), slop) for t in texts]
    started = time.monotonic()
    assert not spark.range(1).select(near_phrase(F.repeat(F.lit("license x x x that "), 30_000), "license that", 2, 1)).first()[0]
    assert time.monotonic() - started < 60


def test_dates_are_tried_in_fitting_forms_only(spark):
    r = random.Random(7)
    part = lambda: r.choice(("1", "05", "12", "24", "2024") if r.random() < 0.8 else ("1", "05", "13", "31", "005", "24", "68", "69", "2024", "12024", "+12024", "-5", "Jan", "", "100"))
    texts = []
    for _ in range(6000):
        a, b = r.choice("/-. "), r.choice(":.")
        time_ = r.choice(((), (" ", part(), b, part()), (" ", part(), b, part(), b, part())))
        texts.append("".join((part(), a, part(), r.choice((a, "/")), part(), *time_)))
    df = spark.createDataFrame([(t,) for t in [*texts, None, " nan ", "2024-01-05T10:00:00+01:00", " 5/1/24 "]], "t string")
    forms = FORMS + MORE_FORMS
    said = F.when(~F.lower(F.trim("t")).isin(*NO_DATE), F.trim("t"))
    iso = F.convert_timezone(F.current_timezone(), F.lit("UTC"), said.try_cast("timestamp").cast("timestamp_ntz"))
    out = df.select("t", parsed(F.col("t")).cast("string").alias("got"), F.coalesce(iso, *(_in_form(said, f) for f in forms)).cast("string").alias("want"))
    rows = out.collect()
    assert [x for x in rows if x["got"] != x["want"]] == [] and sum(x["got"] is not None for x in rows) > 300
    assert df.select(parsed(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().count("trim(") < 5


def test_rows_of_a_keyed_table_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(n):
        made.add(1)
        return f"k{n % 10}"

    rows = spark.range(500).select(key("id").alias("k"), "id")
    T.write_keyed(rows, f"{tmp_path}/t", "k", 4)
    assert made.value == 500
    T.replace_keys(rows.where("id < 100"), f"{tmp_path}/t", "k", 4)
    assert made.value <= 1000 and T.read_keyed(spark, f"{tmp_path}/t", "k").count() == 100
    assert not rows.is_cached
