"""The literal fixtures of FIXTURES.md, and edge cases of the operators."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.functions.text import near_phrase, near_token, partial_similarity
from tidewheel.functions.times import age_at, days_floor, parsed
from tidewheel.operators import annotations as A
from tidewheel.operators import anonymise as N
from tidewheel.operators import cohort as C
from tidewheel.operators import features as X
from tidewheel.operators import joins as J
from tidewheel.operators import matrix as M
from tidewheel.operators import search as S
from tidewheel.operators.slicing import client_windows, decode_one_hot, events_in_client_slices, events_in_slices, in_window, individual_slices, one_hot, slice_table
from tidewheel.sources import tables as T
from tidewheel.spec import RunSpec, Span, real_date, whole_steps


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_time_window_b1(spark):
    said = ["2023-01-15 10:00:00", "2023-02-01 00:00:00", "2023-02-20 12:30:00", "2023-03-31 23:59:59", "2023-04-05 08:00:00", "not a date", None, "2023-02-15 05:00:00+01:00"]
    df = spark.createDataFrame([(s, i + 1) for i, s in enumerate(said)], "said string, value int").withColumn("ts", parsed(F.col("said")))
    for a, b in ((date(2023, 2, 1), date(2023, 3, 31)), (date(2023, 3, 31), date(2023, 2, 1))):
        assert rows(df.where(in_window(F.col("ts"), a, b)), "value") == [(2,), (3,), (4,), (8,)]
    assert df.where("value = 8").select(F.date_format("ts", "HH:mm")).first()[0] == "04:00"


@pytest.mark.parametrize(
    ("start", "span", "step", "starts"),
    [
        (date(2021, 1, 1), Span(days=4), Span(days=1), [date(2021, 1, d) for d in range(1, 6)]),
        (date(2021, 1, 15), Span(months=2), Span(months=1), [date(2021, 1, 15), date(2021, 2, 15), date(2021, 3, 15)]),
        (date(2021, 1, 30), Span(days=3), Span(days=1), [date(2021, 1, 30), date(2021, 1, 31), date(2021, 2, 1), date(2021, 2, 2)]),
        (date(2021, 5, 5), Span(), Span(days=1), [date(2021, 5, 5)]),
        (date(2024, 1, 31), Span(months=3), Span(months=1), [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 29), date(2024, 4, 29)]),
    ],
)
def test_slice_starts_b2(start, span, step, starts):
    assert RunSpec(start=start, span=span, step=step).starts() == starts


def test_spec_bounds():
    back = RunSpec(start=date(2021, 1, 10), span=Span(days=3), lookback=True)
    assert back.starts() == [date(2021, 1, d) for d in (7, 8, 9, 10)]
    clamped = RunSpec(start=date(2021, 1, 1), span=Span(days=10), global_start=date(2021, 1, 9), global_end=date(2021, 1, 5))
    assert (clamped.global_start, clamped.global_end) == (date(2021, 1, 5), date(2021, 1, 9)) and clamped.starts()[0] == date(2021, 1, 5)
    assert RunSpec(start=date(2021, 1, 1), span=Span(days=1), global_start=date(2022, 1, 1)).starts() == []
    assert len(RunSpec(start=date(1995, 1, 1), span=Span(years=100)).starts()) == 36_526  # no day is left out
    with pytest.raises(ValueError):
        RunSpec(start=date(2021, 1, 1), span=Span(days=1), step=Span())
    with pytest.raises(ValueError):
        Span(days=-1)
    with pytest.raises(ValueError):
        real_date(2023, 2, 29)
    assert real_date("2024", "2", "29") == date(2024, 2, 29)
    assert whole_steps(date(2021, 1, 1), Span(years=1), Span(months=1)) == 12


def test_events_lie_in_two_daily_slices(spark):
    spec = RunSpec(start=date(2024, 1, 1), span=Span(days=2))
    at = ["2024-01-01 00:00:00", "2024-01-02 23:59:59", "2024-01-04 23:59:59", "2024-01-05 00:00:00", "2023-12-31 23:59:59"]
    df = spark.createDataFrame([(i, datetime.fromisoformat(s)) for i, s in enumerate(at)], "i int, t timestamp").select("i", F.col("t").cast("timestamp_ntz").alias("ts"))
    own = rows(events_in_slices(df, spec), "i", "slice_start")
    assert own == [(0, date(2024, 1, 1)), (1, date(2024, 1, 1)), (1, date(2024, 1, 2)), (2, date(2024, 1, 3))]
    # a calendar step takes the other way and means the same
    monthly = RunSpec(start=date(2024, 1, 1), span=Span(months=1), step=Span(months=1))
    assert rows(events_in_slices(df, monthly), "i", "slice_start") == [(i, date(2024, 1, 1)) for i in range(4)]
    assert events_in_slices(df, RunSpec(start=date(2024, 1, 1), span=Span(), global_start=date(2030, 1, 1))).count() == 0
    assert slice_table(spark, spec).count() == 3


def test_multi_day_steps_match_a_range_join(spark):
    spec = RunSpec(start=date(2024, 1, 3), span=Span(days=20), step=Span(days=3))
    df = spark.range(0, 900).select("id", (F.lit("2023-12-30 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"))
    s = slice_table(spark, spec)
    want = df.join(s, (F.col("ts") >= F.col("slice_start").cast("timestamp_ntz")) & (F.col("ts") < F.date_add("slice_end", 1).cast("timestamp_ntz")))
    assert rows(events_in_slices(df, spec), "id", "slice_start") == rows(want, "id", "slice_start")


def test_individual_windows_b10(spark):
    df = spark.createDataFrame([("P001", datetime(2019, 5, 5), 1), ("P001", datetime(2020, 1, 1), 2), (None, datetime(2020, 1, 1), 3), ("P2", None, 4)], "c string, t timestamp, n int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    w = client_windows(df, "c", "t", "n")
    assert rows(w, "client_id", "win_from", "win_to") == [("P001", datetime(2020, 1, 1), datetime(2021, 1, 1))]
    monthly = RunSpec(start=date(2020, 1, 1), span=Span(years=1), step=Span(months=1))
    end = spark.createDataFrame([("P1", datetime(2024, 1, 31), datetime(2024, 5, 1))], "client_id string, a timestamp, b timestamp").select("client_id", F.col("a").cast("timestamp_ntz").alias("win_from"), F.col("b").cast("timestamp_ntz").alias("win_to"))
    s = individual_slices(end, monthly)
    assert [r[0] for r in rows(s, "slice_start")] == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 29), date(2024, 4, 29)]
    ev = end.select("client_id", F.lit("2024-02-29 12:00:00").cast("timestamp_ntz").alias("ts"))
    assert events_in_client_slices(ev, s).count() == 2


def test_one_hot_round_trip(spark):
    spec = RunSpec(start=date(2024, 1, 1), span=Span(days=2))
    df = spark.createDataFrame([("a", date(2024, 1, 2)), ("b", date(2025, 1, 1))], "client_id string, slice_start date")
    hot = one_hot(df, spec).drop("slice_start")
    assert rows(decode_one_hot(hot), "client_id", "slice_start")[0] == ("a", date(2024, 1, 2))
    assert decode_one_hot(hot).where("client_id = 'b'").first()["slice_start"] is None


def test_bloods_gates_b11(spark):
    t = lambda d, h=0: datetime(2024, 1, d, h)
    data = [("one", 5.0, t(1)), ("two", 1.0, t(1)), ("two", 3.0, t(2, 12)), ("tie", 1.0, t(1)), ("tie", 2.0, t(2)), ("tie", 2.0, t(3)), ("tie", 1.0, t(4)), ("none", None, t(1))]
    data += [("far", 0.0, t(1, h)) for h in range(11)] + [("far", 1000.0, t(2))]
    df = spark.createDataFrame([("c", date(2024, 1, 1), i, v, s) for i, v, s in data], "client_id string, slice_start date, item string, value double, t timestamp").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = {(r["feature"]): r["value"] for r in X.bloods(df, datetime(2024, 1, 4)).collect()}
    assert {k for k in got if k.startswith("one_")} == {"one_mean"} and got["one_mean"] == 5
    assert {k for k in got if k.startswith("two_")} == {"two_mean", "two_most-recent", "two_earliest-test", "two_days-since-last-test", "two_num-tests"}
    assert (got["two_most-recent"], got["two_earliest-test"], got["two_days-since-last-test"], got["two_num-tests"]) == (3, 1, 1, 2)
    assert (got["tie_mode"], got["tie_median"], got["tie_days-between-first-last"]) == (1, 1.5, 3)
    assert (got["far_contains-extreme-high"], got["far_contains-extreme-low"]) == (1, 0)
    assert not any(k.startswith("none") for k in got)


def test_days_floor_and_age(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-02 12:00:00' b, date'2000-03-01' born, timestamp_ntz'2024-02-29 10:00:00' t")
    assert df.select(days_floor(F.col("a"), F.col("b")), days_floor(F.col("b"), F.col("a"))).first()[:] == (-2, 1)
    assert df.select(age_at(F.col("born"), F.col("t"))).first()[0] == 23


def frame(spark, items):
    return spark.createDataFrame([("c", date(2024, 1, 1), *i) for i in items], "client_id string, slice_start date, item string, value double, text string")


def test_body_and_scores(spark):
    names = {"bmi": "b", "height": "h", "weight": "w"}
    got = dict(rows(X.body(frame(spark, [("b", 31.0, None), ("b", 250.0, None), ("h", 180.0, None), ("w", 900.0, None)]), names), "feature", "value"))
    assert got["bmi_mean"] == 31 and got["bmi_extreme"] == 1 and got["height_mean"] == 180 and "weight_mean" not in got
    assert rows(X.body(frame(spark, [("h", 180.0, None)]), names), "feature") == []
    assert dict(rows(X.body(frame(spark, [("h", 180.0, None)]), names, require_bmi=False), "feature", "value"))["height_mean"] == 180
    got = dict(rows(X.scores(frame(spark, [("n", 20.0, None), ("n", 3.0, None), ("x", 1.0, None)]), {"n": "news_score"}, {"news_score": (-20, 20)}), "feature", "value"))
    assert got["news_score_mean"] == 3 and got["news_score_n"] == 1 and "news_score_std" not in got


def test_categorical_extractors(spark):
    df = frame(spark, [("t", None, "Current smoker"), ("t", None, None), ("t", None, "90-95%")])
    assert dict(rows(X.flags(df, {"cur": "current", "non": "non-smoker"}), "feature", "value")) == {"cur": 1, "non": 0}
    assert ("sat_90_95pct", 1.0) in rows(X.presence(df, "sat_", clean=True), "feature", "value")
    for texts, want in ((["SARS Positive", "negative"], [("covid", 1.0)]), (["negative"], [("covid", 0.0)]), (["pending"], [])):
        assert rows(X.positive(frame(spark, [("t", None, x) for x in texts]), "covid"), "feature", "value") == want
    assert rows(X.positive(frame(spark, [("t", None, "pending")]), "covid", negate=True), "feature", "value") == [("covid", 0.0)]


@pytest.mark.parametrize(
    ("text", "group"),
    [("Welsh", "white"), ("White and Asian", "mixed_or_multiple_ethnic_groups"), ("Black African", "black_african_caribbean_or_black_british"), ("Indian", "asian_or_asian_british"), ("Arab", "other_ethnic_group"), (None, "other_ethnic_group"), ("Martian", "other_ethnic_group"), ("Mixed other", "mixed_or_multiple_ethnic_groups")],
)
def test_census_groups(spark, text, group):
    assert spark.createDataFrame([(text,)], "t string").select(X.census_group(F.col("t"))).first()[0] == group


def test_features_round_trip_b7(spark, tmp_path):
    long = spark.createDataFrame([("P001", date(2024, 1, 1), "feature_1", 1.5), ("P001", date(2024, 1, 1), "feature_2", 0.8)], "client_id string, slice_start date, feature string, value double")
    assert rows(X.unpacked(X.packed(long)), *X.LONG) == rows(long, *X.LONG)
    path = str(tmp_path / "features")
    T.write_keyed(X.packed(long), path, "client_id", 4)
    T.replace_keys(X.packed(long.withColumn("value", F.lit(2.0)).where("feature = 'feature_1'")), path, "client_id", 4)
    assert rows(X.unpacked(T.read_keyed(spark, path, "client_id", "P001", 4)), "feature", "value") == [("feature_1", 2.0)]
    wide = X.pivoted(long, ["feature_1", "feature_9"]).first()
    assert wide["feature_1"] == 1.5 and wide["feature_9"] is None
    T.delete_keys(spark, path, long.select("client_id").distinct(), "client_id", 4)
    assert T.read_keyed(spark, path, "client_id", schema=X.packed(long).schema).count() == 0


def test_annotation_filter_b3(spark):
    data = [(["disease", "finding"], "Recent", "True", "Patient", 0.9, 0.85), (["procedure"], "Past", "True", "Family", 0.8, 0.95), (["medication"], "Future", "False", "Patient", 0.7, 0.6), (["observation", "disease"], "Recent", "True", "Patient", 0.95, 0.9), (None, "Recent", "True", "Patient", 0.95, 0.9)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, types array<string>, Time_Value string, Presence_Value string, Subject_Value string, Time_Confidence double, acc double")
    keep = lambda **k: [r[0] for r in rows(S.annotation_filter(df, **k), "i")]
    assert keep(types=["Disease"]) == [0, 3]
    assert keep(types=["dis"]) == [] and keep(types=["dis"], loose=True) == [0, 3]
    assert keep(values={"Time_Value": ["Recent", "Past"], "Absent": ["x"]}, least={"acc": 0.9}) == [1, 3, 4]
    assert keep(least={"Time_Confidence": 0.9}) == [0, 3, 4]
    lists = spark.createDataFrame([("['a','b']",), ("[broken",), (None,)], "t string").select(S.list_column(F.col("t")).alias("l"))
    assert [r[0] for r in lists.collect()] == [["a", "b"], None, None]


def mark(spark, data):
    return spark.createDataFrame(data, "client_id string, t timestamp, tie int, cui long").withColumn("ts", F.col("t").cast("timestamp_ntz"))


def test_index_event_b4(spark):
    docs, notes = mark(spark, [("P001", datetime(2021, 5, 1), 1, 7)]), mark(spark, [("P001", datetime(2021, 3, 1), 2, 7), ("P001", datetime(2021, 9, 1), 3, 7)])
    clients = spark.createDataFrame([("P001",), ("P002",)], "client_id string")
    fall = F.lit(datetime(2020, 1, 1))
    got = lambda mode: rows(A.index_events(clients, {"docs": docs, "notes": notes}, [7], mode, fall), "client_id", "index_ts", "source")
    assert got("earliest") == [("P001", datetime(2021, 3, 1), "notes"), ("P002", datetime(2020, 1, 1), "fallback")]
    assert got("latest")[0] == ("P001", datetime(2021, 5, 1), "docs")  # the earliest source still wins


def test_cooccurrence_b5(spark):
    day = lambda m, d: datetime(2023, m, d)
    a = mark(spark, [("P001", day(1, 1), 1, 101), ("P001", day(1, 5), 2, 102), ("P002", day(2, 1), 3, 101), ("P003", day(3, 1), 4, 102), ("P004", day(4, 1), 5, 101), ("P004", day(4, 2), 6, 102)])
    assert rows(A.cooccurring(a), "a", "b", "clients") == [(101, 102, 2)]
    both = A.clients_with_all(a, [[101], [102]])
    assert rows(both, "client_id") == [("P001",), ("P004",)]
    index = a.join(both, "client_id").groupBy("client_id").agg(F.min("ts").alias("index_ts"))
    assert rows(A.index_windows(index), "client_id", "win_from", "win_to") == [("P001", datetime(2023, 4, 1), datetime(2024, 4, 1)), ("P004", datetime(2023, 7, 1), datetime(2024, 7, 1))]


def test_flatten_b6(spark):
    js = '{"entities":{"ent1":{"cui":"C0015967","pretty_name":"Fever","acc":0.9,"start":2,"end":7,"meta_anns":{"Subject/Experiencer":{"value":"Patient","confidence":0.8},"Subject":{"value":"Other"}}}}}'
    df = spark.createDataFrame([(1, "a fever b", js), (2, "x", "broken"), (3, "x", None)], "id int, text string, e string")
    got = A.flatten(df, "id", "text", "e", window=1).collect()
    assert len(got) == 1 and got[0]["cui"] == "C0015967" and got[0]["Subject_Value"] == "Patient" and got[0]["text_sample"] == " fever " and got[0]["Time_Value"] is None


def test_split_notes(spark):
    ts = datetime(2020, 1, 1)
    texts = ["first Entered on - 05-Feb-2021 10:30 second Entered on - 06-Feb-2021 11:00 rest", "no marker", "odd Entered on - nothing here. more Entered on - 07-Feb-2021 09:00 x", "bad Entered on - 99-Feb-2021 10:30 x"]
    df = spark.createDataFrame([(i, t, ts, "Note") for i, t in enumerate(texts)], "id int, text string, t timestamp, d string").select("id", "text", F.col("t").cast("timestamp_ntz").alias("ts"), "d")
    got = {(r["id"], r["chunk"]): (r["text"], r["ts"], r["d"]) for r in A.split_notes(df, "id", "text", "ts", "d").collect()}
    assert got[(0, 0)] == ("first Entered on - 05-Feb-2021 10:30 ", datetime(2021, 2, 5, 10, 30), "Note_clinical note chunk_0")
    assert got[(0, 1)] == ("second Entered on - 06-Feb-2021 11:00 ", datetime(2021, 2, 6, 11, 0), "Note_clinical note chunk_1")
    assert got[(1, None)][0] == "no marker" and got[(3, None)][2] == "Note"
    assert got[(2, 0)] == ("odd ", ts, "Note_clinical note chunk_0") and got[(2, 1)][0].startswith("Entered on - nothing here. more")


def test_concat_csv_b9(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id, name \n1, x \n")
    (tmp_path / "b.csv").write_text("id,age\n2,30\n")
    df = T.concat_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert df.columns == ["age", "id", "name"] and rows(df, *df.columns) == [("", "1", "x"), ("30", "2", "")]
    assert T.concat_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], first=1).columns == ["id", "name"]


def test_nearest(spark):
    at = lambda *d: datetime(2024, *d)
    t = spark.createDataFrame([(1, "c", at(3, 1)), (2, "c", None), (3, "d", at(3, 1))], "row int, client_id string, t timestamp").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    r = spark.createDataFrame([("c", "hb", at(2, 28), 1.0), ("c", "hb", at(3, 2), 2.0), ("c", "na", at(2, 20), 9.0), ("c", "na", at(3, 11), 8.0)], "client_id string, test string, t timestamp, value double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = {x["row"]: (x["hb"], x["na"]) for x in J.matcher(t, r, "row", ["hb", "na"], 10, 10).collect()}
    assert got == {1: (2.0, None), 3: (None, None)}  # both na lie on the open interval's edges


def test_impute(spark):
    data = [("a", 1, None, 1.0), ("a", 2, 2.0, None), ("a", 3, None, None), ("b", 1, None, None), ("b", 2, None, 5.0)]
    df = spark.createDataFrame(data, "k string, t int, x double, y double")
    assert rows(M.impute(df, "k", "t", ["x", "y"]), "k", "t", "x", "y") == [("a", 1, 2.0, 1.0), ("a", 2, 2.0, 1.0), ("a", 3, 2.0, 1.0), ("b", 1, 2.0, 5.0), ("b", 2, 2.0, 5.0)]
    assert M.impute(df, "k", "t", ["x"], mean=False).where("x is null").count() == 2
    split = df.withColumn("split", F.when(F.col("k") == "a", "train").otherwise("test")).withColumn("z", F.lit(None).cast("double"))
    out = M.impute_train_mean(split, ["x", "y", "z"])
    assert "z" not in out.columns and rows(out.where("k = 'b'"), "x", "y") == [(2.0, 1.0), (2.0, 5.0)]
    assert M.impute(df.limit(0), "k", "t", ["x"]).count() == 0


def test_cohort(spark):
    ids = spark.createDataFrame([("a000001", "x"), ("b000002", "y"), (None, "z"), ("bad", "w")], "hospital string, other string")
    assert C.id_column(ids) == "hospital"
    own = C.cohort_ids(ids)
    assert own.count() == 3
    assert rows(C.sanitised(own), "client_id", "well_formed") == [("A000001", True), ("B000002", True), ("bad", False)]
    everyone = spark.range(100).select(F.col("id").cast("string").alias("client_id"))
    treated = everyone.where("client_id < '2'")
    c = C.controls(everyone, treated, 1.0)
    assert c.count() == treated.count() and c.join(treated, "client_id").count() == 0
    assert rows(c, "client_id") == rows(C.controls(everyone, treated, 1.0), "client_id")
    assert C.id_clusters(C.sanitised(own).select("client_id"), 2).count() == 2


def test_text_matching(spark):
    df = spark.createDataFrame([("severe chest  pain, today",), ("pain in the chest",), (None,), ("",)], "t string")
    got = lambda c: [r[0] for r in df.select(c).collect()]
    assert got(near_token(F.col("t"), "chets", 2))[:2] == [True, True]
    assert got(near_phrase(F.col("t"), "chest pain"))[:2] == [True, False]
    assert got(partial_similarity(F.lit("pain"), F.col("t")))[:2] == [100.0, 100.0]
    assert df.select(S.regex_findall(F.col("t"), "p[a-z]+")).first()[0] == "pain"


def test_anonymous_names(spark):
    names = ["hb_mean", "hb_max", "bed_icu", "age", "male", "census_white"]
    key = N.feature_key(spark.createDataFrame([(n,) for n in names], "feature string"))
    got = dict(rows(key, "feature", "anonymous"))
    assert got["hb_mean"].removesuffix("_mean") == got["hb_max"].removesuffix("_max") and got["bed_icu"].startswith("bed_concept_") and got["age"] == "feature_0"
    long = spark.createDataFrame([(n, 1.0) for n in names], "feature string, value double")
    assert rows(N.named_again(N.anonymous(long, key), key), "feature") == sorted((n,) for n in names)


def test_deid(spark):
    df = spark.createDataFrame([("mail a.b@x.example.com or +1 (319) 555-5132 from 10.0.0.1 on 2024-01-01",), (None,)], "t string")
    assert [r[0] for r in N.deidentify(df, ["t"], redact=False).select("t_anonymized").collect()] == ["mail [EMAIL] or [PHONE] from [IP] on [DATE]", ""]
    p = N.positions(df, "t", "t", "IP", N.RULES["IP"]).first()
    assert p["t"][p["start"] : p["end"]] == "10.0.0.1"


def test_storage_checks(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, v int")
    assert T.verify_split(a, a, "k").count() == 0
    assert rows(T.verify_split(a, a.where("v <> 2"), "k"), "k", "problem", "rows") == [("x", "missing row", 1)]
    assert T.with_columns(a, ["k", "none"]).first()["none"] is None


def test_model_hook(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "id long, text string")

    def model(batch):
        return batch.assign(n=batch.text.str.split().str.len())[["id", "n"]]

    assert rows(A.annotate_with_model(docs, model, "id long, n long"), "id", "n") == [(1, 2), (2, 1)]
