"""What is spread over many tasks gives the same as what one task would: numbers, draws, keyed tables, headers; extractors by name."""

import hashlib
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewheel.functions.times import FORMS, parsed
from tidewheel.operators import annotations as A
from tidewheel.operators import anonymise as N
from tidewheel.operators import cohort as C
from tidewheel.operators import extractors as E
from tidewheel.operators import features as X
from tidewheel.operators import numbering
from tidewheel.operators.slicing import control_windows
from tidewheel.sources import tables as T
from tidewheel.spec import RunSpec, Span


def test_numbers_of_a_hot_group(spark):
    r = random.Random(1)
    rows = [("hot", i) for i in r.sample(range(10_000), 3000)] + [("cold", 5), (None, 1), (None, 2), ("nulls", None), ("nulls", 3)]
    df = spark.createDataFrame(rows, "g string, o long").repartition(5)
    got = {(x["g"], x["o"]): x["n"] for x in numbering.numbered(df, "g", "o", "n").collect()}
    want = {}
    for g in {g for g, _ in rows}:
        own = sorted((o for k, o in rows if k == g), key=lambda o: (o is not None, o or 0))
        want |= {(g, o): i for i, o in enumerate(own)}
    assert got == want
    assert numbering.numbered(df.limit(0), "g", "o", "n").count() == 0


def test_draws_in_the_order_of_marks(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20_000)], "client_id string")
    marks = sorted(range(20_000), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    for n in (0, 1, 777, 30_000):
        assert {int(r[0]) for r in C.drawn(df, "client_id", n).collect()} == set(marks[:n])


def test_control_windows_cover_all_windows(spark):
    windows = spark.range(3000).select(F.concat(F.lit("t"), "id").alias("client_id"), F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).cast("timestamp_ntz").alias("win_from")).withColumn("win_to", F.col("win_from"))
    controls = spark.range(30_000).select(F.concat(F.lit("c"), "id").alias("client_id"))
    got = control_windows(controls, windows)
    assert got.count() == 30_000 and got.select("win_from").distinct().count() > 2900
    assert control_windows(controls, windows.limit(0)).count() == 0


def test_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id", F.create_map(F.lit("a"), "id").alias("m"))
    T.write_keyed(rows, f"{tmp_path}/t", "k", 4, task_rows=100)
    files = T.read_keyed(spark, f"{tmp_path}/t", "k", "hot", 4).inputFiles()
    assert len([f for f in files if f"key_bucket={T.bucket_of(spark, 'hot', 4)}" in f]) > 3
    assert T.read_keyed(spark, f"{tmp_path}/t", "k").count() == 1000 and T.read_keyed(spark, f"{tmp_path}/t", "k", "hot", 4).count() == 700


def test_recovery_of_a_change_written_aside(spark, tmp_path):
    path = f"{tmp_path}/t"
    T.write_keyed(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, "k", 2)
    assert not T.recover(spark, path)
    aside = spark.createDataFrame([("a", 9)], "k string, v int").withColumn("key_bucket", T.bucket("k", 2))
    aside.write.parquet(f"{path}-aside")  # as if the change had stopped before the table was touched
    assert T.recover(spark, path) and not T.recover(spark, path)
    kept = {tuple(r) for r in T.read_keyed(spark, path, "k").collect()}
    assert ("a", 9) in kept and ("a", 1) not in kept


def test_csv_headers_in_one_job(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.csv").write_text(f'id,"na, me"\n{i},"x, y"\n' if i % 2 else f"id\n{i}\n")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    headers = T._headers(spark, [f"{tmp_path}/{i}.csv" for i in range(12)])
    assert len(headers) == 12 and len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before) <= 2
    got = sorted((int(r["id"]), r["na, me"]) for r in T.concat_csv(spark, [f"{tmp_path}/{i}.csv" for i in range(12)]).collect())
    assert got == [(i, "x, y" if i % 2 else "") for i in range(12)]


@pytest.mark.parametrize("most", [500_000, 0])
def test_concepts_of_several_words(spark, monkeypatch, most):
    monkeypatch.setattr(A, "VOCABULARY", most)
    vocabulary = spark.createDataFrame([("heart", 1), ("heart failure", 2), ("failure of growth", 3), ("growth", 4)], "word string, cui long")
    docs = spark.createDataFrame([(1, "Heart failure, of growth"), (2, "no heart; failure"), (3, None), (4, "heartfailure")], "id long, text string")
    got = sorted((r["id"], r["position"], r["cui"]) for r in A.annotate(docs, vocabulary, "id", "text").collect())
    assert got == [(1, 0, 1), (1, 0, 2), (1, 1, 3), (1, 3, 4), (2, 1, 1), (2, 1, 2)]


def test_date_forms_as_strptime_has_them(spark):
    names = {"d": "%d", "M": "%m", "yyyy": "%Y", "yy": "%y", "H": "%H", "m": "%M", "s": "%S"}
    import re

    python = [re.sub("yyyy|yy|[dMHms]", lambda m: names[m[0]], f) for f in FORMS]
    assert len(FORMS) == 24

    def first(text):
        for f in python:
            try:
                return datetime.strptime(text, f)
            except ValueError:
                pass

    texts = [t.strftime(f) for t in (datetime(2024, 11, 25, 14, 5, 9), datetime(1975, 3, 4), datetime(2024, 3, 31, 1, 2, 3)) for f in python]
    texts += ["5/3/24", "31/02/2024", "13/13/2024", "nan", "NaT", "", " 1.2.03 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parsed(F.col("t")).alias("p"))
    assert [(r["t"], r["p"]) for r in df.collect()] == [(t, first(t.strip())) for t in texts]


DAY = RunSpec(start=date(2024, 1, 1), span=Span(days=2))


def observed(spark):
    rows = [("a", "2024-01-01 10:00:00", "NEWS2_Score", 3.0, None), ("a", "2024-01-01 11:00:00", "NEWS2_Score", 25.0, None), ("a", "2024-01-01 12:00:00", "OBS Height", 170.0, None),
            ("a", "2024-01-01 12:00:00", "CORE_VTE_STATUS", 9.0, "High risk of VTE High risk of bleeding"), ("a", "2024-01-01 13:00:00", "CORE_SpO2", None, "94-98%"), ("b", "2024-01-03 00:00:00", "CORE_HospitalSite", None, "PRUH 2"), ("z", "2024-01-01 00:00:00", "CORE_BedNumber3", None, "7")]
    return spark.createDataFrame(rows, "client_id string, ts string, item string, value double, text string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_extractors_by_name(spark):
    obs = observed(spark)
    news = {(r["client_id"], str(r["slice_start"]), r["feature"]): r["value"] for r in E.EXTRACTORS["news"].rows(obs, DAY).collect()}
    assert news[("a", "2024-01-01", "news_score_n")] == 1.0 and news[("a", "2024-01-01", "news_score_max")] == 3.0
    rows = {n: E.EXTRACTORS[n].rows(obs, DAY).select("feature").distinct().collect() for n in ("bmi", "core_02", "hosp_site", "bed")}
    assert rows["bmi"] == [] and {r[0] for r in rows["core_02"]} == {"core_02_94_98pct"} and {r[0] for r in rows["hosp_site"]} == {"hosp_site_dh", "hosp_site_ph"}
    assert {r[0] for r in rows["bed"]} == {"bed_7"}


def test_vectors_of_chosen_extractors(spark, monkeypatch):
    clients = spark.createDataFrame([("a",), ("b",), ("c",)], "client_id string")
    out = E.vectors({"observations": observed(spark)}, DAY, {"news": True, "vte_status": True, "core_02": True, "hosp_site": True, "bmi": True, "bloods": False}, clients)
    got = {(r["client_id"], str(r["slice_start"])): r["features"] for r in out.collect()}
    assert len(got) == 9 and got[("c", "2024-01-02")] == {} and ("z", "2024-01-01") not in got
    assert got[("a", "2024-01-01")]["vte_status_mean"] == 1.0 and got[("a", "2024-01-01")]["core_02_94_98pct"] == 1.0 and got[("b", "2024-01-03")] == {"hosp_site_dh": 0.0, "hosp_site_ph": 1.0}
    alone = {r["client_id"] for r in E.vectors({"observations": observed(spark)}, DAY, {"bed": True}).collect()}
    assert alone == {"z"}
    with pytest.raises(ValueError, match="no such"):
        E.vectors({}, DAY, {"nothing": True})
    monkeypatch.setitem(E.EXTRACTORS, "any", E.Extractor("observations", "by_slice", lambda: X.flags_part({"any_pruh": "PRUH"}, False)))
    assert {r["features"]["any_pruh"] for r in E.vectors({"observations": observed(spark)}, DAY, {"any": True}).collect()} == {0.0, 1.0}


def test_times_fill_one_another(spark):
    a = spark.createDataFrame([(1, "t1", "d1")], "document_guid long, updatetime string, body_analysed string")
    b = spark.createDataFrame([(2, "t2", "d2")], "observation_guid long, observationdocument_recordeddtm string, observation_valuetext_analysed string")
    c = spark.createDataFrame([(3, "t3", "d3")], "basicobs_guid long, basicobs_entered string, textualObs string")
    m = A.merged({"epr": a, "mct": b, "textual_obs": c}, A.DOCUMENT_CHAINS, tag="source")
    got = sorted((r["source"], r["document_guid"], r["updatetime"], r["observationdocument_recordeddtm"], r["body_analysed"]) for r in m.collect())
    assert got == [("epr", 1, "t1", "t1", "d1"), ("mct", 2, "t2", "t2", "d2"), ("textual_obs", 3, "t3", "t3", "d3")] and "basicobs_entered" not in m.columns


def test_sanitised_cohort(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "client_id string")
    out = C.build(ids("a000001", "bad", "B000002"), ids("c000003", "d000004", "e00000x"), [ids("A000001", "C000003", "D000004")], 5.0)
    assert {tuple(r) for r in out.collect()} == {("A000001", True), ("C000003", False), ("D000004", False)}


def test_id_clusters_group_letters(spark):
    ids = [f"A{i:06d}" for i in range(50)] + [f"B{i:06d}" for i in range(50)] + [f"C{i:06d}" for i in range(50)] + ["bad"]
    out = C.id_clusters(spark.createDataFrame([(i,) for i in ids], "client_id string")).collect()
    assert sum(r["n"] for r in out) == 150
    assert {p: len({r["cluster"] for r in out if r["prefix"] == p}) for p in "ABC"} == {"A": 1, "B": 1, "C": 1} and len({r["cluster"] for r in out}) == 3


def test_census_words_from_a_table(spark):
    words = spark.createDataFrame([("black_african_caribbean_or_black_british", "Nigerian"), ("white", "Polish"), ("white", None)], "census string, word string")
    more = X.census_words(words)
    said = spark.createDataFrame([("Nigerian",), ("polish",), ("Any other",)], "t string")
    assert [r[0] for r in said.select(X.census_group(F.col("t"), more)).collect()] == ["black_african_caribbean_or_black_british", "white", "other_ethnic_group"]
    assert said.select(X.census_group(F.col("t"))).first()[0] == "other_ethnic_group"
    with pytest.raises(ValueError, match="groups"):
        X.census_words(words.withColumn("census", F.lit("none")))


def test_too_many_names_are_refused(spark, monkeypatch):
    monkeypatch.setattr(N, "MOST_NAMES", 3)
    with pytest.raises(ValueError, match="names"):
        N.feature_key(spark.range(10).select(F.col("id").cast("string").alias("feature")))
