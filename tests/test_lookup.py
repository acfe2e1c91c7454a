"""lookup_client reads whole rows of every kind of data, also where tables are empty or have odd rows."""

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewheel.plans import sourcing
from tidewheel.sources import tables as T
from tidewheel.sources.stand_ins import Tables

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
#: The data types of the reference's retrieve_data.py.
TYPES = {
    "epr_docs", "mct_docs", "bloods", "drugs", "diagnostics", "news", "bmi", "demographics", "textual_obs", "reports", "appointments",
    "epr_annotations", "mct_annotations", "textual_obs_annotations", "report_annotations",
}


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def same_as_sql(df, top):
    duck = duckdb.connect()
    for name in os.listdir(top):
        path = f"{top}/{name}"
        duck.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    result = duck.execute(ORACLES["lookup_client"])
    columns = [d[0] for d in result.description]
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert sorted(df.columns) == sorted(columns) and got == sorted(tuple(map(plain, r)) for r in result.fetchall())
    return got


def test_every_kind_of_data_has_a_keyed_table(spark):
    tables, schemas = sourcing._keyed_kinds(Tables(spark, SF))
    assert set(tables) == TYPES | {"other_obs"} and set(schemas) == set(tables)
    assert {name for name, (_, key) in tables.items() if key == "HospitalID"} == {"appointments"}
    t = Tables(spark, SF)
    want = {"epr_docs": t.documents(), "reports": t.reports(), "textual_obs": t.textual_obs(), "epr_annotations": t.annotations(), "mct_annotations": t.annotations(t.notes())}
    for name, rows in want.items():
        kept = T.read_keyed(spark, *tables[name], schema=schemas[name])
        assert kept.count() == rows.count() > 0 and set(kept.columns) == set(rows.columns) - {"tie"}
    ward = [T.read_keyed(spark, *tables[name]).count() for name in ("news", "bmi", "other_obs")]
    assert all(ward) and sum(ward) == t.observations().count()


def test_rows_are_whole(spark):
    got = QUERIES["lookup_client"](spark, "/root/testdata/sf0.01").cache()
    assert {r[0] for r in got.select("source").distinct().collect()} == TYPES | {"other_obs"}
    texts = {r["doc_id"]: r["text"] for r in Tables(spark, "/root/testdata/sf0.01").documents().where("client_id = 'c7'").collect()}
    assert len(texts) > 10 and {r["record"]: r["text"] for r in got.where("source = 'epr_docs'").collect()} == texts
    assert got.where("source = 'demographics' and born is not null").count() and got.where("source = 'report_annotations' and (cui is null or acc is null or Time_Value is null)").isEmpty()


@pytest.mark.parametrize("few", [True, False])
def test_empty_tables_and_odd_rows(spark, tmp_path, monkeypatch, few):
    """No conversations, pages or labels (or labels too many for a broadcast); texts, clients and items that are null."""
    top = str(tmp_path)
    monkeypatch.setattr(T, "BROADCAST_KEYS", T.BROADCAST_KEYS if few else 10)
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    odd = {"documents": read("documents").withColumn("text", F.when(F.col("doc_id") != 57, F.col("text")))}
    if few:
        odd |= {name: read(name).where("false") for name in ("conversations", "pages", "labels")}
        n = F.col("event_id")
        odd["events"] = read("events").withColumn("user_id", F.when(n % 5 == 0, 17).when(n % 7 != 0, F.col("user_id"))).withColumn("event_type", F.when(n % 3 != 0, F.col("event_type")))
    for name in os.listdir(SF):
        if name.removesuffix(".parquet") not in odd:
            shutil.copy(f"{SF}/{name}", f"{top}/{name}")
    for name, rows in odd.items():
        rows.write.parquet(f"{top}/{name}.parquet")
    got = same_as_sql(QUERIES["lookup_client"](spark, top), top)
    kinds = {r[0] for r in got}
    assert {"epr_docs", "epr_annotations"} <= kinds and ("textual_obs" in kinds) != few
    assert not few or {"bloods", "news", "other_obs"} <= kinds
