"""Scans, adapters' building blocks, and sinks over Parquet and CSV."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.times import parsed
from tidewheel.operators.slicing import decode_one_hot, in_window

#: Rows of a key list up to which it is broadcast; beyond, the join shuffles both sides.
BROADCAST_KEYS = 1_000_000


def keyed(rows: DataFrame, keys: DataFrame, key: str, bound: int = BROADCAST_KEYS) -> DataFrame:
    """Rows whose key is in keys (one column of that name). A key list is broadcast only if it is known to be small."""
    keys = keys.select(key).where(F.col(key).isNotNull()).distinct()
    small = keys.limit(bound + 1).count() <= bound
    return rows.join(F.broadcast(keys) if small else keys, key, "left_semi")


def scan(rows: DataFrame, fields: list[str] | None = None, where: Column | None = None, keys: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Predicate, then key list, then projection; a field that the table lacks is null."""
    out = rows if where is None else rows.where(where)
    if keys is not None:
        out = keyed(out, keys, key)
    return out if fields is None else with_columns(out, fields)


def with_columns(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.select(*(F.col(f) if f in rows.columns else F.lit(None).cast("string").alias(f) for f in fields))


def in_range(rows: DataFrame, ts: str, first: date, last: date) -> DataFrame:
    return rows.where(in_window(F.col(ts), first, last))


def canonical(rows: DataFrame, client: str, ts: str, item: str | None, value: str | None, text: str | None, source: str) -> DataFrame:
    """client_id, ts, item, value, text, source."""
    of = lambda c, kind: (F.col(c) if c else F.lit(None)).try_cast(kind)
    return rows.select(F.col(client).cast("string").alias("client_id"), F.col(ts).cast("timestamp_ntz").alias("ts"), of(item, "string").alias("item"), of(value, "double").alias("value"), of(text, "string").alias("text"), F.lit(source).alias("source"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def clean_documents(rows: DataFrame, ts: str, text: str) -> DataFrame:
    """Times coerced (null if they don't parse); rows without time or text go."""
    time = F.col(ts) if not isinstance(rows.schema[ts].dataType, T.StringType) else parsed(F.col(ts))
    return rows.withColumn(ts, time).where(F.col(ts).isNotNull() & F.col(text).isNotNull())


def standard(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A consolidated table: these columns in this order, null where the source has none."""
    return with_columns(rows, columns)


def merged_sources(parts: dict[str, DataFrame], columns: dict[str, str], tag: str = "source") -> DataFrame:
    """One consolidated table of several sources: these columns (name -> type) in this order, null where a source has none."""
    own = lambda rows: [(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
    return union_all([rows.select(F.lit(name).alias(tag), *own(rows)) for name, rows in parts.items()])


def fetch_documents(rows: DataFrame, key: str, text: str, ts: str, description: str, first: date, last: date, split: bool = False) -> DataFrame:
    """Documents with a text whose time is in a closed range of days; with split, notes are cut into their entries first,
    and each entry is in or out by its own time (key, chunk, text, ts, description)."""
    clean = clean_documents(rows, ts, text)
    if split:
        from tidewheel.operators.annotations import split_notes

        clean = split_notes(clean, key, text, ts, description)
    return in_range(clean, ts, first, last)


# --- sinks ------------------------------------------------------------------------------------------


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


#: Rows that one task writes to a bucket, at most about so many: it sorts them, so this bounds its memory.
TASK_ROWS = 1_000_000


def _spread(rows: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """rows (with key_bucket) dealt for writing: a bucket of very many rows, one hot key's too, to several tasks.

    Buckets are counted first; rows of a crowded bucket are split by a hash of all their plain columns.
    """
    counts = {r[0]: -(-r[1] // task_rows) for r in rows.groupBy("key_bucket").agg(F.count("*")).collect()}  # buckets of them at most
    crowded = {k: n for k, n in counts.items() if n > 1}
    tasks = max(1, sum(counts.values()))
    if not crowded:
        return rows.repartition(tasks, "key_bucket")
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    splits = F.coalesce(F.create_map(*(F.lit(x) for kv in crowded.items() for x in kv))[F.col("key_bucket")], F.lit(1))
    return rows.repartition(tasks, "key_bucket", F.pmod(F.xxhash64(*plain), splits))


@contextmanager
def _made_once(rows: DataFrame) -> Iterator[DataFrame]:
    """rows on the executors' disks while they are counted and written, so that they are not made for each of these."""
    made = rows.persist(StorageLevel.DISK_ONLY)
    try:
        yield made
    finally:
        made.unpersist()


def write_keyed(rows: DataFrame, path: str, key: str, buckets: int = 64, task_rows: int = TASK_ROWS, in_place: bool = False) -> None:
    """Writes a table in which each key's rows lie in one of a fixed number of folders. buckets grows with the table:
    about one for each few million rows, so that a key's lookup reads little. in_place: rows are not dealt, and each task
    writes to all buckets of its rows; for long rows straight from a scan, and for rows made from a table with these buckets."""
    rows = rows.withColumn("key_bucket", bucket(key, buckets))
    if in_place:
        rows.write.mode("overwrite").partitionBy("key_bucket").parquet(path)
        return
    with _made_once(rows) as made:
        _spread(made, task_rows).write.mode("overwrite").partitionBy("key_bucket").parquet(path)


def _put_back(spark: SparkSession, aside: str, path: str, schema: T.StructType) -> None:
    """Writes the table aside over its buckets of the table at path. aside stays until this is done, so that after a
    crash in between it can be done again (recover)."""
    rows = spark.read.schema(schema).parquet(aside)
    _spread(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key_bucket").parquet(path)


def _folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _drop_aside(spark: SparkSession, path: str) -> None:
    store, folder = _folder(spark, f"{path.rstrip('/')}-aside")
    store.delete(folder, True)


def recover(spark: SparkSession, path: str) -> bool:
    """After a crash inside replace_keys or delete_keys: finishes a change that was written aside whole; True if there was
    one. A change that had not been written whole has not touched the table, and is dropped. Call it before reading."""
    aside = f"{path.rstrip('/')}-aside"
    store, folder = _folder(spark, aside)
    if not store.exists(folder):
        return False
    whole = store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{aside}/_SUCCESS"))
    if whole:
        rows = spark.read.parquet(aside)
        _put_back(spark, aside, path, rows.schema)
    _drop_aside(spark, path)
    return whole


def replace_keys(rows: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Replaces all rows of the keys that occur in rows; only their buckets are rewritten.

    The new buckets go to a table beside the old one first, since a table can't be overwritten while it is read; it is
    removed at the end.
    """
    spark = rows.sparkSession
    with _made_once(rows.withColumn("key_bucket", bucket(key, buckets))) as new:
        touched = [r[0] for r in new.select("key_bucket").distinct().collect()]  # buckets of them at most
        old = spark.read.parquet(path).where(F.col("key_bucket").isin(touched)).join(new.select(key).distinct(), key, "left_anti")
        both, aside = old.unionByName(new, allowMissingColumns=True), f"{path.rstrip('/')}-aside"
        both.write.mode("overwrite").parquet(aside)
    _put_back(spark, aside, path, both.schema)
    _drop_aside(spark, path)


def read_keyed(spark: SparkSession, path: str, key: str, value: str | None = None, buckets: int = 64, schema: T.StructType | None = None) -> DataFrame:
    """The table, or one key's rows from its bucket alone. A schema is needed only if the table may be empty."""
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField("key_bucket", T.IntegerType())]))
    rows = reader.parquet(path)
    if value is not None:
        rows = rows.where((F.col("key_bucket") == bucket_of(spark, value, buckets)) & (F.col(key) == value))
    return rows.drop("key_bucket")


def bucket_of(spark: SparkSession, value: str, buckets: int) -> int:
    return spark.range(1).select(F.lit(value).alias("k")).select(bucket("k", buckets)).first()[0]


def delete_keys(spark: SparkSession, path: str, keys: DataFrame, key: str, buckets: int = 64) -> None:
    """Removes all rows of some keys; only their buckets are rewritten, and folders that are left without rows go."""
    touched = {r[0] for r in keys.select(bucket(key, buckets)).distinct().collect()}  # buckets of them at most
    kept = spark.read.parquet(path).where(F.col("key_bucket").isin(list(touched))).join(keys.select(key).distinct(), key, "left_anti")
    aside = f"{path.rstrip('/')}-aside"
    kept.write.mode("overwrite").parquet(aside)
    left = {r[0] for r in spark.read.schema(kept.schema).parquet(aside).select("key_bucket").distinct().collect()}
    _put_back(spark, aside, path, kept.schema)
    for empty in touched - left:
        store, folder = _folder(spark, f"{path.rstrip('/')}/key_bucket={empty}")
        store.delete(folder, True)
    _drop_aside(spark, path)


def lookup(spark: SparkSession, tables: dict[str, tuple[str, str]], value: str, buckets: int = 64, schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """One key's rows of every keyed table: name -> (path, key column), and name -> rows, read from one bucket each.
    Tables that may be empty need their schemas (by name)."""
    return {name: read_keyed(spark, path, key, value, buckets, (schemas or {}).get(name)) for name, (path, key) in tables.items()}


def delete_everywhere(spark: SparkSession, tables: dict[str, tuple[str, str]], keys: DataFrame, buckets: int = 64) -> None:
    """Removes all rows of some keys (one column) from every keyed table, whatever its key column is called. The keys are
    written down first, since they may come from these tables."""
    (own,) = keys.columns
    if not tables:
        return
    aside = f"{next(iter(tables.values()))[0].rstrip('/')}-keys"
    keys.where(F.col(own).isNotNull()).distinct().write.mode("overwrite").parquet(aside)
    held = spark.read.schema(keys.schema).parquet(aside)
    for path, key in tables.values():
        delete_keys(spark, path, held.select(F.col(own).alias(key)), key, buckets)
    store, folder = _folder(spark, aside)
    store.delete(folder, True)


def as_json(rows: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return rows.select(*(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in rows.schema.fields))


def _headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    """(file, its first line) of all files under the paths, in one job: the line that starts at byte 0."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return sorted((r["file"], r["header"]) for r in first.collect())  # a row a file, of which the caller has listed the paths


def concat_csv(spark: SparkSession, paths: list[str], first: int | None = None, stamp: bool = False) -> DataFrame:
    """Files of differing headers as one table: the union of the headers in order, names and values trimmed, missing cells empty.

    One job finds the headers of all files; files of the same header are read together. With stamp, one-hot columns of
    slices (d_yyyy_MM_dd) become extracted_datetime_stamp, a date, null where none of them is 1.
    """
    paths = paths[:first] if first is not None else paths
    headers: dict[str, list[str]] = {}
    for file, header in _headers(spark, paths) if paths else []:
        headers.setdefault(header.removeprefix("\ufeff"), []).append(file)
    parts = []
    for header, files in headers.items():
        columns = next(csv.reader([header]), [])
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = spark.read.option("header", True).option("enforceSchema", True).schema(schema).csv(files)
        parts.append(rows.select(*(F.trim(F.col(f"`{c}`")).alias(c.strip()) for c in columns)))
    if not parts:
        return spark.createDataFrame([], "empty string").select()
    out = union_all(parts)
    out = out.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in sorted(out.columns)))
    return decode_one_hot(out).withColumnRenamed("slice_start", "extracted_datetime_stamp") if stamp else out


def verify_split(original: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """key, problem, rows: keys missing from or added by a split (1), and how many rows differ either way.

    Each key's rows are summed up on either side, order left aside: how many, and sums of two hashes. Rows themselves are
    compared only for keys whose sums differ, so a split without faults costs one aggregation a side.
    """
    columns = original.columns
    plain = [F.to_json(F.struct(f.name)) if isinstance(f.dataType, (T.MapType, T.VariantType)) else F.col(f"`{f.name}`") for f in original.schema.fields]
    hashed = lambda rows, side: rows.select(key, F.lit(side).alias("side"), F.xxhash64(*plain).alias("one"), F.xxhash64(F.lit(7), *plain).alias("two"))
    at = lambda side, x: F.when(F.col("side") == side, x)
    sums = lambda side: F.struct(F.count(at(side, 1)).alias("n"), *(F.coalesce(F.sum(at(side, F.col(c).cast("decimal(38,0)"))), F.lit(0)).alias(c) for c in ("one", "two"))).alias(side)
    both = hashed(original, "a").unionByName(hashed(split, "b")).groupBy(key).agg(sums("a"), sums("b"))
    unlike = both.where(~F.col("a").eqNullSafe(F.col("b")))
    of = lambda rows, what: rows.select(key, F.lit(what).alias("problem"), F.lit(1).cast("long").alias("rows"))
    out = [of(unlike.where("b.n = 0"), "missing key"), of(unlike.where("a.n = 0"), "extra key")]
    if not unlike.isEmpty():
        faulty = unlike.select(F.col(key).alias("tw_key"))
        own = lambda rows: rows.join(faulty, rows[key].eqNullSafe(faulty["tw_key"]), "left_semi").select(columns)
        x, y = own(original), own(split)
        counted = lambda rows, what: rows.groupBy(key).agg(F.count("*").alias("rows")).select(key, F.lit(what).alias("problem"), "rows")
        out += [counted(x.exceptAll(y), "missing row"), counted(y.exceptAll(x), "extra row")]
    return union_all(out)


def null_keys(rows: DataFrame, key: str, part: Column) -> DataFrame:
    """part (a file or partition), its rows and its rows without a key; only parts that have some."""
    return rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys")).where("null_keys > 0")


def unfinished(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys of wanted (one row a slice) for which done does not have as many rows yet."""
    have = done.groupBy(key).agg(F.count("*").alias("have"))
    need = wanted.groupBy(key).agg(F.count("*").alias("need"))
    return need.join(have, key, "left").where(F.coalesce("have", F.lit(0)) < F.col("need")).select(key)
