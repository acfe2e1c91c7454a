"""What the corpus operators share: the shared folder, written tables, Arrow buffers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables in the shared folder, in order.
_WRITTEN: list[str] = []
#: White space of the text contracts: the space and U+0009 to U+000D.
SPACE = b" \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or in local mode a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = context.getCheckpointDir()
        if not path:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewheel-"))
            path = context.getCheckpointDir()
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tw-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, so a lost executor costs one scan. cleanup() removes it."""
    path = new_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cleanup(since: int = 0) -> int:
    """Removes the tables that this process has written (from mark() on); call it when what reads them is done."""
    gone = _WRITTEN[since:]
    for path in gone:
        store, top = pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "", 1))
        store.delete_dir(top)
    del _WRITTEN[since:]
    return len(gone)


def mark() -> int:
    """How many tables have been written so far."""
    return len(_WRITTEN)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: What an operator's tasks keep in a worker for its next task: owner -> what drops it.
KEPT: dict[str, Callable[[], None]] = {}


def only(owner: str) -> None:
    """Drops what other operators' tasks have left in this worker, and gives the memory back to the system: a job of several
    operators needs that of one at a time."""
    for name, drop in KEPT.items():
        if name != owner:
            drop()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column without copying; null reads as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs, raw


def byte_rows(column: pa.Array) -> list[bytes]:
    """Each value's UTF-8 bytes; null reads as empty."""
    offs, raw = buffers(column)
    view = memoryview(raw)
    return [bytes(view[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]


def chunks(offs: np.ndarray, size: int = 1 << 20):
    """(first, last) row ranges of about size bytes, so that numpy work stays small whatever the batch holds."""
    first, n = 0, len(offs) - 1
    while first < n:
        last = int(np.searchsorted(offs, offs[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def repeat(column: pa.Array, counts: np.ndarray) -> pa.Array:
    """Each value counts[i] times over."""
    return column.take(pa.array(np.repeat(np.arange(len(counts)), counts)))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def no_clash(keep: tuple[str, ...], taken: tuple[str, ...], results: tuple[str, ...]) -> list[str]:
    """The columns to keep that aren't taken along anyway; none may be named as a result is."""
    names = {c.lower() for c in results}
    if own := [c for c in (*keep, *taken) if c.lower() in names]:
        raise ValueError(f"columns named as results are: {own}")
    return [c for c in dict.fromkeys(keep) if c not in taken]


def spread_join(many: DataFrame, one: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """many joined with one, which has a row for each key at most; counts: (key, n), rows of many by key.

    Keys with more than twice a task's even share of rows don't meet in a task: their rows of one are broadcast,
    fewer than half as many as there are tasks.
    """
    parts, total = tasks(many.sparkSession), counts.agg(F.sum("n")).first()[0] or 0
    heavy = [r[0] for r in counts.where(F.col("n") > max(1, 2 * total / parts)).select(key).collect()]
    if not heavy:
        return many.join(one, key)
    own = F.col(key).isin(heavy)
    return many.where(own).join(F.broadcast(one.where(own)), key).unionByName(many.where(~own).join(one.where(~own), key))
