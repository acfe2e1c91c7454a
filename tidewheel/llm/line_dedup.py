"""Line dedup: lines that many documents share, found by probing sharded minimal perfect hashes.

Every text is split at \\n. A line's key is the line stripped of white space and lower-cased (A-Z); its
identity is the key's 128-bit hash. The distinct hashes are dealt to shards by hash; each shard becomes
one minimal perfect hash with a fingerprint and a count array (a few bytes a line), and the documents'
line hashes run past the arrays of their shard. Lines are never joined with lines.

Null or empty text is one empty line, which is kept. Every row is a document, also when ids repeat or
are null: hits go back to a row by its id and its text's hash, so they never gather under one null id. Equal
rows have equal results. Empty tables give empty results. A line of any length is hashed whole. Columns of the
table that clash with names used inside play no part; those in keep must not be named as the results are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import SPACE, byte_rows, mix, no_clash, tasks, written

#: Distinct lines a shard holds on average; bounds a task's memory whatever the corpus.
SHARD_LINES = 65_536
#: Probes of a shard that go to one task; a shard with more, as one with a very common line has, is copied to more tasks.
PROBES = 4 * SHARD_LINES
#: The largest count a shard holds, and min_docs can be.
FULL = (1 << 32) - 1
#: Shards with more probes than PROBES up to which their numbers are broadcast.
BROADCAST_ROWS = 1_000_000


def key_of(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.int64).reshape(-1, 2)


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            counts = []
            for text in byte_rows(batch.column(2)):
                own = {k for k in map(key_of, text.split(b"\n")) if long_enough(k, min_chars)} if text else ()
                counts.append(len(own))
                keys.extend(own)
            h = _hashes(keys)
            of = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(h[:, 0]), pa.array(h[:, 1])], ["id", "row", "h1", "h2"])

    return run


# --- one shard: levels of bits, each key set where it is alone -------------------------------------


def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h1.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1) ^ h2.view(np.uint64)) % np.uint64(size)).astype(np.int64)


def build_shard(h1: np.ndarray, h2: np.ndarray, counts: np.ndarray) -> bytes:
    """A minimal perfect hash over the keys (h1, h2), with a 32-bit fingerprint and a count per slot."""
    left, sizes, bits = np.arange(len(h1)), [], []
    where = np.zeros(len(h1), np.int64)
    base = 0
    while len(left):
        size = max(64, -(-2 * len(left) // 64) * 64)
        at = _places(h1[left], h2[left], len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        own = np.zeros(size, bool)
        own[at[alone]] = True
        where[left[alone]] = base + at[alone]
        left, base = left[~alone], base + size
        sizes.append(size)
        bits.append(own)
    flags = np.concatenate(bits) if bits else np.zeros(0, bool)
    slot = (np.cumsum(flags) - 1)[where] if len(where) else where
    fingers, held = np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.uint32)
    fingers[slot] = h2.view(np.uint64).astype(np.uint32)
    held[slot] = np.minimum(counts, FULL)
    return struct.pack("<II", len(sizes), len(h1)) + np.array(sizes, np.uint32).tobytes() + np.packbits(flags).tobytes() + fingers.tobytes() + held.tobytes()


class Shard:
    """The arrays of one shard, ready to be probed."""

    def __init__(self, blob: bytes):
        levels, n = struct.unpack_from("<II", blob)
        self.sizes = np.frombuffer(blob, np.uint32, levels, 8).astype(np.int64)
        at, total = 8 + 4 * levels, int(self.sizes.sum())
        self.flags = np.unpackbits(np.frombuffer(blob, np.uint8, -(-total // 8), at))[:total].astype(bool)
        at += -(-total // 8)
        self.rank = np.cumsum(self.flags, dtype=np.int32) - 1
        self.fingers = np.frombuffer(blob, np.uint32, n, at)
        self.counts = np.frombuffer(blob, np.uint32, n, at + 4 * n)

    def count(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """How many documents have each key; 0 for a key whose fingerprint differs."""
        found, left, base = np.zeros(len(h1), np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = base + _places(h1[left], h2[left], level, size)
            hit = self.flags[at]
            slot, own = self.rank[at[hit]], left[hit]
            same = self.fingers[slot] == h2[own].view(np.uint64).astype(np.uint32)
            found[own[same]] = self.counts[slot[same]]
            left, base = left[~hit], base + size
        return found


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard -> one blob a shard."""
    shard, parts = None, []

    def done():
        h1, h2, n = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([build_shard(h1, h2, n)], pa.binary())], ["shard", "blob"])

    for batch in batches:
        ids, h1, h2, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if parts and ids[a] != shard:
                yield done()
                parts = []
            shard = int(ids[a])
            parts.append((h1[a:b], h2[a:b], n[a:b]))
    if parts:
        yield done()


def _probe(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (shard, salt), each shard's blob before its probes -> the probes that are common."""
        arrays: Shard | None = None
        for batch in batches:
            kind = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = [0, *np.flatnonzero(kind == 0).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and kind[a] == 0:
                    arrays = Shard(batch.column(7)[a].as_py())
                    a += 1
                if a >= b:
                    continue
                own = batch.slice(a, b - a)
                h1, h2 = (own.column(k).to_numpy(zero_copy_only=False) for k in (5, 6))
                hit = np.flatnonzero(arrays.count(h1, h2) >= min_docs)
                if len(hit):
                    yield pa.RecordBatch.from_arrays([own.column(3).take(pa.array(hit)), own.column(4).take(pa.array(hit)), pa.array(h1[hit]), pa.array(h2[hit])], ["id", "row", "h1", "h2"])

    return run


def common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(id, row, h1, h2): the hashes of each document's lines that min_docs documents or more have; row: the text's hash."""
    if min_docs > FULL:
        raise ValueError(f"min_docs is {FULL} at most")
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType
    out = T.StructType([T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in ("row", "h1", "h2"))])
    lines = written(narrow.mapInArrow(_line_hashes(min_chars), out), "lines")
    keys = written(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")), "line-keys")
    shards = max(1, -(-keys.count() // SHARD_LINES))
    shard = F.pmod(F.col("h1"), F.lit(shards)).alias("shard")
    parts = tasks(spark)
    blobs = keys.select(shard, "h1", "h2", "n").repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(_build, "shard long, blob binary")
    crowded = written(keys.groupBy(shard).agg(F.ceil(F.sum("n") / PROBES).cast("int").alias("salts")).where("salts > 1"), "crowded-shards")
    few = crowded.count() <= BROADCAST_ROWS
    salted = lambda df: df.join(F.broadcast(crowded) if few else crowded, "shard", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    nothing = lambda kind: F.lit(None).cast(kind)
    loads = salted(blobs).select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), nothing(kind).alias("id"), *(nothing("long").alias(c) for c in ("row", "h1", "h2")), "blob")
    probes = salted(lines.select(shard, "id", "row", "h1", "h2")).select("shard", F.pmod(F.xxhash64("id", "row"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"), "id", "row", "h1", "h2", nothing("binary").alias("blob"))
    dealt = loads.unionByName(probes).repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return dealt.mapInArrow(_probe(min_docs), out)


def _drop(schema: T.StructType, text_at: int):
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            hits = batch.column(batch.num_columns - 1).to_pylist()
            for text, own in zip(byte_rows(batch.column(text_at)), hits):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if own:
                    gone = {struct.pack("<qq", x["h1"], x["h2"]) for x in own}
                    stay = [x for x in lines if not (k := key_of(x)) or xxhash.xxh3_128_digest(k) not in gone]
                    n_dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                else:
                    n_dropped.append(0)
                    kept.append(text)
            text = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) if k != text_at else text for k in range(batch.num_columns - 1)), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names)

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns in keep, the text without its common lines, tw_lines (before) and tw_dropped.

    A key of min_chars code points or more, found in min_docs documents or more, loses all its lines
    everywhere, the first included; the others stay as they were, joined by \\n. Null text becomes "".
    """
    rest = no_clash(keep, (id_col, text_col), ("tw_lines", "tw_dropped"))
    hits = common_lines(docs, id_col, text_col, min_docs, min_chars).distinct().groupBy(F.col("id").alias("hit_id"), F.col("row").alias("hit_row")).agg(F.collect_list(F.struct("h1", "h2")).alias("hits"))
    own = [id_col, text_col, *rest]
    wide = docs.select(F.xxhash64(text_col).alias("row"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(own)))
    joined = wide.join(hits, F.col("c0").eqNullSafe(F.col("hit_id")) & (F.col("row") == F.col("hit_row")), "left").select(*(f"c{i}" for i in range(len(own))), "hits")
    out = T.StructType([*docs.select(*own).schema.fields, T.StructField("tw_lines", T.LongType()), T.StructField("tw_dropped", T.LongType())])
    return joined.mapInArrow(_drop(out, 1), out)
