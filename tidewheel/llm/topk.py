"""Exact top-k search by block-at-a-time pruning.

A term is a component of a vector and a sign; its maximum in a block is the largest (smallest) value of that
component there. Vectors are put in order by their strongest terms, so that near ones share a block, and cut
into document-range blocks of BLOCK; about GROUP vectors make a group, which one task holds as a forward index.
For each query the terms' maxima summed over a block bound every score in it; blocks are scored in falling
order of their bound until it is below the k-th score. A query is first run over its own group, and the k-th
score found there prunes the others: chunks of CHUNK queries meet the groups' maxima first, a row for each group, and only
queries whose bound reaches their floor are shipped to a group.

Vectors that are null, hold null or a non-finite component, or have no id take no part. Shorter vectors count
as ending in zeros. Every row is a candidate and, if it is a query, a query of its own, also where ids repeat: it
is compared with every row but itself, and of its own ranks. Ties go to the smaller id. Scores are exact integers;
vectors so large that a score may reach 2**62 are refused. Empty tables give no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import tasks, written

BLOCK, GROUP, CHUNK, STEP = 32, 16_384, 256, 8
#: Bytes of rows gathered at a time; groups whose bounds a task holds at a time.
GATHER, SPAN = 32 << 20, 4096
#: A score below all others.
NONE = -(1 << 62)


def upper(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The terms' maxima summed for each query and row of maxima: no score is higher there."""
    return (np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T).astype(np.int64)


class Group:
    """Vectors in order, with the maxima and minima of each block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.blocks = max(1, -(-len(ids) // BLOCK))
        self.ids = np.full(self.blocks * BLOCK, -1, np.int64)
        self.real = np.zeros(self.blocks * BLOCK, bool)
        self.ids[: len(ids)], self.real[: len(ids)] = ids, True
        self.rows = np.zeros((self.blocks * BLOCK, rows.shape[1]), rows.dtype)
        self.rows[: len(ids)] = rows
        if len(ids) and len(ids) < len(self.ids):
            self.rows[len(ids) :] = rows[-1]
        by_block = self.rows.reshape(self.blocks, BLOCK, -1)
        self.top, self.low = by_block.max(axis=1), by_block.min(axis=1)
        self.most = float(np.abs(self.rows).max(initial=0))
        self.doubles = self.rows.astype(np.float64) if self.most * self.most * self.rows.shape[1] < 2**53 else None

    def search(self, rows: np.ndarray, floors: np.ndarray, k: int, own_at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, id, score) of each query's k best here with at least its floor.

        own_at: where in this group each query's own row stands, which is left out.
        """
        least = NONE
        exact = np.abs(rows).max(initial=0) * self.most * rows.shape[1] < 2**53
        kind = np.float64 if exact else np.int64  # doubles add up such integers exactly
        q = rows.astype(kind)
        own = self.doubles if exact and self.doubles is not None else self.rows.astype(kind)
        bounds = upper(q, self.top.astype(kind), self.low.astype(kind))
        order = np.argsort(-bounds, axis=1, kind="stable")
        best, best_ids = np.full((len(q), k), least), np.full((len(q), k), np.iinfo(np.int64).max)
        live, within = np.arange(len(q)), np.arange(BLOCK)
        own_at = np.full(len(q), -1) if own_at is None else own_at
        for at in range(0, self.blocks, STEP):
            bar = np.maximum(floors[live], best[live, -1])
            live = live[bounds[live, order[live, at]] >= bar]
            if not len(live):
                break
            for own_live in np.array_split(live, min(len(live), max(1, -(-len(live) * STEP * BLOCK * q.shape[1] * 8 // GATHER)))):
                at_rows = (order[own_live, at : at + STEP, None] * BLOCK + within).reshape(len(own_live), -1)
                scores = (own[at_rows] @ q[own_live][:, :, None])[:, :, 0].astype(np.int64)
                found = self.ids[at_rows]
                scores[~self.real[at_rows] | (at_rows == own_at[own_live][:, None]) | (scores < floors[own_live][:, None])] = least
                scores, found = np.concatenate([best[own_live], scores], axis=1), np.concatenate([best_ids[own_live], found], axis=1)
                found[scores == least] = np.iinfo(np.int64).max
                pick = np.lexsort((found, -scores), axis=1)[:, :k]
                best[own_live], best_ids[own_live] = np.take_along_axis(scores, pick, 1), np.take_along_axis(found, pick, 1)
        which, col = np.nonzero(best != least)
        return which, best_ids[which, col], best[which, col]


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int64).tobytes()


def _ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


_ROWS = "kind int, part long, ids binary, data binary, floors binary, query long, query_id long, vec_id long, score long"


def _rows(kinds: list[int], **columns: list) -> pa.RecordBatch:
    types = {"part": pa.int64(), "ids": pa.binary(), "data": pa.binary(), "floors": pa.binary(), "query": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), *(pa.array(columns.get(c, [None] * len(kinds)), t) for c, t in types.items())], ["kind", *types])


def _groups(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order -> kind 0: a group; 3: its terms' maxima; 1: a chunk of its queries with their floors; 2: what they find in it.

        A query's number is its group's part and its place there, so rows of one id stay apart. ids of a chunk: pairs (id, number).
        """
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        n = 0

        def done():
            nonlocal made, n, held
            ids, rows, query = (np.concatenate(x) for x in zip(*held))
            part, made, held, n = task * 65_536 + made, made + 1, [], 0
            yield _rows([0], part=[part], ids=[_pack(ids)], data=[_pack(rows)])
            yield _rows([3], part=[part], data=[_pack(np.stack([rows.max(axis=0), rows.min(axis=0)]))])
            group, asked = Group(ids, rows), np.flatnonzero(query)
            for at in range(0, len(asked), CHUNK):
                own = asked[at : at + CHUNK]
                floors = np.full(len(own), NONE)
                found = group.search(rows[own], floors, k, own)
                number = part * GROUP * 2 + own
                full = np.bincount(found[0], minlength=len(own)) == k
                np.put(floors, np.flatnonzero(full), found[2].reshape(-1)[np.cumsum(np.bincount(found[0], minlength=len(own)))[full] - 1])
                yield _rows([1], part=[part], ids=[_pack(np.stack([ids[own], number], axis=1))], data=[_pack(rows[own])], floors=[_pack(floors)])
                which, vec, score = found
                yield _rows([2] * len(which), query=number[which].tolist(), query_id=ids[own][which].tolist(), vec_id=vec.tolist(), score=score.tolist())

        for batch in batches:
            vectors = batch.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            rows = np.zeros((batch.num_rows, width), np.int64)
            rows[np.arange(width)[None, :] < sizes[:, None]] = flat
            ids, query = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            for at in range(0, len(ids), GROUP):
                held.append((ids[at : at + GROUP], rows[at : at + GROUP], query[at : at + GROUP]))
                n += len(held[-1][0])
                if n >= GROUP:
                    yield from done()
        if held:
            yield from done()

    return run


_ASKED = "part long, own long, ids binary, data binary, floors binary"


def _ask(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (span, lane, bounds first): the maxima of the span's groups, then chunks -> for each group those of a chunk's
        queries whose bound there reaches their floor."""
        now, parts, bounds, stacked = None, [], [], None
        for batch in batches:
            span, kind, part, lane = (batch.column(c).to_pylist() for c in (0, 1, 2, 6))
            for i in range(batch.num_rows):
                if (span[i], lane[i]) != now:
                    now, parts, bounds, stacked = (span[i], lane[i]), [], [], None
                data = _ints(batch.column(4)[i].as_py()).reshape(-1, width)
                if kind[i] == 3:
                    parts.append(part[i])
                    bounds.append(data)
                    continue
                if not parts:
                    continue
                if stacked is None:
                    stacked = np.stack(bounds)
                floors, ids = _ints(batch.column(5)[i].as_py()), _ints(batch.column(3)[i].as_py()).reshape(-1, 2)
                most = float(np.abs(data).max(initial=0)) * float(np.abs(stacked).max(initial=0)) * width
                of = np.float64 if most < 2**53 else np.int64
                reach = upper(data.astype(of), stacked[:, 0].astype(of), stacked[:, 1].astype(of)) >= floors[:, None]
                for g in np.flatnonzero(reach.any(axis=0)).tolist():
                    if parts[g] != part[i]:
                        own = reach[:, g]
                        yield pa.RecordBatch.from_arrays([pa.array([parts[g]]), pa.array([part[i]]), *(pa.array([_pack(x[own])]) for x in (ids, data, floors))], ["part", "own", "ids", "data", "floors"])

    return run


def _search(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (part, kind): a group, then the queries that may find something in it."""
        now, group = None, None
        for batch in batches:
            part, kind = (batch.column(c).to_pylist() for c in range(2))
            for i in range(batch.num_rows):
                ids, data = _ints(batch.column(2)[i].as_py()), _ints(batch.column(3)[i].as_py()).reshape(-1, width)
                if kind[i] == 0:
                    now, group = part[i], Group(ids, data)
                    continue
                if part[i] != now:
                    raise RuntimeError("queries without their group")
                ids = ids.reshape(-1, 2)
                which, vec, score = group.search(data, _ints(batch.column(4)[i].as_py()), k)
                if len(which):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[which, 1]), pa.array(ids[which, 0]), pa.array(vec), pa.array(score)], ["query", "query_id", "vec_id", "score"])

    return run


def asked_of(made: DataFrame, width: int) -> DataFrame:
    """part, own, ids, data, floors: for each group the queries of other groups that may find something there. Chunks of queries
    meet the groups' maxima, a row for each group, SPAN of them at a time; groups are not shipped for that, nor queries to groups in vain."""
    bounds = made.where("kind = 3")
    spans, n = max(1, -(-bounds.count() // SPAN)), tasks(made.sparkSession)
    lanes = max(1, n // spans)  # a span's maxima go to each task that takes some of the chunks
    known = bounds.withColumn("span", F.pmod(F.xxhash64("part"), F.lit(spans)).cast("int")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    chunk = made.where("kind = 1").withColumn("lane", F.pmod(F.xxhash64("part", "ids"), F.lit(lanes)).cast("int"))
    chunk = chunk.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(spans - 1))))
    columns = ("span", "kind", "part", "ids", "data", "floors", "lane")
    dealt = known.select(*columns).unionByName(chunk.select(*columns)).repartition(n, "span", "lane").sortWithinPartitions("span", "lane", F.desc("kind"))
    return dealt.mapInArrow(_ask(width), _ASKED)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest inner products of floor(scale * x) with other rows.

    Queries of equal id have k rows each, under the one id.
    """
    spark = vectors.sparkSession
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(~bad)
    ints = whole.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    ints = written(ints, "vectors")
    size = lambda x: F.abs(x.cast("decimal(20,0)"))
    largest = F.max(F.aggregate("v", F.lit(0).cast("decimal(20,0)"), lambda s, x: F.greatest(s, size(x))))
    n, width, most = ints.agg(F.count("*"), F.max(F.size("v")), largest).first()
    width = max(1, width or 0)
    if int(most or 0) ** 2 * width >= 1 << 62:
        raise ValueError(f"scores may reach 2**62: {width} components of up to {most}")
    # the order: the three strongest components, with their signs
    strength = F.transform("v", lambda x, i: F.struct(F.abs(x).alias("size"), (i * 2 + F.when(x < 0, 1).otherwise(0)).alias("term")))
    strongest = F.transform(F.slice(F.sort_array(strength, asc=False), 1, 3), lambda x: x["term"])
    parts = max(1, min(tasks(spark), -(-n // 2048)), -(-n // GROUP))
    ordered = ints.withColumn("order", strongest).withColumn("row", F.monotonically_increasing_id())  # of a written table, so it lasts
    ordered = ordered.repartitionByRange(parts, "order", "id", "row").sortWithinPartitions("order", "id", "row").select("id", "v", "query")
    made = written(ordered.mapInArrow(_groups(width, k), _ROWS), "groups")
    asked = asked_of(made, width).select("part", F.lit(1).alias("kind"), "ids", "data", "floors")
    groups = made.where("kind = 0").select("part", F.lit(0).alias("kind"), "ids", "data", "floors")
    dealt = groups.unionByName(asked).repartition(max(parts, tasks(spark)), "part").sortWithinPartitions("part", "kind")
    others = dealt.mapInArrow(_search(width, k), "query long, query_id long, vec_id long, score long")
    all_ = made.where("kind = 2").select("query", "query_id", "vec_id", "score").unionByName(others)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return all_.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
