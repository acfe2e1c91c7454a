"""Near-duplicate embeddings by a subspace pigeonhole join.

Two vectors of cosine t or more are, as unit vectors, at a squared distance of 2 - 2 t or less. Unit vectors are rotated
(signs and Hadamard transforms, which keep distances) and split into blocks of DIMS dimensions. If in every block
two vectors were further apart than the block's share of that distance, in proportion to its dimensions, the shares
would not add up; so each linked pair is within its share in some block. Each block is a range join: a grid over
its first dimensions, each vector at home in one cell and copied to the smaller cells that its share's radius
reaches. In a cell, vectors within the block's share are candidates, and candidates are compared by their cosine in
double precision over the given components. A pair found in several blocks counts in the first one.

Equal vectors are one class and are compared once; a class weighs as many rows as it has. Cells of more than HELD
vectors at home are split: a share of them is held by each task, and the others are run past it. What leaves a cell
are counts and a tree for each group found there, never all pairs. Sums are folded in a fixed order, so that all tasks
agree on every distance.

Vectors that are null, zero, empty, or hold null or non-finite components link with nothing and are components of their
own. Shorter vectors count as ending in zeros. Rows of equal or null ids are vectors of their own, equal ones, too;
a component's id is its smallest non-null id. Empty tables give no rows; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import spread_join, tasks, written
from tidewheel.llm.simhash import roots

THRESHOLD, DIMS, ROUNDS = 0.95, 8, 3
#: A cell's side, in radii; grid dimensions at most; components of the vectors that a task holds of a cell.
SIDE, GRID, HELD_VALUES = 3.0, 5, 1 << 20
_PAIRS, _ROWS, _LINKS, _SLACK = 1 << 20, 2048, 1 << 20, 1e-9


def folded(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, whose length is a power of two, always in the same order."""
    while x.shape[-1] > 1:
        half = x.shape[-1] // 2
        x = x[..., :half] + x[..., half:]
    return x[..., 0]


class Space:
    """Unit vectors, their rotation, and the blocks of one width."""

    def __init__(self, width: int, threshold: float = THRESHOLD, dims: int = DIMS):
        self.width = 1 << max(0, width - 1).bit_length()  # filled up with zeros
        self.dims = min(dims, self.width)
        self.blocks = self.width // self.dims
        self.threshold = threshold
        self.budget = (2 - 2 * threshold + _SLACK) * self.dims / self.width
        self.radius = math.sqrt(self.budget) * (1 + _SLACK)
        self.side = SIDE * self.radius
        self.signs = np.random.default_rng(12).choice([-1.0, 1.0], (ROUNDS, self.width))
        self.held = max(256, HELD_VALUES // self.width)

    def matrix(self, column: pa.Array) -> np.ndarray:
        """A list column as rows of this width, each scaled by a power of two so that squares neither vanish nor overflow."""
        sizes = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(column), self.width))
        out[np.arange(self.width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
        return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1, initial=0))[1][:, None])

    def rotated(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(norms, rotated unit vectors)."""
        norms = np.sqrt(folded(rows * rows))
        x = rows / norms[:, None]
        for signs in self.signs:
            x, half = x * signs, 1
            while half < self.width:  # one butterfly step of the Hadamard transform at a time
                x = x.reshape(len(rows), -1, 2, half)
                x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(rows), -1)
                half *= 2
            x /= math.sqrt(self.width)
        return norms, x

    def block(self, x: np.ndarray, k: int) -> np.ndarray:
        return x[:, k * self.dims : (k + 1) * self.dims]

    def cells(self, x: np.ndarray, k: int, grid: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(row numbers, cells, at home?): the cells of block k that each row belongs to."""
        at = self.block(x, k)[:, :grid] / self.side
        home = np.floor(at).astype(np.int64)
        low, high, reach = (at - home) * self.side <= self.radius, (1 + home - at) * self.side <= self.radius, (-1, 0, 1)
        code = lambda c: ((c + 512) << (10 * np.arange(grid))).sum(axis=1)
        yield np.arange(len(x)), code(home), True
        for step in product(reach, repeat=grid):
            if step < (0,) * grid:
                near = np.ones(len(x), bool)
                for d, s in enumerate(step):
                    if s:
                        near &= (low if s < 0 else high)[:, d]
                rows = np.flatnonzero(near)
                if len(rows):
                    yield rows, code(home[rows] + np.array(step)), False


def _deal(space: Space, grid: int, full: bool):
    """Classes (c, n, v) -> a row for each block and cell they belong to; full: with the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                _, x = space.rotated(space.matrix(part.column(2)))
                for k in range(space.blocks):
                    rows, cells, home = zip(*((r, c, np.full(len(r), h)) for r, c, h in space.cells(x, k, grid)))
                    rows = np.concatenate(rows)
                    columns = [pa.array(np.full(len(rows), k, np.int32)), pa.array(np.concatenate(cells)), pa.array(np.concatenate(home))]
                    names = ["block", "cell", "home"]
                    if full:
                        columns, names = [*columns, *(part.column(i).take(pa.array(rows)) for i in range(3))], [*names, "c", "n", "v"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


class _Side:
    """Some vectors of a cell."""

    def __init__(self, space: Space, c: np.ndarray, n: np.ndarray, rows: np.ndarray):
        self.c, self.n, self.rows = c, n, rows
        self.norms, self.x = space.rotated(rows)

    def joined(self, other: _Side) -> _Side:
        out = object.__new__(_Side)
        for name in ("c", "n", "rows", "norms", "x"):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(other, name)]))
        return out


def _links(space: Space, k: int, one: _Side, two: _Side, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of one, row of two) that link and are first within their share in block k; within: two ends one, and pairs of it count once."""
    # squared distances as one product of single precision, with room for its rounding; what passes is compared in double
    a, b = space.block(one.x, k), space.block(two.x, k)
    ones = lambda x: np.ones((len(x), 1))
    left = np.concatenate([-2 * a, (a * a).sum(axis=1)[:, None], ones(a)], axis=1).astype(np.float32)
    right = np.concatenate([b, ones(b), (b * b).sum(axis=1)[:, None]], axis=1).astype(np.float32).T.copy()
    step, first, most = max(1, _PAIRS // max(1, len(b))), len(one.c) - len(two.c), np.float32(space.budget + 4e-6)
    for at in range(0, len(a), step):
        near = left[at : at + step] @ right <= most
        if within:
            near &= np.arange(at, at + len(near))[:, None] < first + np.arange(len(b))[None, :]
        i, j = np.nonzero(near)
        i += at
        for cut in range(0, len(i), _PAIRS // space.width):
            p, q = i[cut : cut + _PAIRS // space.width], j[cut : cut + _PAIRS // space.width]
            linked = folded(one.rows[p] * two.rows[q]) / (one.norms[p] * two.norms[q]) >= space.threshold
            p, q = p[linked], q[linked]
            apart = folded(((one.x[p] - two.x[q]) ** 2).reshape(len(p), space.blocks, space.dims)) <= space.budget
            apart[:, -1] |= ~apart.any(axis=1)  # a pair on the edge of all shares
            mine = apart.argmax(axis=1) == k
            yield p[mine], q[mine]


def trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, label): the smallest node of each group that the links make."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _compare(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (block, cell, salt, others last) -> (c, links found, a smaller c of its group or itself)."""
        now, held, found, n = None, None, [], 0

        def flush():
            nonlocal found, n
            a, b, more_a, more_b = (np.concatenate(x) for x in zip(*found))
            found, n = [], 0
            nodes, label = trees(a, b)
            links = np.zeros(len(nodes), np.int64)
            np.add.at(links, np.searchsorted(nodes, a), more_a)
            np.add.at(links, np.searchsorted(nodes, b), more_b)
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), pa.array(label)], ["c", "links", "label"])

        for batch in batches:
            block, cell, salt, rank, c, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            change = (np.diff(block) != 0) | (np.diff(cell) != 0) | (np.diff(salt) != 0) | (np.diff(rank) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(cell)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                unit = (block[start], cell[start], salt[start])
                if unit != now:
                    now, held = unit, None
                for lo in range(start, end, _ROWS):
                    hi = min(end, lo + _ROWS)
                    new = _Side(space, c[lo:hi], weight[lo:hi], space.matrix(batch.column(6).slice(lo, hi - lo)))
                    if rank[start] == 0:
                        held = new if held is None else held.joined(new)
                    if held is None:
                        continue
                    for p, q in _links(space, int(block[start]), held, new, rank[start] == 0):
                        if len(p):
                            found.append((held.c[p], new.c[q], new.n[q], held.n[p]))
                            n += len(p)
                        if n >= _LINKS:
                            yield flush()
        if n:
            yield flush()

    return run


def _found(classes: DataFrame, width: int, threshold: float, dims: int) -> DataFrame:
    """(c, links, label) of the classes (c, n, v): what each cell has found."""
    spark, space = classes.sparkSession, Space(width, threshold, dims)
    grid = min(GRID, space.dims, max(1, math.ceil(math.log(max(1, classes.count() / space.held)) / math.log(2.2))))
    homes = classes.mapInArrow(_deal(space, grid, False), "block int, cell long, home boolean").where("home")
    crowded = written(homes.groupBy("block", "cell").agg(F.count("*").alias("size")).where(F.col("size") > space.held), "crowded")
    kind = classes.schema["v"].dataType.simpleString()
    spread = classes.mapInArrow(_deal(space, grid, True), f"block int, cell long, home boolean, c long, n long, v {kind}")
    rank, columns = F.when(F.col("home"), 0).otherwise(1), ("c", "n", "v")
    if many := crowded.count():
        # a task holds one salt's share; the other salts' that come after it, and the copies, are run past it
        sizes = F.broadcast(crowded) if many < 1_000_000 else crowded
        spread = spread.join(sizes, ["block", "cell"], "left").withColumn("salts", F.coalesce(F.ceil(F.col("size") / space.held), F.lit(1)).cast("int"))
        spread = spread.withColumn("own", F.when(F.col("home"), F.pmod(F.xxhash64("c"), F.col("salts")).cast("int")).otherwise(F.col("salts") - 1))
        spread = spread.select("block", "cell", F.explode(F.sequence(F.lit(0), "own")).alias("salt"), "home", "own", *columns)
        dealt = spread.select("block", "cell", "salt", F.when(F.col("home") & (F.col("salt") == F.col("own")), 0).otherwise(1).alias("rank"), *columns)
    else:
        dealt = spread.select("block", "cell", F.lit(0).alias("salt"), rank.alias("rank"), *columns)
    dealt = dealt.repartition(tasks(spark), "block", "cell", "salt").sortWithinPartitions("block", "cell", "salt", "rank")
    return dealt.mapInArrow(_compare(space), "c long, links long, label long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, dims: int = DIMS) -> DataFrame:
    """id, tw_links (other vectors of cosine threshold or more), tw_component (smallest id reachable) of every vector.

    threshold: above 0; dims: of a block, a power of two.
    """
    if not 0 < threshold <= 1 or dims & (dims - 1):
        raise ValueError("threshold is above 0 and 1 at most; dims is a power of two")
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.coalesce(F.col(vector_col).isNotNull() & ~bad & F.exists(vector_col, lambda x: x != 0), F.lit(False))
    rows = written(vectors.select(F.col(id_col).alias("id"), F.when(whole, F.col(vector_col)).alias("v"), F.xxhash64(vector_col).alias("key"), F.xxhash64(F.lit(12), vector_col).alias("more")), "vectors")
    valid = rows.where("v is not null")
    same = valid.groupBy("key", "more").agg(F.min("id").alias("low"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = written(same, "classes").withColumn("c", F.monotonically_increasing_id())  # of a written table, so it lasts
    width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    found = written(_found(classes.select("c", "n", "v"), width, threshold, dims), "found")
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    root = roots(found.select(F.col("c").alias("a"), F.col("label").alias("b")))
    known = classes.select("key", "more", "low", "n", "c").join(links, "c", "left").join(root.withColumnRenamed("node", "c"), "c", "left")
    known = written(known.select("key", "more", "low", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "c").alias("root")), "known")
    component = written(known.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("n")), "components")
    named = written(spread_join(known.drop("low", "n"), component.drop("n"), "root", component), "named")
    joined = spread_join(valid.select("id", "key", F.col("more").alias("own")), named.drop("root"), "key", known.groupBy("key").agg(F.sum("n").alias("n")))
    linked = joined.where("own = more").select("id", "links", "component")
    alone = rows.where("v is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("links").alias("tw_links"), F.col("component").alias("tw_component"))
