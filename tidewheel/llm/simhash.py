"""SimHash near-dedup by anchor-point covering.

A text's words are runs of non-white-space after lower-casing A-Z; its shingles are each SHINGLE consecutive
words joined by a space, repeats included (all words if fewer). A fingerprint bit is set if it is set in more
than half of the shingles' XXH64 values (seed 42). Fingerprints link at THRESHOLD or fewer differing bits.

Of two linked fingerprints one 32-bit half differs in at most one bit. On 31 bits of each half the anchors are
the words of the [31, 26] Hamming code, which cover every point within one bit: each fingerprint has one own
anchor there, and is copied to every anchor within 1 + 1 bits (16 at most), so linked fingerprints meet at the
own anchor of either. Anchors are worked through one by one; what leaves an anchor is a star per group found
there, never all pairs. Components come from these by alternating large and small stars.

Texts without words (null and empty ones, too) have fingerprint zero, linked like any other. Rows with equal
or null ids are documents of their own, and so are equal rows; a component's id is its smallest non-null document
id, or null. Empty tables give empty results; texts of any length are read whole; other columns play no part.

Results go back to documents by fingerprint, and to fingerprints by root. A fingerprint of very many documents
(that of empty texts, say) and a component of very many fingerprints are joined by broadcast (spread_join).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import byte_rows, only, spread_join, tasks, written

SHINGLE, THRESHOLD, SEED = 3, 3, 42
#: Own fingerprints of an anchor held by one task; an anchor with more is split into salts.
HELD = 50_000
_PAIR_ROWS = 1 << 22


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, counts, digest = len(words) - size + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        spans = zip(starts[at:to].tolist(), ends[at + size - 1 : to + size - 1].tolist())
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, to - at)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("simhash")
        for batch in batches:
            prints = np.fromiter((fingerprint(t, shingle) for t in byte_rows(batch.column(2))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["id", "row", "print"])

    return run


# --- anchors ----------------------------------------------------------------------------------------


def _flips() -> np.ndarray:
    """By syndrome: the masks of weight 2 or less that lead to a code word; the first leads to the nearest."""
    out = np.zeros((32, 16), np.int64)
    for s in range(1, 32):
        pairs = [(1 << a - 1) | (1 << (a ^ s) - 1) for a in range(1, 32) if a < a ^ s]
        out[s] = [1 << s - 1, *pairs]
    return out


FLIPS = _flips()


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, fingerprint number, own) for each anchor that each fingerprint is copied to."""
    parts = []
    for half in (0, 1):
        x = ((prints.view(np.uint64) >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
        syndrome = np.zeros(len(x), np.int64)
        for bit in range(31):
            syndrome ^= ((x >> bit) & 1) * (bit + 1)
        exact = np.flatnonzero(syndrome == 0)  # a code word itself: no other is within 2
        rest = np.flatnonzero(syndrome)
        spread = (x[rest][:, None] ^ FLIPS[syndrome[rest]]).ravel()
        own = np.zeros((len(rest), 16), bool)
        own[:, 0] = True
        parts.append((np.concatenate([x[exact], spread]) | (half << 31), np.concatenate([exact, np.repeat(rest, 16)]), np.concatenate([np.ones(len(exact), bool), own.ravel()])))
    anchor, at, own = (np.concatenate(x) for x in zip(*parts))
    return anchor, at, own


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        anchor, at, own = anchors(prints)
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(prints[at]), pa.array(own)], ["anchor", "print", "own"])


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def stars(held: np.ndarray, others: np.ndarray, threshold: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Star edges of the groups that held fingerprints make with each other and with others.

    Breadth first: a fingerprint that has joined a group isn't compared again, so a dense group of n costs
    a few passes over it, not n.
    """
    points = np.concatenate([held, others])
    free = np.arange(len(points))  # not yet in a group
    out, k = [], len(held)
    while len(free) and free[0] < k:
        root, edge = free[0], free[:1]
        free, group = free[1:], []
        while len(edge) and len(free):
            found = np.zeros(len(free), bool)
            step = max(1, _PAIR_ROWS // len(free))
            for at in range(0, len(edge), step):
                own = edge[at : at + step]
                near = _bits(points[own][:, None] ^ points[free][None, :]) <= threshold
                near[own >= k] &= free < k  # pairs of two others meet at another anchor
                found |= near.any(axis=0)
            edge, free = free[found], free[~found]
            group.append(edge)
        own = np.concatenate([[root], *group]).astype(np.int64)
        if len(own) > 1:
            values = points[own]
            low = values.min()
            out.append((np.full(len(own) - 1, low), np.delete(values, int(values.argmin()))))
    return out


def _small(anchor: np.ndarray, prints: np.ndarray, threshold: int, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """All links in runs of up to lags + 1 equal anchors, without a loop over anchors."""
    a, b = [], []
    for lag in range(1, lags + 1):
        near = np.flatnonzero((anchor[lag:] == anchor[:-lag]) & (_bits(prints[lag:] ^ prints[:-lag]) <= threshold))
        a.append(prints[near])
        b.append(prints[near + lag])
    return np.concatenate(a), np.concatenate(b)


def _compare(threshold: int, lags: int = 4):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (anchor, salt, own first) -> links. Holds one anchor's own fingerprints and a batch."""
        now, held, linked = None, np.zeros(0, np.int64), []

        def flush():
            if not linked:
                return
            a, b = (np.concatenate(x) for x in zip(*linked))
            linked.clear()
            low, high = np.minimum(a, b), np.maximum(a, b)
            one = np.unique(np.stack([low, high])[:, low != high], axis=1)
            if one.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(one[0]), pa.array(one[1])], ["a", "b"])

        for batch in batches:
            anchor, salt, rank, prints = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            anchor = anchor * 65_536 + salt
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1, [len(anchor)]])
            sizes = np.diff(cuts)
            whole = np.ones(len(sizes), bool)  # the first and last run may go on in other batches
            whole[[0, -1]] = False
            short = np.repeat(whole & (sizes <= lags + 1), sizes)
            linked.append(_small(anchor[short], prints[short], threshold, lags))
            for i in np.flatnonzero(~(whole & (sizes <= lags + 1))).tolist():
                a, b = int(cuts[i]), int(cuts[i + 1])
                if anchor[a] != now:
                    now, held = anchor[a], np.zeros(0, np.int64)
                own = prints[a:b][rank[a:b] == 0]
                held = np.concatenate([held, own])
                if len(held):
                    linked.extend(stars(held, prints[a:b][rank[a:b] == 1], threshold))
            yield from flush()

    return run


# --- components -------------------------------------------------------------------------------------


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"), F.count("*").alias("n"))
    return spread_join(both, low.drop("n"), "a", low).where("b > a").select(F.col("low").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a < b."""
    low = edges.groupBy("b").agg(F.min("a").alias("low"), F.count("*").alias("n"))
    joined = spread_join(edges, low.drop("n"), "b", low)
    return joined.select(F.col("low").alias("a"), "b").unionByName(joined.select(F.col("low").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component; nodes without links have no row.

    Alternating large and small stars: each round is a few joins over the links, and ends at a written table.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = written(edges.select(low.alias("a"), high.alias("b")).where("a <> b").distinct(), "links")
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    last = mark(now)
    while last[0]:
        now = written(_small_star(_large(now)), "links")
        found = mark(now)
        if found == last:
            break
        last = found
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) among distinct fingerprints that keep every component whole."""
    if threshold > 3:
        raise ValueError("the code covers thresholds up to 3")
    spark = prints.sparkSession
    spread = prints.select("print").mapInArrow(_anchors, "anchor long, print long, own boolean")
    crowded = written(spread.where("own").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HELD), "crowded")
    salt = F.pmod(F.xxhash64("print"), F.col("salts"))
    if crowded.count():
        spread = spread.join(crowded.select("anchor", F.ceil(F.col("n") / HELD).cast("int").alias("salts")), "anchor", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        # own ones go to one salt as held, and to all as the others they also are
        one = spread.where("own").select("anchor", salt.cast("int").alias("salt"), F.lit(0).alias("rank"), "print")
        split = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        all_ = spread.where("not own or salts > 1").select("anchor", split.alias("salt"), F.lit(1).alias("rank"), "print")
        dealt = one.unionByName(all_)
    else:
        dealt = spread.select("anchor", F.lit(0).alias("salt"), F.when(F.col("own"), 0).otherwise(1).alias("rank"), "print")
    dealt = dealt.repartition(tasks(spark), "anchor", "salt").sortWithinPartitions("anchor", "salt", "rank")
    return dealt.mapInArrow(_compare(threshold), "a long, b long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: id, tw_print (the fingerprint as a long), tw_component (smallest id reachable), and
    tw_root (a fingerprint that names the component also where ids are null or repeat) and tw_row (the text's hash)."""
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", narrow.schema["id"].dataType), T.StructField("row", T.LongType()), T.StructField("print", T.LongType())])
    prints = written(narrow.mapInArrow(_fingerprints(shingle), schema), "prints")
    classes = written(prints.groupBy("print").agg(F.min("id").alias("low"), F.count("*").alias("n")), "classes")
    root = roots(links(classes, threshold))
    known = written(classes.join(root, classes["print"] == root["node"], "left").select("print", "low", F.coalesce("root", "print").alias("root")), "rooted")
    component = written(known.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("n")), "components")
    named = written(spread_join(known, component.drop("n"), "root", component).select("print", "root", "component"), "named")
    found = spread_join(prints, named, "print", classes.select("print", "n"))
    return found.select(F.col("id").alias(id_col), F.col("print").alias("tw_print"), F.col("component").alias("tw_component"), F.col("root").alias("tw_root"), F.col("row").alias("tw_row"))
