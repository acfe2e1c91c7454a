"""The trie of conversation prefixes, its subtree totals by time-forward processing.

A node stands for one distinct sequence of first d turns (role, text), whose conversations are its members. Turns
become pairs of 60-bit hashes (of MD5) and prefixes polynomials of these modulo 2**61 - 1, taken over range partitions in
order; a conversation that goes on in the next partition is continued by the state at the end of this one, so one of
any length is dealt to many tasks. Texts are not shuffled, save to put turns of equal number in order.

Totals are passed from nodes to parents in reverse level order. The root and nodes of more than `limit` members (a
hundred thousand at most, as limit grows with the table) are the top of the trie; what hangs below them, cut every BLOCK levels,
are shards, of limit members at most. A task sorts its shards' nodes by falling depth (Spark's sort, which spills) and sends each
node's total to its parent through a priority queue that spills sorted runs to the task's own temporary files. What shard
roots send on is added up by receiver; then the same is done across shard roots and the top, and shards that have
received from deeper ones (conversations of more than BLOCK turns) are run once more with what has come in.

Turns are ordered by number, null first, then by role and text; null role and text are empty. Rows that are equal in
all of these are turns of their own. Rows without a conversation id take no part. An empty table has no nodes, not even a
root. Texts of any length are hashed whole; other columns play no part.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import tasks, written

PRIME, BASES = (1 << 61) - 1, (1_111_368_193_706_523_849, 907_653_218_844_377_003)
#: Levels of a shard; nodes of the top at most (about); messages in memory; bytes of a list of ids.
BLOCK, TOP, HELD, CHUNK = 1 << 16, 100_000, 200_000, 1 << 20


# --- turns ----------------------------------------------------------------------------------------


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, one, two, chars): a row for each turn; role and text only where turn numbers repeat."""
    plain = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    hashed = [half(1).alias("one"), half(16).alias("two"), F.length("text").cast("long").alias("chars")]
    tied = written(plain.groupBy("conv", "turn").count().where("count > 1").select(F.col("conv").alias("c"), F.col("turn").alias("t")), "tied")
    bare = [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    if tied.isEmpty():
        return plain.select("conv", "turn", *bare, *hashed)
    joined = plain.join(tied, F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    own = [F.when(F.col("c").isNotNull(), F.col(c)).alias(c) for c in ("role", "text")]
    return joined.select("conv", "turn", *own, *hashed)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> their places and prefixes, counted from the conversation's first turn in this partition."""
    part, now, at, x, y = TaskContext.get().partitionId(), None, 0, 0, 0
    b, c = BASES
    for batch in batches:
        out: list[tuple[int, ...]] = []
        for conv, one, two in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if conv != now:
                now, at, x, y = conv, 0, 0, 0
            px, py, at = x, y, at + 1
            x, y = (x * b + one + 1) % PRIME, (y * c + two + 1) % PRIME
            out.append((at, x, y, px, py))
        columns = zip(*out) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(out), pa.int32()), *(batch.column(k) for k in range(4)), *(pa.array(v, pa.int64()) for v in columns)], ["part", "conv", "one", "two", "chars", "at", "x", "y", "px", "py"])


def _carried(ends: list) -> dict[int, tuple[int, int, int, int]]:
    """By partition: (conversation, turns, prefix) of what its first conversation has in the partitions before it."""
    out, state = {}, None
    for part, first, last, at, x, y in sorted(ends):
        if state and state[0] == first:
            out[part] = state
            if last == first:
                at, x, y = state[1] + at, (state[2] * pow(BASES[0], at, PRIME) + x) % PRIME, (state[3] * pow(BASES[1], at, PRIME) + y) % PRIME
        state = (last, at, x, y)
    return out


def _resume(carried: dict[int, tuple[int, int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [c.to_pylist() for c in batch.columns]
            part, conv, _, _, _, at, x, y, px, py = rows
            for i in range(batch.num_rows):
                state = carried.get(part[i])
                if state and state[0] == conv[i]:
                    _, n, u, v = state
                    b, c = (pow(base, at[i] - 1, PRIME) for base in BASES)
                    px[i], py[i] = (u * b + px[i]) % PRIME, (v * c + py[i]) % PRIME
                    x[i], y[i] = (u * b * BASES[0] + x[i]) % PRIME, (v * c * BASES[1] + y[i]) % PRIME
                    at[i] += n
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, batch.schema.types)], batch.schema.names)

    return run


def numbered(turns: DataFrame) -> DataFrame:
    """(conv, one, two, chars, at, x, y, px, py): each turn's place from 1, the prefix that it ends, and the one before it."""
    order = ("conv", "turn", "role", "text")
    dealt = turns.repartitionByRange(tasks(turns.sparkSession), *order).sortWithinPartitions(*order).select("conv", "one", "two", "chars")
    schema = "part int, conv long, one long, two long, chars long, at long, x long, y long, px long, py long"
    local = written(dealt.mapInArrow(_scan, schema), "scanned")
    last = F.struct("conv", "at")
    edges = local.groupBy("part").agg(F.min("conv"), F.max("conv"), F.max_by("at", last), F.max_by("x", last), F.max_by("y", last))
    carried = _carried([tuple(r) for r in edges.collect()])  # a row for each task
    return (written(local.mapInArrow(_resume(carried), schema), "placed") if carried else local).drop("part")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): conversation c begins with the first crc32(c) % 6 turns of conversation c - c % 100, then has its own after as many."""
    placed = numbered(turns)
    members = written(placed.groupBy("conv").agg((F.crc32(F.col("conv").cast("string")) % 6).alias("h")), "members")
    heads = placed.where("at <= 5").select(F.col("conv").alias("base"), "at", "one", "two", "chars")
    lent = members.where("h > 0").select("conv", "h", (F.col("conv") - F.col("conv") % 100).alias("base")).join(heads, "base").where("at <= h")
    own = placed.where(F.col("at") > F.crc32(F.col("conv").cast("string")) % 6)
    none = [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    columns = ("conv", F.col("at").alias("turn"), *none, "one", "two", "chars")
    return lent.select(*columns).unionByName(own.select(*columns)), members.select("conv")


# --- time-forward processing ----------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples: HELD of them in memory, the rest in sorted runs in the task's own temporary files."""

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.runs = held, [], []

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.held:
            self._spill()
        heapq.heappush(self.heap, item)

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()  # gone with the task
        self.heap.sort()
        for at in range(0, len(self.heap), 4096):
            pickle.dump(self.heap[at : at + 4096], file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        run = self._read(file)
        heapq.heappush(self.runs, (next(run), len(self.runs), run))
        self.heap = []

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    block = pickle.load(file)
                except EOFError:
                    return
                yield from block

    def take(self, key: tuple) -> Iterator[tuple]:
        """Takes out all items that begin with key, the smallest there is."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] == key:
            item, number, run = self.runs[0]
            yield item
            following = next(run, None)
            heapq.heapreplace(self.runs, (following, number, run)) if following else heapq.heappop(self.runs)


#: Of a node or a message: kind (0 for a message), its own key, where its total goes (null: out of this pass), amounts.
_KEY, _TO, _SUMS = ("depth", "x", "y"), ("to_depth", "tx", "ty"), ("children", "leaves", "saved")
_REST = ("conv", "n", "px", "py", "sx", "sy")
_FIELDS = ("kind", *_KEY, *_TO, *_SUMS, *_REST)
_SCHEMA = ", ".join(f"{c} long" for c in _FIELDS)


def _forward(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of falling depth, then node, messages first -> the nodes with what they have received added."""
        queue, ticket = SpillingQueue(held), itertools.count()
        for batch in batches:
            kind, depth, x, y, to, tx, ty, children, leaves, saved = (batch.column(k).to_pylist() for k in range(10))
            keep = []
            for i in range(batch.num_rows):
                if not kind[i]:
                    queue.push((-depth[i], x[i], y[i], next(ticket), children[i], leaves[i], saved[i]))
                    continue
                for *_, c, l, s in queue.take((-depth[i], x[i], y[i])):
                    children[i] += c
                    leaves[i] += l
                    saved[i] += s
                keep.append(i)
                if to[i] is not None:
                    queue.push((-to[i], tx[i], ty[i], next(ticket), 1, leaves[i], saved[i]))
            sums = {"children": children, "leaves": leaves, "saved": saved}
            columns = [pa.array(sums[c], pa.int64()) if c in sums else batch.column(k) for k, c in enumerate(_FIELDS)]
            yield pa.RecordBatch.from_arrays(columns, list(_FIELDS)).take(pa.array(keep, pa.int64()))

    return run


def _order() -> list:
    return [F.desc("depth"), "x", "y", "kind"]


def _in_shards(rows: DataFrame, held: int) -> DataFrame:
    dealt = rows.select(*_FIELDS).repartition(tasks(rows.sparkSession), "sx", "sy").sortWithinPartitions(*_order())
    return dealt.mapInArrow(_forward(held), _SCHEMA)


def _nowhere() -> dict:
    return {c: F.lit(None).cast("long") for c in _TO}


def _messages(senders: DataFrame) -> DataFrame:
    """What senders pass on to the nodes (px, py) a level up, added up by receiver."""
    sums = senders.groupBy("px", "py").agg((F.min("depth") - 1).alias("depth"), F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    rest = {c: F.lit(None).cast("long") for c in ("conv", "n", "sx", "sy")}
    return sums.withColumns({"kind": F.lit(0).cast("long"), "x": F.col("px"), "y": F.col("py"), **_nowhere(), **rest}).select(*_FIELDS)


def _totals(nodes: DataFrame, placed: DataFrame, block: int, top_nodes: int, held: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with their totals, the top of the trie)."""
    limit = max(16, (nodes.agg(F.sum("n")).first()[0] or 0) // top_nodes)
    own = {
        "kind": F.lit(1).cast("long"), "children": F.lit(0).cast("long"), "leaves": (F.col("n") == F.col("ends")).cast("long"), "saved": (F.col("n") - 1) * F.col("chars"),
    }
    nodes = nodes.withColumns(own)
    at_top = (F.col("n") > limit) | (F.col("depth") == 0)
    top = written(nodes.where(at_top), "top")  # their members add up to all turns and conversations at most
    is_top = F.broadcast(top.select("x", "y"))
    span = F.floor(F.col("at") / block).cast("long")
    starts = placed.join(is_top, ["x", "y"], "left_anti").groupBy("conv", span.alias("span")).agg(F.min_by("x", "at").alias("sx"), F.min_by("y", "at").alias("sy"))
    low = nodes.where(~at_top).withColumn("span", F.floor(F.col("depth") / block).cast("long")).join(starts, ["conv", "span"])
    heads = (F.col("x") == F.col("sx")) & (F.col("y") == F.col("sy"))
    up = lambda there, depth, x, y: {"to_depth": F.when(there, depth), "tx": F.when(there, x), "ty": F.when(there, y)}
    low = written(low.withColumns(up(~heads, F.col("depth") - 1, F.col("px"), F.col("py"))).select(*_FIELDS), "low")
    within = written(_in_shards(low, held), "within")
    parent_is_top = F.broadcast(top.select(F.col("x").alias("px"), F.col("y").alias("py")))
    senders = within.where(heads)
    deep = written(senders.join(parent_is_top, ["px", "py"], "left_anti"), "deep")
    top = top.withColumns({"sx": F.col("x"), "sy": F.col("y"), **up(F.col("depth") > 0, F.col("depth") - 1, F.col("px"), F.col("py"))}).select(*_FIELDS)
    across = lambda rows: written(rows.repartition(1).sortWithinPartitions(*_order()).mapInArrow(_forward(held), _SCHEMA), "across")
    if deep.isEmpty():
        return within.unionByName(across(top.unionByName(_messages(senders.join(parent_is_top, ["px", "py"], "left_semi"))))), top
    # shards that send to or have received from another: their roots are nodes of the pass across
    place = within.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("sx").alias("rx"), F.col("sy").alias("ry"))
    root_depth = senders.select(F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("depth").alias("r_depth"))
    linked = written(deep.join(place, ["px", "py"]).join(root_depth, ["rx", "ry"]), "linked")
    fed = written(linked.select(F.col("rx").alias("sx"), F.col("ry").alias("sy")).distinct(), "fed")
    inner = linked.withColumns({"to_depth": F.col("r_depth"), "tx": F.col("rx"), "ty": F.col("ry")}).select(*_FIELDS)
    under_top = senders.join(parent_is_top, ["px", "py"], "left_semi")
    outer = under_top.join(fed, ["sx", "sy"], "left_semi").withColumns(up(F.lit(True), F.col("depth") - 1, F.col("px"), F.col("py"))).select(*_FIELDS)
    done = across(top.unionByName(inner).unionByName(outer).unionByName(_messages(under_top.join(fed, ["sx", "sy"], "left_anti"))))
    finals = done.join(deep.select("x", "y"), ["x", "y"], "left_semi").select(*_FIELDS)
    mail = _messages(finals).drop("sx", "sy").join(place.withColumnsRenamed({"rx": "sx", "ry": "sy"}), ["px", "py"]).select(*_FIELDS)
    again = _in_shards(low.join(fed, ["sx", "sy"], "left_semi").select(*_FIELDS).unionByName(mail), held)
    return within.join(fed, ["sx", "sy"], "left_anti").select(*_FIELDS).unionByName(again).unionByName(done.join(is_top, ["x", "y"], "left_semi").select(*_FIELDS)), top


# --- digests of members that end at a node --------------------------------------------------------


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, y, conv) in order -> a digest for each node, or pieces of the list where it may go on in another partition."""
    now, ids, size, first_node, pieces = None, [], 0, True, False
    out: list[tuple] = []

    def piece():
        nonlocal ids, size, pieces
        out.append((*now, ids[0], None, ",".join(map(str, ids)).encode()))
        ids, size, pieces = [], 0, True

    def close(last: bool):
        nonlocal ids, size
        if last or first_node or pieces:
            if ids:
                piece()
        else:
            out.append((*now, ids[0], hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), None))
        ids, size = [], 0

    def batch_of(rows):
        x, y, at, digest, text = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(at, pa.int64()), pa.array(digest, pa.string()), pa.array(text, pa.binary())], ["x", "y", "at", "digest", "piece"])

    for batch in batches:
        for x, y, conv in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (x, y) != now:
                if now is not None:
                    close(False)
                    first_node = False
                now, pieces = (x, y), False
            ids.append(conv)
            size += 20
            if size >= CHUNK:
                piece()
        if out:
            yield batch_of(out)
            out = []
    if now is not None:
        close(True)
    if out:
        yield batch_of(out)


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (x, y, at) -> digests; one piece is held at a time."""
    now, state = None, None
    made = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([state.hexdigest()])], ["x", "y", "digest"])
    for batch in batches:
        for k in range(batch.num_rows):
            key = (batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
            if key != now:
                if now is not None:
                    yield made()
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(batch.column(3)[k].as_py())
    if now is not None:
        yield made()


def digests(ends: DataFrame) -> DataFrame:
    """(x, y, digest): SHA-256 of the ids, rising and joined by commas, of the conversations that end at each node."""
    n = tasks(ends.sparkSession)
    dealt = ends.select("x", "y", "conv").repartitionByRange(n, "x", "y", "conv").sortWithinPartitions("x", "y", "conv")
    made = written(dealt.mapInArrow(_digest_runs, "x long, y long, at long, digest string, piece binary"), "digests")
    pieces = made.where("piece is not null").select("x", "y", "at", "piece").repartition(n, "x", "y").sortWithinPartitions("x", "y", "at")
    return made.where("digest is not null").select("x", "y", "digest").unionByName(pieces.mapInArrow(_digest_pieces, "x long, y long, digest string"))


# --- the operator ---------------------------------------------------------------------------------


def prefix_trie(turns: DataFrame, members: DataFrame, block: int = BLOCK, top_nodes: int = TOP, held: int = HELD) -> DataFrame:
    """A row for each node of the trie of turns (as turn_rows() gives them), whose conversations are members (conv), turnless ones, too.

    conv (the smallest member), depth, tw_parent (its parent's conv), tw_members, tw_children, tw_leaves, tw_saved,
    tw_ends (the digest of the ids that end there).
    """
    placed = numbered(turns)
    ends = placed.groupBy("conv").agg(F.max_by("x", "at").alias("x"), F.max_by("y", "at").alias("y"))
    zero = F.lit(0).cast("long")
    turnless = members.select("conv").join(ends.select("conv"), "conv", "left_anti").select("conv", zero.alias("x"), zero.alias("y"))
    ends = written(ends.unionByName(turnless), "ends")
    each = placed.select("x", "y", "conv", F.lit(1).cast("long").alias("n"), zero.alias("ends"), F.col("at").alias("depth"), "chars", "px", "py")
    last = ends.select("x", "y", *(F.lit(None).cast("long").alias(c) if c not in ("n", "ends") else F.lit(int(c == "ends")).cast("long").alias(c) for c in each.columns[2:]))
    root = members.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    root = root.select(zero.alias("x"), zero.alias("y"), "conv", "n", zero.alias("ends"), zero.alias("depth"), zero.alias("chars"), F.lit(-1).cast("long").alias("px"), F.lit(-1).cast("long").alias("py"))
    low = [F.min(c).alias(c) for c in ("conv", "depth", "chars", "px", "py")]
    nodes = written(each.unionByName(last).unionByName(root).groupBy("x", "y").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"), *low), "nodes")
    all_, top = _totals(nodes, placed, block, top_nodes, held)
    all_ = written(all_.drop("kind"), "totals")
    named = lambda df: df.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("tw_parent"))
    under_top = all_.join(F.broadcast(named(top)), ["px", "py"])
    # a node below the top has no more children than members, that is, limit
    others = all_.join(F.broadcast(named(top)), ["px", "py"], "left_anti")
    first = others.where("depth = 0").withColumn("tw_parent", F.lit(None).cast("long"))
    rest = others.where("depth > 0").join(named(nodes), ["px", "py"])
    both = under_top.unionByName(rest).unionByName(first)
    found = both.join(digests(ends), ["x", "y"], "left")
    return found.select(
        "conv", "depth", "tw_parent", F.col("n").alias("tw_members"), F.col("children").alias("tw_children"), F.col("leaves").alias("tw_leaves"),
        F.col("saved").alias("tw_saved"), F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("tw_ends"),
    )
