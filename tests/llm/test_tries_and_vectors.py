"""The prefix trie, near-duplicate vectors and whitening against brute force, and their defined results in edge cases."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from tidewheel.llm import oracles, prefix_trie, queries, vector_dedup, whitening
from tidewheel.llm.prefix_trie import SpillingQueue, rebuilt, turn_rows
from tidewheel.llm.vector_dedup import Space, near_vectors

TURNS = "conv_id long, turn long, role string, text string, conv long, x long, at long, n long, depth long"
VECTORS = "vec_id long, embedding array<float>, id long, c long, n long, v string, key long, links long"


# --- 11: prefix trie --------------------------------------------------------------------------------


def ordered(rows):
    """conv_id -> [(role, text)], as the contract orders turns."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in out.items()}


def rebuild(convs):
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
    trunc = lambda c: c - int(np.fmod(c, 100))
    return {c: [*convs.get(trunc(c), [])[: h[c]], *own[h[c] :]] for c, own in convs.items()}


def trie(convs):
    """conv, depth, parent's conv, members, children, leaves, saved, digest of each node, by brute force."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for key in sorted(nodes, key=len, reverse=True):
        below.setdefault(key, [])
        if key:
            below.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in below[key]) or 1
        saved[key] = sum(saved[k] for k in below[key]) + (len(nodes[key]) - 1) * (len(key[-1][1]) if key else 0)
    ends = lambda key: ",".join(map(str, sorted(c for c in nodes[key] if len(convs[c]) == len(key))))
    return sorted(
        (min(m), len(key), min(nodes[key[:-1]]) if key else None, len(m), len(below[key]), leaves[key], saved[key], hashlib.sha256(ends(key).encode()).hexdigest())
        for key, m in nodes.items()
    )


def found(df):
    return sorted(tuple(r) for r in df.collect())


def talk(seed=5):
    """Common beginnings, copies, prefixes of each other, repeated and tied turns, nulls, one long conversation, negative ids."""
    r = random.Random(seed)
    say = lambda: r.choice(["", "a", "é😀", "x" * 300, "hello there", None])
    rows = []
    for c in [*range(-120, -90), *range(0, 130), 250, 251, 377]:
        n = r.choice([1, 2, 2, 3, 5, 9])
        for t in range(n):
            rows.append((c, r.choice([t, t, None, 0]), r.choice(["user", "assistant", None]), say()))
    rows += [(c, t, "user", f"same {t}") for c in range(400, 440) for t in range(4)]
    rows += [(c, t, "user", "down") for c in range(500, 520) for t in range(c - 498)]
    rows += [(600, t, "user", f"long {t % 7}") for t in range(300)]
    rows += [(7, 1, "user", "twice"), (7, 1, "user", "twice"), (None, 1, "user", "nobody's"), (699, 5, "user", "tail only")]
    r.shuffle(rows)
    return [(*row, 1, 2, 3, 4, 5) for row in rows]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, TURNS).repartition(parts)


@pytest.mark.parametrize("options", [{}, {"block": 4, "top_nodes": 10**9, "held": 3}, {"block": 16, "held": 1}])
def test_trie_against_brute_force(spark, options):
    rows = talk()
    names = ("conv", "depth", "tw_parent", "tw_members", "tw_children", "tw_leaves", "tw_saved", "tw_ends")
    got = prefix_trie.prefix_trie(*rebuilt(turn_rows(frame(spark, rows))), **options)
    assert got.columns == list(names)
    want = trie(rebuild(ordered(rows)))
    assert found(got) == want
    assert any(row[3] == 1 and row[1] > 64 for row in want)  # a chain over many blocks


def test_shards_with_a_small_top(spark):
    """Only the root and the most common nodes are the top; chains of many blocks hang below common and rare nodes."""
    rows = [(c, t, "u", "a" if t < 30 else f"{c % 3}") for c in range(1, 400) for t in range(20 + c % 25)]
    got = prefix_trie.prefix_trie(*(lambda t: (t, t.select("conv").distinct()))(turn_rows(frame(spark, [(*r, 1, 2, 3, 4, 5) for r in rows]))), block=4, held=5)
    assert found(got) == trie(ordered(rows))


def test_trie_without_rebuilding_and_empty(spark):
    rows = talk(9)
    turns = turn_rows(frame(spark, rows))
    got = prefix_trie.prefix_trie(turns, turns.select("conv").distinct())
    assert found(got) == trie(ordered(rows))
    empty = turn_rows(frame(spark, []))
    assert prefix_trie.prefix_trie(*rebuilt(empty)).count() == 0


def test_a_conversation_over_many_partitions_and_a_long_list_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 60)  # bytes of a piece, here; workers are forked with the module's own
    rows = [(1, t, "u", str(t % 5)) for t in range(4000)] + [(c, 0, "u", "0") for c in range(2, 3000)]
    turns = turn_rows(frame(spark, [(*r, 1, 2, 3, 4, 5) for r in rows], 7))
    got = {(r["conv"], r["depth"]): r for r in prefix_trie.prefix_trie(turns, turns.select("conv").distinct(), block=64).collect()}
    assert len(got) == 4001 and got[1, 0]["tw_members"] == 2999 and got[1, 4000]["tw_leaves"] == 1
    assert got[1, 1]["tw_ends"] == hashlib.sha256(",".join(map(str, range(2, 3000))).encode()).hexdigest()
    assert all(r["tw_children"] == 1 for (c, d), r in got.items() if d < 4000)


def test_pieces_of_a_list_of_ids():
    import pyarrow as pa

    rows = [(1, 1, c) for c in range(50)] + [(1, 2, 7)] + [(2, 0, c) for c in range(1000, 1100)]
    batches = lambda part: iter([pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*part[at : at + 9])], ["x", "y", "conv"]) for at in range(0, len(part), 9)])
    was, prefix_trie.CHUNK = prefix_trie.CHUNK, 200
    try:
        made = [r for part in (rows[:30], rows[30:120], rows[120:]) for b in prefix_trie._digest_runs(batches(part)) for r in b.to_pylist()]
    finally:
        prefix_trie.CHUNK = was
    out = {(r["x"], r["y"]): r["digest"] for r in made if r["digest"]}
    pieces = sorted(((r["x"], r["y"], r["at"], r["piece"]) for r in made if r["piece"] is not None))
    table = pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*pieces)], ["x", "y", "at", "piece"])
    out |= {(r["x"], r["y"]): r["digest"] for b in prefix_trie._digest_pieces(iter([table])) for r in b.to_pylist()}
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert out == {(1, 1): sha(range(50)), (1, 2): sha([7]), (2, 0): sha(range(1000, 1100))}


def test_spilling_queue():
    r, queue = random.Random(2), SpillingQueue(held=7)
    items = [(-r.randint(0, 5), r.randint(0, 3), r.randint(0, 3), n, 1) for n in range(200)]
    for item in items:
        queue.push(item)
    assert len(queue.runs) > 5
    keys = sorted({i[:3] for i in items})
    assert [i for k in keys for i in sorted(queue.take(k))] == sorted(items)
    assert not queue.heap and not queue.runs


def test_trie_sql(spark, tmp_path):
    """The SQL, too, on nulls, ties and repeated turns."""
    frame(spark, [row for row in talk() if row[0] != 600]).select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op11_prefix_trie(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    result = db.sql(oracles.ORACLES["op11_prefix_trie"])
    assert found(got.select(*sorted(got.columns))) == sorted(result.project(", ".join(sorted(result.columns))).fetchall())


# --- 12: near-duplicate vectors -----------------------------------------------------------------------


def close(vectors, threshold=0.95):
    """(n_links, component) of every row by brute force; rows are (id, vector)."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in vectors]
    width = max([len(v) for (_, v), k in zip(vectors, ok) if k], default=1)
    m = np.zeros((len(vectors), width))
    for i, (_, v) in enumerate(vectors):
        if ok[i]:
            m[i, : len(v)] = np.array(v, np.float32)
    norm = np.sqrt((m**2).sum(axis=1))
    near = np.array([[ok[i] and ok[j] and i != j and m[i] @ m[j] / (norm[i] * norm[j]) >= threshold for j in range(len(m))] for i in range(len(m))])
    label = np.arange(len(m))
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(m))])
        if (new == label).all():
            break
        label = new
    ids = [min((i for (i, _), k in zip(vectors, label) if k == label[n] and i is not None), default=None) for n in range(len(m))]
    return near.sum(axis=1), ids


def clustered(width=24, seed=4):
    r = np.random.default_rng(seed)
    rows = [r.standard_normal(width) for _ in range(150)]
    for spread in (0.02, 0.06, 0.1):
        centre = r.standard_normal(width)
        rows += [centre + spread * r.standard_normal(width) for _ in range(40)]
    rows += [rows[3]] * 30 + [rows[4] * 7.0] + [-rows[4]] + [np.eye(width)[k % width] for k in range(6)]
    chain = [np.cos(a) * np.eye(width)[0] + np.sin(a) * np.eye(width)[1] for a in np.arange(0, 1.5, 0.3)]  # cos 0.3 > 0.95
    rows = [list(map(float, np.array(v, np.float32))) for v in rows + chain]
    odd = [None, [], [0.0] * width, [1.0, None], [float("nan")] * width, [float("inf"), 1.0], [1.0], [1.0, 0.0], [1e-30] * width, [1e30] * width]
    out = [(i, v) for i, v in enumerate(rows + odd)]
    return [*out, (5, rows[6]), (None, rows[7]), (None, None), (9, rows[9])]


@pytest.mark.parametrize("width,held", [(24, 1 << 20), (24, 1), (3, 1 << 20), (1, 1 << 20)])
def test_vectors_against_brute_force(spark, monkeypatch, width, held):
    """held: all cells that are crowded (256 vectors) are split with 1."""
    rows = clustered(width) if width > 1 else [(i, [float(i % 5 - 2)]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 1, 2, 3, "v", 5, 6) for i, v in rows], VECTORS).repartition(4)
    got = sorted(near_vectors(df).collect(), key=str)
    links, low = close(rows)
    assert got == sorted([(i, n, c) for (i, _), n, c in zip(rows, links.tolist(), low)], key=str)


def test_crowded_cells_are_split(spark):
    """900 different near copies are at home in one cell of each block; 256 of them are held at a time."""
    r = np.random.default_rng(8)
    centre = r.standard_normal(16)
    rows = [(i, list(map(float, (centre + 0.22 * r.standard_normal(16)).astype(np.float32)))) for i in range(900)]
    m = np.array([v for _, v in rows])
    m /= np.sqrt((m**2).sum(axis=1))[:, None]
    want = ((m @ m.T >= 0.95).sum(axis=1) - 1).tolist()
    assert 0 < min(want) < max(want) < 899
    was, vector_dedup.HELD_VALUES = vector_dedup.HELD_VALUES, 1
    try:
        got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("vec_id").collect()
    finally:
        vector_dedup.HELD_VALUES = was
    assert [g["tw_links"] for g in got] == want and {g["tw_component"] for g in got} == {0}


def test_rotation_keeps_distances():
    r, space = np.random.default_rng(3), Space(50)
    rows = np.concatenate([r.standard_normal((40, 50)), np.zeros((40, 14))], axis=1)
    _, x = space.rotated(rows)
    unit = rows / np.sqrt((rows**2).sum(axis=1))[:, None]
    assert np.abs(x @ x.T - unit @ unit.T).max() < 1e-12
    assert all(np.array_equal(space.rotated(rows[k : k + 1])[1][0], x[k]) for k in range(40))  # the same alone as among others


def test_cells_meet_all_within_the_radius():
    r, space = np.random.default_rng(6), Space(16)
    _, x = space.rotated(r.standard_normal((300, 16)))
    for grid in (1, 2, 3):
        homes, at = {}, {}
        for rows, cells, home in space.cells(x, 1, grid):
            for row, cell in zip(rows.tolist(), cells.tolist()):
                at.setdefault(cell, []).append((row, home))
                if home:
                    homes[row] = cell
        pairs = [(min(a, b), max(a, b)) for own in at.values() for a, h in own for b, g in own if h and (a < b if g else True) and a != b]
        assert len(pairs) == len(set(pairs))  # each pair meets once
        b = space.block(x, 1)
        near = {(i, j) for i in range(300) for j in range(i + 1, 300) if ((b[i] - b[j]) ** 2).sum() <= space.budget}
        assert near and near <= set(pairs)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.integers(spark.createDataFrame([], VECTORS))[0].count() == 0


# --- 13: whitening ------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["full", "rank 3", "equal eigenvalues", "identity", "zero", "graded"])
@pytest.mark.parametrize("n", [1, 2, 3, 40, 65])
def test_leading_vectors(kind, n):
    r = np.random.default_rng(n)
    q = np.linalg.qr(r.standard_normal((n, n)))[0]
    values = {"full": r.random(n) + 0.1, "rank 3": np.r_[np.ones(min(3, n)), np.zeros(n - min(3, n))], "equal eigenvalues": np.r_[np.full(n // 2, 5.0), np.ones(n - n // 2)], "identity": np.ones(n), "zero": np.zeros(n), "graded": 10.0 ** -np.arange(n)}[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    k = min(n, 32)
    e, v = whitening.leading_vectors(a, k)
    assert np.abs(e - np.sort(values)[::-1][:k]).max() < 1e-13
    assert np.abs(a @ v - v * e).max() < 1e-13 and np.abs(v.T @ v - np.eye(k)).max() < 1e-13


def whitened(spark, rows, components=32):
    x, width = whitening.integers(spark.createDataFrame([(i, v, 1, 2, 3, "v", 5, 6) for i, v in rows], VECTORS).repartition(3))
    model = whitening.fit(x, width, components)
    return model, whitening.identity_error(x, model), whitening.whiten(x, model).collect()


def test_whitening_against_numpy(spark):
    rows = [(i, v) for i, v in clustered(24) if v is None or len(v) == 24 and max(abs(x or 0) for x in v) < 1e3]
    rows += [(1, [1.0, None]), (2, [float("nan")] * 24), (3, [0.5])]
    model, error, got = whitened(spark, rows)
    ok = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    c = np.array([np.r_[np.array(v, np.float32), np.zeros(24 - len(v))] for _, v in ok], np.float64)
    x = np.floor(64 * c).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    assert model.n == n and model.sums.tolist() == s.tolist() and error < 1e-10
    d = (x * n - s) / n
    e, v = np.linalg.eigh(d.T @ d / n)
    assert np.abs(model.explained - (e / e.sum())[::-1]).max() < 1e-13
    dev = sorted((i is None, i, int(t)) for (i, _), t in zip(ok, ((x * n - s) ** 2).sum(axis=1)))
    assert sorted((r["id"] is None, r["id"], int(r["tw_deviation"])) for r in got) == dev
    w = np.array([r["tw_white"] for r in got])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(24)).max() < 1e-10
    assert np.abs(np.abs(v[:, ::-1].T @ model.vectors) - np.eye(24)).max() < 1e-8


def test_whitening_without_variance(spark):
    model, error, got = whitened(spark, [(1, [1.0, 2.0, 3.0])] * 4)
    assert error == 0.0 and [(r["tw_deviation"], r["tw_white"]) for r in got] == [(0, [None] * 3)] * 4 and model.explained.tolist() == [0.0] * 3
    model, error, got = whitened(spark, [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0])])
    assert error < 1e-12 and sorted(abs(r["tw_white"][0]) for r in got) == pytest.approx([1.0, 1.0]) and all(r["tw_white"][1:] == [None, None] for r in got)
    assert whitened(spark, [(1, None), (2, [None])])[2] == [] == whitened(spark, [])[2] == whitened(spark, [(1, [])])[2]


def test_large_deviations_are_exact():
    x = np.array([[2**40, -(2**40)], [0, 3]], np.int64)
    s = np.array([2**41, 5], np.int64)
    assert [int(v) for v in whitening._deviations(x, 1000, s).to_pylist()] == [sum((1000 * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]


def test_entries_too_large_are_refused(spark):
    with pytest.raises(ValueError):
        whitening.integers(spark.createDataFrame([(1, [1e30], 1, 1, 1, "", 1, 1)], VECTORS))


def test_vector_queries(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert queries.op13_whitening(spark, sf).count() == n * 32
    assert queries.op12_vector_dedup(spark, sf).columns == ["vec_id", "n_links", "component_id", "kept"]
