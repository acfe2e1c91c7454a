"""Suffix-array dedup: removes bytes in strings of LENGTH bytes that start earlier in the corpus, too.

A string of LENGTH bytes holds LENGTH - GRAM + 1 grams; the one of the smallest hash (leftmost of equals) is its
anchor, so equal strings have equal anchors at the same place, and all of a string's bytes lie within LENGTH - GRAM of
it. A string holds the HALF bytes before its anchor or the HALF bytes after it. Strings of one anchor in a text start in
one run; those that hold the anchor with the bytes before it make one segment, the others another. Equal strings lie in
segments of equal core (the anchor with its HALF bytes), so segments meet by core:

1. Cores that occur once are let go: no string around them repeats. This filter loses nothing.
2. Of equal segments the earliest stands for all; the others are removed whole. This is done in every task before the
   shuffle, so that a very common passage arrives once a task, and again after it.
3. Where different segments share a core, the strings they share are found in a suffix structure: segments are dealt to
   shards of SHARD bytes, each shard's suffixes are sorted alone and its Burrows-Wheeler transform taken, and the
   transforms are merged by refining their interleave, without sorting suffixes of different shards against each
   other. A letter of these transforms is STEP bytes (the STEP bytes before a suffix), so a round of refinement settles
   STEP more bytes of common prefix, and LENGTH bytes take LENGTH / STEP rounds. A block of places that no round has
   split by then is a repeated interval: its common prefix is LENGTH or more. Bytes are compared before any is removed.
4. A core with more than CROWD different segments (the edge of a passage in very many documents) is not merged: its
   strings are taken one by one, by a 128-bit hash, over all tasks, with step 2's folding before the shuffle. Cores that
   may have more than HOT are found by a count before anything is dealt; their segments are never sent anywhere, only
   their strings, so no task gets a core's segments from all documents.

Matches are judged on the input and never cross documents. Null text is empty. An earlier start is one in a smaller
id, or before it in the same text; ids are whole numbers, null ids come first; rows of equal id go by their text's
hash, and rows equal in both are taken for one document, with equal results. Texts of any length are treated whole, in
pieces. Empty tables give empty results. Columns that clash with names used inside play no part; those in keep must
not be named as the results are.

Segments of one core are taken for equal if 64 bits of hash are: a core that n different segments share has a chance
of n**2 / 2**65 of one wrong fold (below 3 % for a core in a thousand million different surroundings).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import buffers, byte_rows, chunks, mix, no_clash, tasks, written

LENGTH, GRAM, STEP = 100, 24, 25
HALF = (LENGTH - GRAM) // 2
#: Bytes of text taken at once, text for each bucket of cores, and bytes of segments in a shard.
PIECE, BUCKET, SHARD = 1 << 20, 16 << 20, 64 << 10
#: Different segments of one core up to which they meet in one task.
CROWD = 500
#: Segments of one core, over all tasks, above which they don't meet at all.
HOT = 20_000
_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_LOW = (1 << 24) - 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS[base] = (out[0], out[1])
    return _POWERS[base]


def _sums(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """From these and the inverse powers any stretch's hash follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data) + 1, base)[0][: len(data)], out=sums[1:])
    return sums


#: A segment: the hash of its core, its own, its document (id, text hash), its first start, and how many starts follow.
RECORD = np.dtype([("core", "<u8"), ("segment", "<u8"), ("id", "<i8"), ("row", "<i8"), ("lo", "<u4"), ("more", "u1")])
_NO_ID = np.iinfo(np.int64).min


def find_segments(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Records of all segments of the strings that end by their text's end; lo is a place in data.

    ends: for each place in data, where the text it lies in ends.
    """
    n, width = len(data), LENGTH - GRAM + 1
    if n < LENGTH:
        return np.zeros(0, RECORD)
    down, sums = _powers(n + 1)[1], _sums(data)
    low, done = (mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1]) & ~np.uint64(_LOW)) | np.arange(n - GRAM + 1, dtype=np.uint64), 1
    while done < width:
        step = min(done, width - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    at = np.flatnonzero(np.arange(len(low)) + LENGTH <= ends[: len(low)])
    place = (low[at] & np.uint64(_LOW)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    lo, hi, place = at[first], at[np.append(first[1:], len(at)) - 1], place[first]
    out = []
    for side, own, a, b, from_ in ((1, lo <= place - HALF, lo, np.minimum(hi, place - HALF), place - HALF), (2, hi >= place - HALF, np.maximum(lo, place - HALF), hi, place)):
        far = np.flatnonzero(own)
        a, b, c, p = a[far], b[far], from_[far], place[far]
        rows = np.zeros(len(far), RECORD)
        rows["core"] = mix((sums[c + GRAM + HALF] - sums[c]) * down[c] ^ np.uint64(side))
        rows["segment"] = mix((sums[b + LENGTH] - sums[a]) * down[a] ^ (b - a).astype(np.uint64) * np.uint64(_OTHER) + (p - a).astype(np.uint64))
        rows["lo"], rows["more"] = a, b - a
        out.append(rows)
    return np.concatenate(out)


def string_records(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Records of single strings: their two hashes stand for core and segment."""
    out = np.zeros(len(starts), RECORD)
    for name, base in (("core", _BASE), ("segment", _OTHER)):
        sums = _sums(text, base)
        out[name] = mix((sums[starts + LENGTH] - sums[starts]) * _powers(len(text) + 1, base)[1][starts])
    out["lo"] = starts
    return out


def drop_copies(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest of each segment, the others), by core; equal records are one."""
    order = np.lexsort((found["lo"], found["row"], found["id"], found["segment"], found["core"]))
    found = found[order]
    same = np.zeros(len(found), bool)
    same[1:] = np.logical_and.reduce([found[c][1:] == found[c][:-1] for c in ("core", "segment", "id", "row", "lo")])
    found = found[~same]
    again = np.zeros(len(found), bool)
    again[1:] = (found["core"][1:] == found["core"][:-1]) & (found["segment"][1:] == found["segment"][:-1])
    return found[~again], found[again]


_DEALT = "bucket int, kind int, id long, row long, data binary"


def _dealt(bucket, kind, ids, rows, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(data, pa.binary())], ["bucket", "kind", "id", "row", "data"])


def _spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Starts lo to hi -> bytes from lo to the end of the last string, as rows (from, to)."""
    return np.stack([lo, hi + LENGTH], axis=1)


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Spans (from, to) as maximal runs, in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def _cuts(found: np.ndarray) -> pa.RecordBatch:
    """Records of segments to be removed -> a row of kind 1 for each document."""
    found = found[np.lexsort((found["lo"], found["row"], found["id"]))]
    new = np.ones(len(found), bool)
    new[1:] = (found["id"][1:] != found["id"][:-1]) | (found["row"][1:] != found["row"][:-1])
    first = np.flatnonzero(new)
    lo = found["lo"].astype(np.int64)
    spans = _spans(lo, lo + found["more"])
    data = [merge_spans(s).astype("<i8").tobytes() for s in np.split(spans, first[1:])] if len(found) else []
    bucket = (mix((found["id"][first] ^ found["row"][first]).view(np.uint64)) % np.uint64(1 << 30)).astype(np.int32)
    return _dealt(bucket, np.full(len(first), 1), found["id"][first], found["row"][first], data)


def _packed(found: np.ndarray, buckets: int, kind: int = 0) -> Iterator[pa.RecordBatch]:
    """Each bucket's records, and kind 1: copies, which are to be removed already."""
    first, again = drop_copies(found)
    if len(again):
        yield _cuts(again)
    if len(first):
        to = ((first["core"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        to = to[order]
        cut = np.flatnonzero(np.diff(to)) + 1
        parts = np.split(first[order], cut)
        yield _dealt(to[np.concatenate([[0], cut])], [kind] * len(parts), [None] * len(parts), [None] * len(parts), [p.tobytes() for p in parts])


class _Held:
    """Records gathered until there are enough to be packed."""

    def __init__(self, buckets: int, kind: int = 0):
        self.buckets, self.kind, self.parts, self.n = buckets, kind, [], 0

    def add(self, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(found)
        self.n += len(found)
        if self.n > 1 << 20:
            yield from self.done()

    def done(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            found, self.parts, self.n = np.concatenate(self.parts), [], 0
            yield from _packed(found, self.buckets, self.kind)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents -> (bytes, records of their segments, each segment's first start in these bytes), piece by piece."""
    for batch in batches:
        offs, raw = buffers(batch.column(2))
        ids, rows = (batch.column(k).fill_null(_NO_ID).to_numpy(zero_copy_only=False) for k in (0, 1))
        for a, b in chunks(offs, PIECE):
            own = offs[a : b + 1]
            for at in range(int(own[0]), max(int(own[-1]), int(own[0]) + 1), PIECE + (b - a > 1) * PIECE):  # one piece, but for long texts
                to = min(int(own[-1]), at + PIECE + (b - a > 1) * PIECE + LENGTH - 1)
                data = raw[at:to]
                text = np.searchsorted(own, np.arange(at, to), side="right") - 1 if b - a > 1 else np.zeros(to - at, np.int64)
                out = find_segments(data, np.minimum(own[1:], to)[text] - at)
                here = out["lo"].astype(np.int64)
                doc = text[here]
                out["id"], out["row"] = ids[a + doc], rows[a + doc]
                out["lo"] += (at - own[:-1][doc]).astype(np.int64).astype(np.uint32)  # modulo 2**32, as places in a text are below it
                yield data, out, here


def _crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> (core, n): cores with several different segments among a million records, and how many."""
    held, n = [], 0

    def counted():
        core, segment = (np.concatenate(x) for x in zip(*held))
        order = np.sort(core)
        often = order[1:][order[1:] == order[:-1]]  # in order; most cores occur once and are let go here
        some = np.flatnonzero(often[np.minimum(np.searchsorted(often, core), max(len(often) - 1, 0))] == core) if len(often) else np.zeros(0, np.int64)
        core, segment = core[some], segment[some]
        order = np.lexsort((segment, core))
        core, segment = core[order], segment[order]
        new = np.ones(len(core), bool)
        new[1:] = (core[1:] != core[:-1]) | (segment[1:] != segment[:-1])
        names, size = np.unique(core[new], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names[size > 1].view(np.int64)), pa.array(size[size > 1])], ["core", "n"])

    for _, out, _ in _pieces(batches):
        held.append((out["core"].copy(), out["segment"].copy()))
        n += len(out)
        if n > 1 << 20:
            yield counted()
            held, n = [], 0
    if held:
        yield counted()


def _all_starts(lo: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Every start of segments, each once."""
    n = more.astype(np.int64) + 1
    return np.unique(np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum()))


def _collect(buckets: int, hot: np.ndarray = np.zeros(0, np.uint64)):
    """hot: the cores, in order, whose strings are taken one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents -> kind 0: a bucket's segments; kind 4: its strings of hot cores; kind 1: what is to be removed already."""
        held, strings = _Held(buckets), _Held(buckets, 4)
        for data, out, here in _pieces(batches):
            if len(hot):
                own = hot[np.minimum(np.searchsorted(hot, out["core"]), len(hot) - 1)] == out["core"]
                if own.any():
                    for id_, row in {(x["id"].item(), x["row"].item()) for x in out[own][["id", "row"]]}:
                        mine = own & (out["id"] == id_) & (out["row"] == row)
                        starts = _all_starts(here[mine], out["more"][mine])
                        shift = int(out["lo"][mine][0]) - int(here[mine][0])
                        found = string_records(data[starts[0] : starts[-1] + LENGTH], starts - starts[0])
                        found["id"], found["row"], found["lo"] = id_, row, starts + shift
                        yield from strings.add(found)
                    out = out[~own]
            if len(out) > 1 << 18:  # a long text that repeats itself has a segment for every byte
                first, again = drop_copies(out)
                if len(again):
                    yield _cuts(again)
                out = first
            yield from held.add(out)
        yield from held.done()
        yield from strings.done()

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> kind 1: removed; one document's records whose cores have several segments: kind 2, or
    kind 3 where there are more than CROWD."""
    now, held, strings = None, [], []

    def done():
        if strings:
            _, again = drop_copies(np.concatenate([np.frombuffer(x, RECORD) for x in strings]))
            strings.clear()
            if len(again):
                yield _cuts(again)
        if not held:
            return
        found = np.concatenate([np.frombuffer(x, RECORD) for x in held])
        held.clear()
        first, again = drop_copies(found)
        if len(again):
            yield _cuts(again)
        _, back, count = np.unique(first["core"], return_inverse=True, return_counts=True)
        for kind, some in ((2, (count > 1) & (count <= CROWD)), (3, count > CROWD)):
            own = first[some[back]]
            if len(own):
                own = own[np.lexsort((own["lo"], own["row"], own["id"]))]
                cut = np.flatnonzero((np.diff(own["id"]) != 0) | (np.diff(own["row"]) != 0)) + 1
                parts = np.split(own, cut)
                yield _dealt([now] * len(parts), [kind] * len(parts), [p["id"][0] for p in parts], [p["row"][0] for p in parts], [p.tobytes() for p in parts])

    for batch in batches:
        kind, bucket = batch.column(1).to_numpy(), batch.column(0).to_numpy()
        ready = np.flatnonzero(kind == 1)
        if len(ready):
            yield batch.take(pa.array(ready))
        for i in np.flatnonzero(kind != 1).tolist():
            if bucket[i] != now:
                yield from done()
            now = int(bucket[i])
            (strings if kind[i] == 4 else held).append(batch.column(4)[i].as_py())
    yield from done()


# --- shards and their merge -------------------------------------------------------------------------


def _stable(keys: np.ndarray) -> np.ndarray:
    """A stable argsort of numbers below 2**32, in counting passes of 16 bits."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    if len(keys) and int(keys.max()) >> 16:
        order = order[np.argsort((keys >> 16).astype(np.uint16)[order], kind="stable")]
    return order


class Shards:
    """Segments laid end to end, by shard, with the letter (STEP bytes, numbered) that starts at each place."""

    def __init__(self, segments: list[bytes], shard_bytes: int = SHARD):
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.data, n = np.frombuffer(b"".join(segments), np.uint8), int(self.start[-1])
        self.segment = np.repeat(np.arange(len(segments)), sizes)
        self.ends = self.start[1:][self.segment]
        down, sums = _powers(n + 1)[1], _sums(self.data)
        at = np.arange(n)
        whole = at + STEP <= self.ends
        to = np.minimum(at + STEP, n)
        letters = mix((sums[to] - sums[:-1]) * down[:n])
        names, number = np.unique(letters[whole], return_inverse=True)
        # a letter that its text's end cuts short is like no other
        self.letter = np.empty(n, np.int64)
        self.letter[whole] = number
        self.letter[~whole] = len(names) + np.arange(n - len(number))
        self.shard = (self.start[:-1] // shard_bytes)[self.segment]
        self.rounds = int(sizes.max(initial=0)) // STEP + 1

    def sorted_alone(self, at: np.ndarray) -> np.ndarray:
        """The places of one shard in the order of their suffixes, each text's end smaller than any letter and unlike others."""
        tails = at[self.ends[at] - at <= STEP]
        order = at
        for _ in range(self.rounds):
            before = order[order - STEP >= self.start[:-1][self.segment[order]]] - STEP
            before = np.concatenate([tails, before])
            order = before[_stable(self.letter[before])]
        return order

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, interval): all places whose next LENGTH bytes occur again, numbered alike if these are equal."""
        n, count = len(self.letter), int(self.shard[-1]) + 1 if len(self.shard) else 0
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cuts = np.searchsorted(self.shard, np.arange(count + 1))
        order = np.concatenate([self.sorted_alone(np.arange(a, b)) for a, b in zip(cuts[:-1], cuts[1:])])
        before = order - STEP
        has = before >= self.start[:-1][self.segment[order]]
        letters = np.where(has, self.letter[np.maximum(before, 0)], -1)  # the transforms, shard after shard
        tails = np.flatnonzero(self.ends - np.arange(n) <= STEP)
        interleave = self.shard  # which transform each place of the merged order comes from
        block = np.zeros(n, np.int64)
        for depth in range(LENGTH // STEP):
            place = np.empty(n, np.int64)
            place[_stable(interleave)] = np.arange(n)
            now = letters[place]
            some = now >= 0
            key = np.concatenate([self.letter[tails], now[some]])
            of = np.concatenate([self.shard[tails], interleave[some]])
            over = n + np.arange(len(tails)) if depth else np.zeros(len(tails), np.int64)  # a text's end is like no other, once it counts
            old = np.concatenate([over, block[some]])
            pick = _stable(key)
            key, old, interleave = key[pick], old[pick], of[pick]
            new = np.ones(n, bool)
            new[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
            block = np.cumsum(new) - 1
        place = np.empty(n, np.int64)
        place[_stable(interleave)] = np.arange(n)
        again = np.bincount(block, minlength=n)[block] > 1
        return self._verified(order[place][again], block[again])

    def _verified(self, place: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks (places side by side) by their bytes, for hashes alone never remove any."""
        if not len(block):
            return place, block
        new = np.concatenate([[True], block[1:] != block[:-1]])
        head = place[np.flatnonzero(new)[np.cumsum(new) - 1]]
        strings = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)
        same = np.ones(len(place), bool)
        for at in range(0, len(place), 1 << 16):
            to = at + (1 << 16)
            same[at:to] = (strings[place[at:to]] == strings[head[at:to]]).all(axis=1)
        if same.all():
            return place, block
        parts: dict[tuple, int] = {}
        name = [parts.setdefault((b, strings[p].tobytes()), len(parts)) for p, b in zip(place.tolist(), block.tolist())]
        return place, np.array(name, np.int64)


def _segments(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with their records -> kind 2: a segment, its bytes after its first start; kinds 0 and 1: strings of crowded cores."""
        held = _Held(buckets)
        for batch in batches:
            texts = byte_rows(batch.column(2))
            for text, ids, rows, parts in zip(texts, batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                own = _NO_ID if ids is None else ids
                crowded = []
                for part in parts:
                    found = np.frombuffer(part["data"], RECORD)
                    if part["kind"] == 3:
                        crowded.append(found)
                        continue
                    data = [struct.pack("<q", lo) + text[lo : lo + more + LENGTH] for lo, more in zip(found["lo"].tolist(), found["more"].tolist())]
                    yield _dealt([part["bucket"]] * len(data), [2] * len(data), [own] * len(data), [rows] * len(data), data)
                if crowded:
                    found = np.concatenate(crowded)
                    starts = _all_starts(found["lo"].astype(np.int64), found["more"])
                    for at in range(0, len(starts), 1 << 18):
                        some = starts[at : at + (1 << 18)]
                        a, b = int(some[0]), int(some[-1]) + LENGTH
                        if b - a > 16 * PIECE:  # far apart in a very long text: piece by piece
                            cut = np.flatnonzero(np.diff(some // PIECE)) + 1
                            groups = np.split(some, cut)
                        else:
                            groups = [some]
                        for g in groups:
                            a, b = int(g[0]), int(g[-1]) + LENGTH
                            out = string_records(np.frombuffer(text, np.uint8, b - a, a), g - a)
                            out["lo"] += np.uint32(a)
                            out["id"], out["row"] = own, rows
                            yield from held.add(out)
        yield from held.done()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> kind 1: strings that start earlier, too."""
    now, held, strings = None, [], []

    def done():
        if strings:
            _, again = drop_copies(np.concatenate([np.frombuffer(x, RECORD) for x in strings]))
            strings.clear()
            if len(again):
                yield _cuts(again)
        if not held:
            return
        ids, rows, data = (list(x) for x in zip(*held))
        held.clear()
        own = Shards([x[8:] for x in data])
        place, block = own.repeated()
        of = own.segment[place]
        found = np.zeros(len(place), RECORD)
        lo = np.fromiter((struct.unpack_from("<q", x)[0] for x in data), np.int64, len(data))
        found["id"], found["row"], found["lo"] = np.array(ids, np.int64)[of], np.array(rows, np.int64)[of], lo[of] + place - own.start[:-1][of]
        order = np.lexsort((found["lo"], found["row"], found["id"], block))
        found, block = found[order], block[order]
        # a place may lie in two segments: a block's first one does not repeat itself
        again = _after_first(found, block)
        if again.any():
            yield _cuts(found[again])

    for batch in batches:
        ready = np.flatnonzero(batch.column(1).to_numpy() == 1)
        if len(ready):
            yield batch.take(pa.array(ready))
        for b, k, i, r, x in zip(*(batch.column(c).to_pylist() for c in range(5))):
            if k == 1:
                continue
            if (held or strings) and b != now:
                yield from done()
            now = b
            if k == 0:
                strings.append(x)
            else:
                held.append((i, r, x))
    yield from done()


def _after_first(found: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Which rows, in the order of blocks, are at another place than their block's first."""
    if not len(block):
        return np.zeros(0, bool)
    new = np.concatenate([[True], block[1:] != block[:-1]])
    head = found[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return np.logical_or.reduce([found[c] != head[c] for c in ("id", "row", "lo")])


def _remove(names: list[str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept, sizes = [], [], [], []
            for text, cuts in zip(byte_rows(batch.column(text_at)), batch.column(batch.num_columns - 1).to_pylist()):
                own = merge_spans(np.concatenate([np.frombuffer(c, "<i8").reshape(-1, 2) for c in cuts])) if cuts else np.zeros((0, 2), np.int64)
                edges = [0, *own.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                spans.append(len(own))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1) if k != text_at), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns in keep, tw_bytes, tw_removed, tw_spans (maximal removed runs) and tw_kept (what is left, binary)."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError("ids are whole numbers")
    results = [T.StructField("tw_bytes", T.LongType()), T.StructField("tw_removed", T.LongType()), T.StructField("tw_spans", T.LongType()), T.StructField("tw_kept", T.BinaryType())]
    own = [id_col, *no_clash(keep, (id_col, text_col), tuple(f.name for f in results))]
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    clash = docs.groupBy(number.alias("number")).agg(F.count("*").alias("n")).where("n > 1").select("n")
    several_ids = not clash.isEmpty()
    row = F.xxhash64(text_col) if several_ids else F.lit(0).cast("long")
    wide = docs.select(number.alias("number"), row.alias("own_row"), F.col(text_col).alias("own_text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(own)))
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    buckets = max(2 * tasks(spark), -(-size // BUCKET))  # a task each
    narrow = wide.select("number", "own_row", "own_text")
    counts = narrow.mapInArrow(_crowds, "core long, n long").groupBy("core").agg(F.sum("n").alias("n")).where(F.col("n") > HOT)
    hot = np.sort(np.array([r[0] for r in counts.select("core").collect()], np.int64).view(np.uint64))  # fewer than all records over HOT
    found = narrow.mapInArrow(_collect(buckets, hot), _DEALT)
    first = written(found.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_resolve, _DEALT), "repeats")
    same = lambda a, b: (a["number"] == b["id"]) & (a["own_row"] == b["row"])
    several = first.where("kind >= 2").groupBy("id", "row").agg(F.collect_list(F.struct("kind", "bucket", "data")).alias("parts"))
    texts = wide.join(several, same(wide, several))
    texts = texts.dropDuplicates(["number", "own_row"]) if several_ids else texts
    segments = texts.select("number", "own_row", "own_text", "parts").mapInArrow(_segments(buckets), _DEALT)
    merged = written(segments.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_merge, _DEALT), "merged")
    cuts = first.where("kind = 1").unionByName(merged).groupBy("id", "row").agg(F.collect_list("data").alias("cuts"))
    joined = wide.join(cuts, same(wide, cuts), "left").select(*(f"c{i}" for i in range(len(own))), "own_text", "cuts")
    schema = T.StructType([*docs.select(*own).schema.fields, *results])
    return joined.mapInArrow(_remove(schema.names, len(own)), schema)
