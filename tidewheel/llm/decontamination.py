"""Benchmark decontamination by winnowing.

Words are maximal runs of a-z, 0-9 and non-ASCII characters, after lower-casing A-Z. A window of an item is
WINDOW consecutive words, or all its words if it has fewer. Every k-gram of words is hashed and of each run
of w of them the smallest is kept, with k + w - 1 = the window's length: two texts that share a window share
a kept hash. Kept hashes of documents and items are joined, and each hit is extended by comparing words.

Null texts have no words. Rows with equal or null ids are documents of their own: candidates go back to a row by
its id and its text's hash. Equal rows have equal results. Items without words never occur. Empty tables give
empty results, no items no hits. Texts of any length are treated whole. Columns of the tables that clash with
names used inside play no part; those in keep must not be named as the results are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import KEPT, buffers, chunks, mix, no_clash, only, written

WINDOW = 13
#: Rows up to which benchmark fingerprints (16 bytes each) and found candidates (32 bytes each) are broadcast, and
#: bytes of items up to which these are. Beyond, both sides are shuffled, and items travel with their candidates.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
KEPT["decontamination"] = _POWERS.clear


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below n or more."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        n, out = max(n, 1 << 16), []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS[base] = (out[0], out[1])
    return _POWERS[base]


def _ranged(values: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """A hash of values[first:last], for every pair."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[last] - sums[first]) * down[first]


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends) of all words of texts that lie end to end in data, and where each text's words begin."""
    is_word = _WORD[data]
    before, after = np.zeros_like(is_word), np.zeros_like(is_word)
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    before[offs[:-1][offs[:-1] < len(data)]] = False
    after[offs[1:][offs[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    low = _LOWER[data].astype(np.uint64) + np.uint64(1)
    return mix(_ranged(low, starts, ends, _P) ^ (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    at = np.arange(len(words) - k + 1)
    return mix(_ranged(words, at, at + k, _Q))


def winnow(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, kept hash) for texts whose word hashes start at first[i]; any shared run of length words shares one."""
    k = (length + 1) // 2
    w = length - k + 1
    low = gram_hashes(words, k)
    done = 1
    while done < w:  # minima over 1, 2, 4, ... k-grams up to w
        step = min(done, w - done)
        low = np.minimum(low[: len(low) - step], low[step:]) if len(low) > step else low[:0]
        done += step
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(low)]
    inside = np.arange(len(low)) + length <= first[1:][text] if len(low) else np.zeros(0, bool)
    text, low = text[inside], low[inside]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    return text[new], low[new]


def _fingerprints(lengths: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The names' columns, then the text -> the names' columns, length and kept hash."""
        only("decontamination")
        for batch in batches:
            offs, raw = buffers(batch.column(len(names)))
            for a, b in chunks(offs):
                own = offs[a : b + 1] - offs[a]
                data = raw[offs[a] : offs[b]]
                starts, ends, first = find_words(data, own)
                words = word_hashes(data, starts, ends)
                for length in lengths:
                    text, kept = winnow(words, first, length)
                    if len(kept):
                        of = pa.array(text + a)
                        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in range(len(names))), pa.array(np.full(len(kept), length, np.int32)), pa.array(kept.view(np.int64))], [*names, "length", "kept"])

    return run


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offs, raw = buffers(batch.column(0))
        _, _, first = find_words(raw[offs[0] : offs[-1]], offs - offs[0])
        n = np.unique(np.minimum(np.diff(first), WINDOW))
        yield pa.RecordBatch.from_arrays([pa.array(n[n > 0].astype(np.int32))], ["length"])


def split_words(text: bytes) -> list[bytes]:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = find_words(data, np.array([0, len(data)]))
    low = _LOWER[data].tobytes()
    return [low[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


class Places:
    """A text's windows of one length, grouped by hash; a group's places are those that are equal to its first word by word."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, length: int):
        self.ids, self.length = ids, length
        grams = gram_hashes(words, length)
        self.order = np.argsort(grams, kind="stable")
        self.hashes, self.first = np.unique(grams[self.order], return_index=True)
        self.found: dict[tuple, np.ndarray] = {}

    def _equal(self, group: int, want: np.ndarray) -> np.ndarray:
        last = self.first[group + 1] if group + 1 < len(self.first) else len(self.order)
        at = self.order[self.first[group] : last]
        same = np.ones(len(at), bool)
        for k in range(self.length):
            same &= self.ids[at + k] == want[k]
        return at[same]

    def of(self, hashes: np.ndarray, ids: np.ndarray) -> Iterator[tuple[bool, np.ndarray]]:
        """(met before, places) of each window of an item (its hashes, its words' ids) that stands in the text, each distinct one once."""
        own, where = np.unique(hashes, return_index=True)
        group = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        for g, i in zip(group[self.hashes[group] == own].tolist(), where[self.hashes[group] == own].tolist()):
            want = ids[i : i + self.length]
            key = (g, *want.tolist())
            known = key in self.found
            if not known:
                self.found[key] = self._equal(g, want)
            if len(self.found[key]):
                yield known, self.found[key]


def extend(text: bytes, items: list[tuple]) -> tuple[int, np.ndarray, list]:
    """Words, which of them are hit, and the ids of the (id, words) pairs with occurring windows. Hashes find places; words decide.

    A window is looked up once however often an item or a text repeats it, and its places are marked once for all items.
    """
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = find_words(data, np.array([0, len(data)]))
    n, found = len(starts), []
    edge = np.zeros(n + 1, np.int64)
    if n:
        low, words = _LOWER[data].tobytes(), word_hashes(data, starts, ends)
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(low[a:b], len(number)) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, n)
        places: dict[int, Places] = {}
        for item, item_words in items:
            length = min(WINDOW, len(item_words))
            if not length or length > n:
                continue
            if length not in places:
                places[length] = Places(words, ids, length)
            d = np.frombuffer(b" ".join(item_words), np.uint8)
            s, e, _ = find_words(d, np.array([0, len(d)]))
            own = np.fromiter((number.get(w, -1) for w in item_words), np.int64, len(item_words))
            occurs = False
            for known, at in places[length].of(gram_hashes(word_hashes(d, s, e), length), own):
                occurs = True
                if not known:
                    edge[at] += 1
                    np.add.at(edge, at + length, -1)
            if occurs:
                found.append(item)
    return n, np.cumsum(edge[:-1]) > 0, found


def _extend(names: list[str], items):
    """items: a broadcast key -> (id, text), or None where each candidate brings its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("decontamination")
        known: dict[int, tuple] = {}

        def words_of(key: int) -> tuple:
            if key not in known:
                item, text = items.value[key]
                known[key] = (item, split_words(text.encode()))
            return known[key]

        for batch in batches:
            n_words, n_hit, found_items = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), []
            offs, raw = buffers(batch.column(1))
            for a, b in chunks(offs):
                _, _, first = find_words(raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                n_words[a:b] = np.diff(first)
            for row, own in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                found: list = []
                if own:
                    near = [words_of(x) for x in own] if items else [(x["item"], split_words(x["item_text"].encode())) for x in own]
                    _, hit, found = extend(raw[offs[row] : offs[row + 1]].tobytes(), near)
                    n_hit[row] = int(hit.sum())
                found_items.append(sorted(set(found), key=lambda x: (x is None, x or "")))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1)), pa.array(n_words), pa.array(n_hit), pa.array(found_items, pa.list_(pa.string()))], names)

    return run


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, text, the columns in keep, and tw_words, tw_hit, tw_items (the occurring items' ids as sorted strings).

    Items of equal id are taken apart by their text but reported under the one id. Items without an id have hits, too,
    and are reported as one null, the last.
    """
    rest = no_clash(keep, (id_col, text_col), ("tw_words", "tw_hit", "tw_items"))
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("item_text")).na.drop(subset=["item_text"]).distinct()
    bench = bench.select("item", "item_text", F.xxhash64("item", "item_text").alias("key"))
    lengths = sorted(r[0] for r in bench.select("item_text").mapInArrow(_lengths, "length int").distinct().collect())  # 13 at most
    last = [T.StructField("length", T.IntegerType()), T.StructField("kept", T.LongType())]
    item_prints = written(bench.select("key", "item_text").mapInArrow(_fingerprints(lengths, ["key"]), T.StructType([T.StructField("key", T.LongType()), *last])).distinct(), "item-prints")
    found = narrow.mapInArrow(_fingerprints(lengths, ["id", "row"]), T.StructType([T.StructField("id", narrow.schema["id"].dataType), T.StructField("row", T.LongType()), *last]))
    side = F.broadcast(item_prints) if item_prints.count() <= BROADCAST_ROWS else item_prints
    pairs = written(found.join(side, ["length", "kept"]).select("id", "row", "key").distinct(), "candidates")
    small = (bench.agg(F.sum(F.octet_length("item_text").cast("long"))).first()[0] or 0) <= BROADCAST_BYTES
    texts, what = None, F.struct("item", "item_text")
    if small:
        texts, what = docs.sparkSession.sparkContext.broadcast({r["key"]: (r["item"], r["item_text"]) for r in bench.collect()}), F.col("key")
    near = (pairs if small else pairs.join(bench, "key")).groupBy(F.col("id").alias("near_id"), F.col("row").alias("near_row")).agg(F.collect_list(what).alias("near"))
    if small and pairs.count() <= BROADCAST_ROWS:
        near = F.broadcast(near)
    own = [id_col, text_col, *rest]
    wide = docs.select(F.xxhash64(text_col).alias("row"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(own)))
    joined = wide.join(near, F.col("c0").eqNullSafe(F.col("near_id")) & (F.col("row") == F.col("near_row")), "left").select(*(f"c{i}" for i in range(len(own))), "near")
    schema = T.StructType([*docs.select(*own).schema.fields, T.StructField("tw_words", T.LongType()), T.StructField("tw_hit", T.LongType()), T.StructField("tw_items", T.ArrayType(T.StringType()))])
    return joined.mapInArrow(_extend(schema.names, texts), schema)


def is_contaminated():
    """A hit word, and one in twenty or more hit."""
    return (F.col("tw_hit") > 0) & (F.col("tw_hit") * 20 >= F.col("tw_words"))
