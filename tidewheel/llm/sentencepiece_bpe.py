"""SentencePiece BPE encoding and decoding by a prefix table.

Every prefix of a chunk has one encoding, and so one last token. Going left to right, an automaton gives the
pieces that end at each place; a piece is the last token there if it may follow the last token of the prefix
before it, that is, if the two, encoded together, stay the two. Ids are then read backwards from the end.

No piece has its word mark anywhere but in front, so a text falls into chunks (marks, then a word) that encode
alone, and a worker keeps the encodings of the chunks it has met. The tables of all new chunks of some texts are
filled together, place by place. Characters outside the vocabulary become bytes. Encoding and then decoding are exactly the library's, for models with an identity normaliser.

Null text is the empty text, which has the end id alone. Texts of any length are encoded whole; the table of a long
chunk takes four bytes a character. Rows that repeat have results that repeat, empty tables none; columns that clash
with names used inside play no part.
"""

from __future__ import annotations

import io
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import KEPT, buffers, chunks, only

_MARK = "▁"
#: Chunks and pairs of tokens that a worker keeps (beyond, it starts anew), the longest chunk kept, and the bytes
#: of text whose new chunks are encoded together.
CACHED, PAIRS, LONGEST, TOGETHER = 450_000, 2_000_000, 48, 1 << 20


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, raw[at : at + size]
            at += size


class Codec:
    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        with open(model_file, "rb") as f:
            top = dict(x for x in _fields(f.read()) if x[0] in (2, 3))
        trainer, normal = dict(_fields(top[2])), dict(_fields(top[3]))
        # 3: model_type, 2 is BPE; 2: precompiled map, 3: dummy prefix, 4: strip extra spaces, 5: escape spaces
        if trainer.get(3) != 2 or normal.get(2) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("a BPE model with an identity normaliser is needed")
        self.prefix = _MARK if normal.get(3, 1) else ""
        self.end = model.eos_id()
        ids = range(model.vocab_size())
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.ids = {model.id_to_piece(i): i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        if any(model.is_unused(i) for i in ids) or any(_MARK in p.lstrip(_MARK) for p in self.ids):
            raise ValueError("unused pieces, or word marks inside pieces, are not supported")
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.text = {i: p for p, i in self.ids.items()}
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p, i in self.ids.items():
            if len(p) > 1:
                self.auto.add_word(p, i << 8 | len(p))
        self.auto.make_automaton()
        self.of_code = np.full(0x110000, -1, np.int32)  # the piece that is one character
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_code[ord(p)] = i
        inside = set("".join(p for p in self.ids if len(p) > 1))
        apart = re.escape("".join(c for c in "\n\t\r" if c not in inside))
        self.chunks = re.compile(f"[{apart}]|{_MARK}*[^{_MARK}{apart}]+|{_MARK}+" if apart else f"{_MARK}*[^{_MARK}]+|{_MARK}+").findall
        self.single = {p for p in self.ids if len(p) == 1}
        self.pairs: dict[int, bool] = {}  # met since the last merge into the arrays
        self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.lengths = np.zeros(model.vocab_size(), np.int64)
        for p, i in self.ids.items():
            self.lengths[i] = len(p)
        self.names = [str(i) for i in ids]
        self.back = {i: b for b, i in self.bytes.items()}
        # chunk -> its ids as text, or that and its decoded text where it differs from the chunk's own
        self.known: dict[str, str | tuple[str, str]] = {}
        self.limit = CACHED

    def merged(self, text: str) -> list[str]:
        """Plain merging, best score first and leftmost among equals; only for one token or two."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _token(self, number: int) -> str:
        return self.text[number] if number < 1 << 24 else chr(number - (1 << 24))

    def fits(self, before: int, after: int) -> bool:
        """May after follow before? before -1: may after begin a chunk?"""
        key = (before + 1) << 26 | after
        out = self.pairs.get(key)
        if out is None:
            if len(self.pairs) > PAIRS // 8:
                self.pairs.clear()
            own = [self._token(after)] if before < 0 else [self._token(before), self._token(after)]
            out = self.pairs[key] = self.merged("".join(own)) == own
        return out

    def tokens(self, chunk: str) -> array:
        """Token numbers; a character outside the vocabulary has 1 << 24 plus its code."""
        n = len(chunk)
        last, fits, pairs = array("i", [-2]) * (n + 1), self.fits, self.pairs
        last[0] = -1
        done = 0  # prefixes up to here are settled

        def alone(at: int) -> None:
            """Settles a prefix that no longer piece has settled."""
            if last[at] == -2:
                c = chunk[at - 1]
                token = self.ids.get(c, 1 << 24 | ord(c))
                if last[at - 1] != -2 and fits(last[at - 1], token):
                    last[at] = token

        for end, found in self.auto.iter(chunk):
            end += 1
            while done < end - 1:
                done += 1
                alone(done)
            if last[end] == -2:
                before = last[end - (found & 255)]
                if before != -2:
                    token = found >> 8
                    ok = pairs.get((before + 1) << 26 | token)
                    if ok or ok is None and fits(before, token):
                        last[end] = token
        while done < n:
            done += 1
            alone(done)
        out = array("i")
        while n:
            token = last[n]
            out.append(token)
            n -= len(self.text[token]) if token < 1 << 24 else 1
        out.reverse()
        return out

    def chunk_ids(self, chunk: str) -> array:
        out = array("i")
        for token in self.tokens(chunk):
            if token < 1 << 24:
                out.append(token)
            else:
                out.extend(self.bytes.get(b, self.unknown) for b in chr(token - (1 << 24)).encode("utf-8", "surrogatepass"))
        return out

    def decoded(self, ids: Sequence[int]) -> str:
        """The text of ids, with a space for each word mark; runs of bytes that are no UTF-8 become U+FFFD."""
        parts, run = io.StringIO(), bytearray()
        for i in ids:
            piece = self.text.get(i)
            if piece is None:
                if i in self.back:
                    run.append(self.back[i])
                continue
            if run:
                parts.write(run.decode("utf-8", "replace"))
                run.clear()
            parts.write(piece)
        parts.write(run.decode("utf-8", "replace"))
        return parts.getvalue().replace(_MARK, " ")

    def encode(self, text: str) -> list[str]:
        return self.chunks(self.prefix + text.replace(" ", _MARK)) if text else []

    def one(self, chunk: str) -> str | tuple[str, str]:
        ids, name = self.chunk_ids(chunk), self.names.__getitem__
        text = " ".join(" ".join(map(name, ids[at : at + 65_536])) for at in range(0, len(ids), 65_536))
        decoded = self.decoded(ids)
        return text if decoded == chunk.replace(_MARK, " ") else (text, decoded)

    def _fit(self, keys: np.ndarray) -> np.ndarray:
        """Which pairs may stand together."""
        at = np.minimum(np.searchsorted(self.pair_keys, keys), max(len(self.pair_keys) - 1, 0))
        out = self.pair_fits[at] if len(self.pair_keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(self.pair_keys[at] != keys) if len(self.pair_keys) else np.arange(len(keys))
        if len(new):
            names, back = np.unique(keys[new], return_inverse=True)
            out[new] = np.array([self.fits((k >> 26) - 1, k & (1 << 26) - 1) for k in names.tolist()], bool)[back]
        return out

    def learn(self, chunks_: set[str]) -> None:
        """Encodes chunks not known yet, all prefix tables at once: step p settles every chunk's prefix of p characters."""
        if len(self.known) > self.limit:
            self.known.clear()
        new = [c for c in chunks_ if c not in self.known and len(c) <= LONGEST]
        plain = [c for c in new if self.single.issuperset(c)]
        for c in new:
            if not self.single.issuperset(c):
                self.known[c] = self.one(c)
        if not plain:
            return
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        base = np.cumsum(sizes + 1) - sizes - 1  # node base + p: a chunk's first p characters
        joined = "\n".join(plain)
        found = np.fromiter(chain.from_iterable(self.auto.iter(joined)), np.int64)
        single = self.of_code[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        single[base[1:] - 1] = -1  # the separators
        places = np.flatnonzero(single >= 0)
        node = np.concatenate([places, found[::2]]) + 1
        token = np.concatenate([single[places], found[1::2] >> 8])
        length = np.concatenate([np.ones(len(places), np.int64), found[1::2] & 0xFF])
        at = node - base[np.searchsorted(base, node, side="right") - 1]
        order = np.argsort(at.astype(np.uint8), kind="stable")
        node, token, start = node[order], token[order], (node - length)[order]
        steps = np.searchsorted(at[order], np.arange(1, int(sizes.max()) + 2))
        last = np.full(int(base[-1] + sizes[-1]) + 2, -2, np.int64)
        last[base] = -1
        for a, b in zip(steps[:-1].tolist(), steps[1:].tolist()):
            before = last[start[a:b]]
            some = a + np.flatnonzero(before != -2)
            fit = some[self._fit((before[some - a] + 1) << 26 | token[some])]
            last[node[fit]] = token[fit]
        if len(self.pairs) > 20_000:
            self._settle()
        # ids backwards
        now, rows = base + sizes, []
        live = np.arange(len(plain))
        while len(live):
            own = last[now[live]]
            row = np.full(len(plain), -1, np.int64)
            row[live] = own
            rows.append(row)
            now[live] -= self.lengths[own]
            live = live[now[live] > base[live]]
        counts = (np.stack(rows) >= 0).sum(axis=0).tolist()
        names, text, known = self.names.__getitem__, self.text.__getitem__, self.known
        for chunk, n, ids in zip(plain, counts, np.stack(rows, axis=1).tolist()):
            ids = ids[n - 1 :: -1]
            if "".join(map(text, ids)) != chunk:
                raise AssertionError(f"the pieces of {chunk!r} don't spell it")
            known[chunk] = " ".join(map(names, ids))

    def _settle(self) -> None:
        """Moves the pairs met lately into the sorted arrays."""
        if len(self.pair_keys) > PAIRS:
            self.pair_keys, self.pair_fits = self.pair_keys[:0], self.pair_fits[:0]
        keys = np.concatenate([self.pair_keys, np.fromiter(self.pairs, np.int64, len(self.pairs))])
        fits = np.concatenate([self.pair_fits, np.fromiter(self.pairs.values(), bool, len(self.pairs))])
        self.pair_keys, first = np.unique(keys, return_index=True)
        self.pair_fits = fits[first]
        self.pairs.clear()

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """(ids, decoded text) of each text; ids in decimal with a space between, without an end id."""
        split = [self.encode(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        known, drop = self.known, len(self.prefix)
        for own in split:
            try:
                found = [known[c] for c in own]
            except KeyError:  # very long chunks aren't kept
                found = [known[c] if c in known else self.one(c) for c in own]
            try:
                yield " ".join(found), "".join(own).replace(_MARK, " ")[drop:]
            except TypeError:
                text = [c.replace(_MARK, " ") if isinstance(f, str) else f[1] for c, f in zip(own, found)]
                yield " ".join(f if isinstance(f, str) else f[0] for f in found), "".join(text)[drop:]


@lru_cache(maxsize=2)
def codec(model_file: str) -> Codec:
    return Codec(model_file)


KEPT["sentencepiece"] = codec.cache_clear


def _both(model_file: str, names: list[str], cached: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("sentencepiece")
        own = codec(model_file)
        own.limit = cached
        end = str(own.end)
        for batch in batches:
            offs, _ = buffers(batch.column(0))
            for a, b in chunks(offs, TOGETHER):
                n, ids, texts = [], [], []
                for found, text in own.encoded(batch.column(0).slice(a, b - a).to_pylist()):
                    ids.append(f"{found} {end}" if found else end)
                    n.append(ids[-1].count(" ") + 1)
                    texts.append(text)
                rest = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rest.columns[1:], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names)

    return run


def encode_decode(docs: DataFrame, model_file: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), cached: int = CACHED) -> DataFrame:
    """The columns in keep, tw_n (ids, the end id included), tw_ids (decimal, one space between) and tw_text (decoded).

    cached: chunks that a worker keeps, about 200 bytes each; it changes the time taken only.
    """
    wide = docs.select(F.col(text_col).alias("tw_in"), *keep)
    schema = T.StructType([*wide.schema.fields[1:], T.StructField("tw_n", T.LongType()), T.StructField("tw_ids", T.StringType()), T.StructField("tw_text", T.StringType())])
    return wide.mapInArrow(_both(model_file, schema.names, cached), schema)
