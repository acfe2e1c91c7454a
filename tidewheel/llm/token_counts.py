"""Token counts by a two-tier lookup, without shuffling pre-tokens.

Texts are split into pre-tokens, and a text's count is the sum of its pre-tokens' token counts. The frequent
pre-tokens of a bounded sample of documents, with their counts, are broadcast as one compact table of at most
TABLE entries; each worker encodes the others itself and keeps what it has met lately. The table only saves
time: counts are exact whatever it holds.

Special strings inside texts are single tokens, as the library has it by default. Null text has no bytes and
no tokens. Texts of any length are counted whole. Rows that repeat have counts that repeat, empty tables none;
columns that clash with names used inside play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidewheel.llm.common import buffers, chunks

#: Entries of the broadcast table, documents it is taken from (expected), longest pre-token in it (bytes), pre-tokens a worker keeps.
TABLE, SAMPLE_DOCS, LONGEST, CACHED = 65_536, 5_000, 64, 300_000
#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return out


class Counter_(dict):
    """Pre-token -> tokens; starts with the broadcast table, learns the rest."""

    def __init__(self, tokenizer_file: str, table: bytes, lengths: bytes):
        tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = tokenizer.model
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.first = dict(zip(table.decode().split("\0"), lengths)) if lengths else {}
        self.find = regex.compile(PATTERN).findall
        self.update(self.first)

    def __missing__(self, piece: str) -> int:
        n = len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))
        if len(piece) <= LONGEST:
            if len(self) > CACHED + len(self.first):
                self.clear()
                self.update(self.first)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        n = 0
        if self.special is not None and self.special.search(text):
            n = len(self.special.findall(text))
            return n + sum(self.count_plain(x) for x in self.special.split(text))
        return self.count_plain(text)

    def count_plain(self, text: str) -> int:
        return sum(map(self.__getitem__, self.find(text)))


@lru_cache(maxsize=1)
def _counter(tokenizer_file: str, table: bytes, lengths: bytes) -> Counter_:
    return Counter_(tokenizer_file, table, lengths)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = regex.compile(PATTERN).findall
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(find(text))
        own = {k: n for k, n in counts.items() if len(k.encode()) <= LONGEST and "\0" not in k}
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], ["piece", "n"])


def frequent(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[bytes, bytes]:
    """(pre-tokens, NUL between; their counts of tokens, a byte each): TABLE entries of LONGEST bytes at most."""
    n = docs.count()
    sample = docs.where(F.col(text_col).isNotNull() & (F.pmod(F.xxhash64(id_col, text_col, F.lit("table")), F.lit(1_000_000)) < 1_000_000 * SAMPLE_DOCS / max(n, 1)))
    counts = sample.select(text_col).mapInArrow(_sampled, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r[0] for r in counts.orderBy(F.desc("n"), "piece").limit(TABLE).select("piece").collect()]
    own = Counter_(tokenizer_file, b"", b"")
    kept = [(p, own[p]) for p in pieces]
    kept = [(p, k) for p, k in kept if k < 256]
    return "\0".join(p for p, _ in kept).encode(), bytes(k for _, k in kept)


def _count(tokenizer_file: str, tables, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counter(tokenizer_file, *tables.value)
        for batch in batches:
            offs, _ = buffers(batch.column(0))
            tokens: list[int] = []
            for a, b in chunks(offs):
                tokens.extend(own.count(t) if t else 0 for t in batch.column(0).slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.diff(offs)), pa.array(tokens, pa.int64())], names)

    return run


def token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, tw_bytes and tw_tokens. One pass over the texts; only the sample's counts are shuffled."""
    tables = docs.sparkSession.sparkContext.broadcast(frequent(docs, tokenizer_file, id_col, text_col))
    wide = docs.select(F.col(text_col).alias("tw_in"), *keep)
    schema = T.StructType([*wide.schema.fields[1:], T.StructField("tw_bytes", T.LongType()), T.StructField("tw_tokens", T.LongType())])
    return wide.mapInArrow(_count(tokenizer_file, tables, schema.names), schema)
