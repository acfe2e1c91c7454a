"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary. A word (lower-cased, white
space around it, longer ones in runs of WORD characters) is any sequence of pieces that spells it, with a mark
at its start; its probability under a language is the sum over all such segmentations, which the forward
algorithm gives. A text's score is the sum of its words' logarithms, turned into a posterior over languages.

Piece probabilities come from expectation maximisation over all segmentations of the words of a labelled
sample of SAMPLE_DOCS documents a language (expected; picked by a hash of id and text). Only text and label are used.

Null texts and texts without a letter give `und` with score 0; so does every text if nothing is labelled. Ties go to
the language first in order. Rows that repeat have results that repeat, empty tables none. Texts of any length are
read whole, in parts. Columns that clash with names used inside play no part. The model goes to every task: LANGUAGES
at most, pieces x 8 bytes each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import KEPT, only, written

SAMPLE_DOCS, ROUNDS, WORD, SMOOTH, FLOOR = 2_000, 2, 32, 0.05, 1e-7
#: Languages up to which a model is made: some 130 MB with 32,000 pieces.
LANGUAGES = 512
#: Distinct words whose scores a worker keeps; beyond, it starts anew.
CACHED = 150_000
_MARK = "▁"


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> tuple[ahocorasick.Automaton, int]:
    """An automaton over the ordinary pieces, each with its number and length; how many there are."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    auto = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, piece in enumerate(pieces):
        auto.add_word(piece, i << 8 | len(piece))
    auto.make_automaton()
    return auto, len(pieces)


KEPT["language_id"] = vocabulary.cache_clear


class Lattice:
    """All pieces that match in some words, ordered for the forward algorithm."""

    def __init__(self, words: list[str], model_file: str):
        auto, self.pieces = vocabulary(model_file)
        marked = [_MARK + w for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        self.base = np.concatenate([[0], np.cumsum(sizes + 1)])  # node base + p: the word's first p characters
        joined = "\n".join(marked)
        found = np.fromiter(chain.from_iterable(auto.iter(joined)), np.int64)
        end, piece, length = found[::2] + 1, found[1::2] >> 8, found[1::2] & 0xFF
        known = np.zeros(len(joined) + 2, bool)
        known[end[length == 1]] = True
        known[self.base[1:]] = True  # the separators
        lost = np.flatnonzero(~known[1 : len(joined) + 1]) + 1  # characters that are no piece
        end, piece, length = np.concatenate([end, lost]), np.concatenate([piece, np.full(len(lost), self.pieces)]), np.concatenate([length, np.ones(len(lost), np.int64)])
        at = end - self.base[np.searchsorted(self.base, end, side="right") - 1]
        order = np.lexsort((end, at))
        self.to, self.piece, self.of, self.at = end[order], piece[order], (end - length)[order], at[order]
        self.steps = np.searchsorted(self.at, np.arange(1, (int(self.at.max()) if len(self.at) else 0) + 2))
        self.last = self.base[:-1] + sizes

    def forward(self, p: np.ndarray) -> np.ndarray:
        """p: pieces x languages. The probability of every node, summed over segmentations."""
        alpha = np.zeros((int(self.base[-1]) + 1, p.shape[1]))
        alpha[self.base[:-1]] = 1
        for a, b in zip(self.steps[:-1].tolist(), self.steps[1:].tolist()):
            if a < b:
                to = self.to[a:b]
                first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                alpha[to[first]] = np.add.reduceat(alpha[self.of[a:b]] * p[self.piece[a:b]], first, axis=0)
        return alpha

    def expected(self, p: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, for one language; weights: how often each word occurs."""
        alpha = self.forward(p[:, None])[:, 0]
        beta = np.zeros(len(alpha))
        beta[self.last] = weights / np.maximum(alpha[self.last], 1e-300)
        for a, b in zip(self.steps[-2::-1].tolist(), self.steps[:0:-1].tolist()):
            if a < b:
                np.add.at(beta, self.of[a:b], beta[self.to[a:b]] * p[self.piece[a:b]])
        return np.bincount(self.piece, alpha[self.of] * p[self.piece] * beta[self.to], minlength=self.pieces + 1)


def words_of(text: str) -> list[str]:
    words = text.lower().split()
    if words and max(map(len, words)) > WORD:
        words = [w[i : i + WORD] for w in words for i in range(0, len(w), WORD)]
    return words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text or ""))
        for lang, own in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], ["lang", "word", "n"])


def _expect(model: dict[str, np.ndarray] | None, model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                own = batch.filter(pc.equal(langs, lang))
                lattice = Lattice(own.column(1).to_pylist(), model_file)
                p = np.full(lattice.pieces + 1, 1 / lattice.pieces) if model is None else model[lang]
                uses = lattice.expected(p, own.column(2).to_numpy(zero_copy_only=False).astype(float))[:-1]
                some = np.flatnonzero(uses)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(uses[some])], ["lang", "piece", "uses"])

    return run


def fit(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> dict[str, np.ndarray]:
    """Language -> probability of each piece (and FLOOR for any character outside the vocabulary).

    What reaches the driver is one number for a language and piece.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    shares = {r["lang"]: min(1.0, sample / r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if not shares:
        return {}
    if len(shares) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    share = F.create_map(*(F.lit(x) for kv in shares.items() for x in kv))[F.col("lang")]
    picked = labelled.where((F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000))
    words = written(picked.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    n, model = vocabulary(model_file)[1], None
    for _ in range(ROUNDS):
        uses = words.mapInArrow(_expect(model, model_file), "lang string, piece int, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        model = {}
        for lang in sorted(shares):
            own = uses[uses.lang == lang]
            p = np.full(n + 1, SMOOTH)
            p[own.piece.to_numpy()] += own.uses.to_numpy()
            p /= p[:-1].sum()
            p[-1] = FLOOR
            model[lang] = p
    return model


class Scores:
    """Log-probabilities of words under all languages, kept for the words met lately."""

    def __init__(self, p: np.ndarray, model_file: str):
        self.p, self.model_file = p, model_file
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, self.p.shape[1] + 1))

    def learn(self, words: set[str]) -> None:
        """Adds those not known; the last column tells whether a word has a letter."""
        new = [w for w in words if w not in self.index]
        for at in range(0, len(new), 20_000):
            own = new[at : at + 20_000]
            lattice = Lattice(own, self.model_file)
            logs = np.log(np.maximum(lattice.forward(self.p)[lattice.last], 1e-300))
            first = len(self.index)
            while first + len(own) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first : first + len(own), :-1] = logs
            self.rows[first : first + len(own), -1] = [any(map(str.isalpha, w)) for w in own]
            self.index.update(zip(own, range(first, first + len(own))))

    def of(self, words: list[str]) -> np.ndarray:
        """Summed over the words, in parts, so that any length of text fits."""
        total, get = np.zeros(self.rows.shape[1]), self.index.__getitem__
        for at in range(0, len(words), 50_000):
            own = words[at : at + 50_000]
            total += self.rows[np.fromiter(map(get, own), np.int64, len(own))].sum(axis=0)
        return total


def _classify(langs: list[str], p: np.ndarray, model_file: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language_id")
        scores = Scores(p, model_file)
        for batch in batches:
            found, score = [], []
            texts = batch.column(0)
            for at in range(0, len(texts), 256):
                split = [words_of(t) if t else [] for t in texts.slice(at, 256).to_pylist()]
                if len(scores.index) > CACHED:
                    scores.clear()
                scores.learn(set().union(*split))
                for words in split:
                    total = scores.of(words)
                    if not words or not langs or not total[-1]:
                        found.append("und")
                        score.append(0.0)
                        continue
                    logs = total[:-1]
                    best = int(logs.argmax())
                    found.append(langs[best])
                    score.append(float(1 / np.exp(np.maximum(logs - logs[best], -700)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string()), pa.array(score, pa.float64())], names)

    return run


def identify(docs: DataFrame, model: dict[str, np.ndarray], model_file: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, tw_lang and tw_score. One pass over the texts, no shuffle."""
    langs = sorted(model)
    p = np.stack([model[x] for x in langs], axis=1) if langs else np.zeros((vocabulary(model_file)[1] + 1, 0))
    wide = docs.select(F.col(text_col).alias("tw_in"), *keep)
    schema = T.StructType([*(f for f in wide.schema.fields[1:]), T.StructField("tw_lang", T.StringType()), T.StructField("tw_score", T.DoubleType())])
    return wide.mapInArrow(_classify(langs, p, model_file, schema.names), schema)
