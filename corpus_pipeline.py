"""From raw documents to training text: language ID, line dedup, near-dedup, decontamination, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next one's docs. All but the last return the columns of documents;
a stage that changes text brings n_chars up to date. Rows of equal or null ids are documents of their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import load, written
from tidewheel.llm.decontamination import contamination, is_contaminated
from tidewheel.llm.language_id import fit, identify
from tidewheel.llm.line_dedup import dedup_lines
from tidewheel.llm.queries import held_out
from tidewheel.llm.sentencepiece_bpe import encode_decode
from tidewheel.llm.simhash import near_copies

PIECES = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without any language: null texts and those without a letter."""
    found = identify(docs, fit(docs.where(~held_out()), PIECES), PIECES, keep=COLUMNS)
    return found.where("tw_lang <> 'und'").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that ten documents or more have; the documents stay, though some are left empty."""
    kept = dedup_lines(docs, keep=("lang", "source"))
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: that of the smallest id, of equal or null ids any one.

    Rows are told apart by id and text, so documents that share an id, or have none, are compared like others.
    """
    found = near_copies(docs).groupBy("tw_root", "doc_id", "tw_row").agg(F.count("*").alias("n"))
    first = found.groupBy("tw_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tw_row", "n")).alias("first"))
    stay = written(first.select(F.col("first.doc_id").alias("stay_id"), F.col("first.tw_row").alias("stay_row"), F.col("first.n").alias("n")), "stay")
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("row"))
    kept = lambda df: rows.join(df, rows["doc_id"].eqNullSafe(df["stay_id"]) & (rows["row"] == df["stay_row"]), "left_semi")
    once, more = stay.where("n = 1"), stay.where("n > 1")
    if more.isEmpty():
        return kept(once).select(*COLUMNS)
    return kept(once).unionByName(kept(more).dropDuplicates(["doc_id", "row"])).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in passages of the benchmark."""
    found = contamination(docs, load(spark, sf_dir, "benchmark"), keep=("lang", "source", "n_chars"))
    return found.where(~is_contaminated()).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every text, as ids in decimal, and the text they decode to."""
    both = encode_decode(docs, PIECES, keep=("doc_id", "lang", "source"), cached=150_000)  # workers also hold other stages' tables
    return both.select("doc_id", "lang", "source", F.col("tw_n").alias("n_tokens"), F.col("tw_ids").alias("ids"), F.col("tw_text").alias("decoded"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL has no SimHash components, learned languages or merges: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
