"""The registered queries of this subpackage: each applies an operator to its whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import load, new_path
from tidewheel.llm.decontamination import contamination, is_contaminated
from tidewheel.llm.language_id import fit, identify
from tidewheel.llm.line_dedup import dedup_lines
from tidewheel.llm.pii import pseudonymise
from tidewheel.llm.prefix_trie import prefix_trie, rebuilt, turn_rows
from tidewheel.llm.sentencepiece_bpe import encode_decode
from tidewheel.llm.simhash import near_copies
from tidewheel.llm.suffix_dedup import remove_repeats
from tidewheel.llm.token_counts import token_counts
from tidewheel.llm.topk import top_k
from tidewheel.llm.vector_dedup import near_vectors
from tidewheel.llm.warc import read_archives, write_archives
from tidewheel.llm.whitening import fit as fit_whitening
from tidewheel.llm.whitening import identity_error, integers, whiten

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens above which a document is over the limit.
LIMIT = 1024


def hexed(text):
    return F.sha2(text, 256)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("tw_words").alias("n_words"), F.col("tw_hit").alias("n_hit"), F.size("tw_items").cast("long").alias("n_items"), hexed(F.array_join("tw_items", ",")).alias("items_sha256"), is_contaminated().alias("contaminated"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("tw_lines").alias("n_lines"), F.col("tw_dropped").alias("n_dropped"), hexed("text").alias("kept_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = encode_decode(load(spark, sf_dir, "documents"), PIECES)
    return both.select("doc_id", F.col("tw_n").alias("n_tokens"), hexed("tw_ids").alias("ids_sha256"), hexed("tw_text").alias("decoded_sha256"))


def held_out():
    """A quarter of the ids; null ids aren't held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()), PIECES)
    return identify(docs, model, PIECES).select("doc_id", held_out().alias("held_out"), F.col("tw_lang").alias("lang_pred"), F.col("tw_score").alias("score"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("tw_print")), 16, "0").alias("fingerprint"), F.col("tw_component").alias("component_id"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    write_archives(load(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(load(spark, sf_dir, "documents"), BYTES)
    return counts.select("doc_id", F.col("tw_bytes").alias("n_bytes"), F.col("tw_tokens").alias("n_tokens"), (F.col("tw_tokens") > LIMIT).alias("over_limit"))


#: The key of the pseudonyms; a deployment passes a secret of its own to pseudonymise().
PSEUDONYM_KEY = "tidewheel-demo-key"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = pseudonymise(load(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return named.select("doc_id", F.col("tw_values").alias("n_values"), F.col("tw_text").alias("text"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("tw_bytes").alias("n_bytes"), F.col("tw_removed").alias("n_removed"), F.col("tw_spans").alias("n_spans"), hexed("tw_kept").alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie(*rebuilt(turn_rows(load(spark, sf_dir, "conversations"))))
    names = {"conv": "conv_id", "tw_parent": "parent_conv_id", "tw_members": "n_convs", "tw_children": "n_children", "tw_leaves": "n_leaves", "tw_saved": "saved_tokens", "tw_ends": "ends_sha256"}
    return trie.withColumnsRenamed(names)


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(load(spark, sf_dir, "embeddings"))
    return found.select("vec_id", F.col("tw_links").alias("n_links"), F.col("tw_component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("tw_component")).alias("kept"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, width = integers(load(spark, sf_dir, "embeddings"))
    model = fit_whitening(x, width)
    error, shares = identity_error(x, model), F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    rows = whiten(x, model).select("id", "tw_deviation", F.posexplode("tw_white").alias("at", "whitened"))
    return rows.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.col("tw_deviation").cast("long").alias("deviation"),
        "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )


QUERIES = {
    f.__name__: f
    for f in (op1_pii, op2_decontamination, op3_line_dedup, op4_topk, op5_sentencepiece, op6_language_id, op7_suffix_dedup, op8_warc, op9_token_counts, op10_simhash, op11_prefix_trie, op12_vector_dedup, op13_whitening)
}
