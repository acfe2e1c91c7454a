"""Anonymous feature names, and de-identified text by rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.cohort import drawn

#: Endings of feature names that are kept.
SUFFIXES = (
    "_count_subject_present_mrc_cs", "_count_subject_present", "_days-since-last-diagnostic-order", "_days-between-first-last-diagnostic", "_days-between-first-last-drug",
    "_days-since-last-drug-order", "_days-since-last-test", "_days-between-first-last", "_contains-extreme-high", "_contains-extreme-low", "_num-diagnostic-order",
    "_num-drug-order", "_earliest-test", "_most-recent", "_num-tests", "_count_mrc_cs", "_mean", "_median", "_mode", "_std", "_max", "_min", "_count",
)
#: Beginnings of feature names that are kept.
FIXED_PREFIXES = (
    "__index_level_", "Unnamed:", "client_idcode:", "outcome_var_", "ConsultantCode_", "ClinicCode_", "AppointmentType_", "date_time_stamp_",
    "core_resus_", "news_resus_", "vte_status_", "hosp_site_", "core_02_", "census_", "bed_", "bmi_",
)
#: The same, and what else this engine's extractors begin names with.
PREFIXES = (*FIXED_PREFIXES, "news_", "smoking_status_", "height_", "weight_")
#: Names up to which they are numbered.
MOST_NAMES = 1_000_000


def _longest(words: tuple[str, ...]) -> str:
    escaped = [w.replace("-", r"\-") for w in sorted(words, key=len, reverse=True)]
    return "|".join(escaped)


def feature_key(names: DataFrame, column: str = "feature", prefixes: tuple[str, ...] = PREFIXES, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """feature, anonymous: distinct names with their core as concept_<i>, the longest known prefix and suffix kept;
    names that have neither as feature_<i>. Cores and plain names are numbered in alphabetical order.

    Names are columns of a matrix: one ordered window numbers them, and more than MOST_NAMES are refused.
    """
    own = names.select(F.col(column).alias("feature")).where("feature is not null").distinct()
    if own.limit(MOST_NAMES + 1).count() > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    before = F.regexp_extract("feature", f"^({_longest(prefixes)})", 1)
    rest = F.substring(F.col("feature"), F.length("before") + 1, F.length("feature"))
    after = F.regexp_extract("rest", f"({_longest(suffixes)})$", 1)
    cut = own.withColumn("before", before).withColumn("rest", rest).withColumn("after", after)
    cut = cut.withColumn("core", F.substring(F.col("rest"), F.lit(1), F.length("rest") - F.length("after"))).withColumn("plain", (F.col("before") == "") & (F.col("after") == ""))
    number = F.dense_rank().over(Window.partitionBy("plain").orderBy("core")) - 1
    name = F.when(F.col("plain"), F.concat(F.lit("feature_"), number)).otherwise(F.concat("before", F.lit("concept_"), number, F.col("after")))
    return cut.select("feature", name.alias("anonymous"))


def anonymous(rows: DataFrame, key: DataFrame) -> DataFrame:
    return rows.join(key, "feature").withColumn("feature", F.col("anonymous")).drop("anonymous")


def named_again(rows: DataFrame, key: DataFrame) -> DataFrame:
    back = key.select(F.col("feature").alias("tw_name"), F.col("anonymous").alias("feature"))
    return rows.join(back, "feature").withColumn("feature", F.col("tw_name")).drop("tw_name")


#: Kinds of identifiers and their patterns (Java), in the order in which they are replaced.
RULES = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "URL": r"https?://[^ \t\n<>]+",
    "PHONE": r"\+[0-9]{1,3} ?\(?[0-9]{2,4}\)?[0-9 -]{5,12}[0-9]",
    "IP": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "DATE": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    "NUMBER": r"\b[0-9]{9,}\b",
}


def deidentified(text: Column, redact: bool = True, rules: dict[str, str] = RULES) -> Column:
    """Identifiers as [****] (redact) or as their kind in brackets; null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for kind, pattern in rules.items():
        out = F.regexp_replace(out, pattern, "[****]" if redact else f"[{kind}]")
    return out


def deidentify(rows: DataFrame, columns: list[str], redact: bool = True, in_place: bool = False, suffix: str = "_anonymized", rules: dict[str, str] = RULES) -> DataFrame:
    return rows.withColumns({c if in_place else c + suffix: deidentified(F.col(c), redact, rules) for c in columns})


def entities(rows: DataFrame, key: str, text: str, rules: dict[str, str] = RULES) -> DataFrame:
    """key, label, text, n: each identifier in a text and how often it occurs there, kinds found apart from one another."""
    found = F.array(*(F.struct(F.lit(k).alias("label"), F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(p), F.lit(0)).alias("all")) for k, p in rules.items()))
    out = rows.select(key, F.explode(found).alias("f")).select(key, "f.label", F.explode("f.all").alias("text"))
    return out.groupBy(key, "label", "text").agg(F.count("*").alias("n"))


def positions(rows: DataFrame, key: str, text: str, label: str, pattern: str) -> DataFrame:
    """key, label, text, start, end of every match of one rule: places follow from the pieces between."""
    t = F.coalesce(F.col(text), F.lit(""))
    found, parts = F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1)
    out = rows.withColumn("tw_f", found).withColumn("tw_p", parts).where(F.size("tw_f") > 0).select(key, "tw_f", "tw_p", F.posexplode("tw_f").alias("i", "text"))
    length = lambda a, n: F.aggregate(F.slice(a, 1, n), F.lit(0), lambda s, x: s + F.length(x))
    start = length(F.col("tw_p"), F.col("i") + 1) + length(F.col("tw_f"), F.col("i"))
    return out.select(key, F.lit(label).alias("label"), "text", start.alias("start"), (start + F.length("text")).alias("end"))


def report(rows: DataFrame, key: str, text: str, rules: dict[str, str] = RULES, sample: int | None = None, seed: int = 42) -> DataFrame:
    """label, texts, entities, per_text: how many texts hold a kind, how many of it there are, and how many a text; over a
    sample of so many rows, drawn by a hash of seed and key, if asked for."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = rows if sample is None else drawn(rows, key, sample, seed)
    counts = rows.select(F.explode(F.array(*(F.struct(F.lit(k).alias("label"), F.regexp_count(t, F.lit(p)).alias("n")) for k, p in rules.items()))).alias("c")).select("c.*")
    return counts.groupBy("label").agg(F.count_if(F.col("n") > 0).alias("texts"), F.sum("n").alias("entities"), F.avg("n").alias("per_text"))
