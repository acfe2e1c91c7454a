"""Queries: joins in time, annotations and index events, matrices, anonymisation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.text import has_phrase
from tidewheel.functions.times import ntz, stamp
from tidewheel.operators import annotations as A
from tidewheel.operators import anonymise as N
from tidewheel.operators import features as X
from tidewheel.operators import joins as J
from tidewheel.operators import matrix as M
from tidewheel.operators.cohort import drawn
from tidewheel.operators.slicing import events_in_client_slices, events_in_slices, individual_slices
from tidewheel.plans.registry import query
from tidewheel.plans.vectors import bloods_of
from tidewheel.sources import tables as T
from tidewheel.sources.stand_ins import DAILY, Tables, with_tables
from tidewheel.spec import RunSpec, Span

_NEAR = """, t AS (SELECT obs_id AS row, client_id, ts FROM obs WHERE item = 'purchase'), r AS (SELECT client_id, item AS test, ts, value FROM obs WHERE item <> 'purchase'),
n AS (SELECT row, test, arg_min(value, (abs(epoch_us(r.ts) - epoch_us(t.ts)), epoch_us(r.ts), value)) AS value FROM t JOIN r USING (client_id)
 WHERE r.ts > t.ts - INTERVAL 2 DAY AND r.ts < t.ts + INTERVAL 3 DAY GROUP BY ALL)"""


def _template(t: Tables) -> tuple[DataFrame, DataFrame]:
    o = t.obs()
    return o.where("item = 'purchase'").select(F.col("obs_id").alias("row"), "client_id", "ts"), o.where("item <> 'purchase'").select("client_id", F.col("item").alias("test"), "ts", "value")


@query(with_tables("obs", _NEAR + " SELECT row, test, round(value, 6) AS value FROM n"))
def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _template(Tables(spark, sf_dir))
    return J.nearest_results(a, b, "row", 2, 3).withColumn("value", F.round("value", 6))


@query(with_tables("obs", _NEAR + " SELECT t.row, client_id, round(max(value) FILTER (test = 'view'), 6) AS view, round(max(value) FILTER (test = 'click'), 6) AS click FROM t LEFT JOIN n ON t.row = n.row GROUP BY ALL"))
def asof_matcher(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _template(Tables(spark, sf_dir))
    return J.matcher(a, b, "row", ["view", "click"], 2, 3).select("row", "client_id", F.round("view", 6).alias("view"), F.round("click", 6).alias("click"))


def _codes(spark: SparkSession) -> DataFrame:
    return spark.range(6, 12).select(F.col("id").alias("concept_id"), F.explode(F.sequence(F.lit(1), (F.col("id") % 3).cast("int"))).alias("k")).where("k > 0 and concept_id % 3 > 0").select("concept_id", F.concat(F.lit("I"), F.col("concept_id"), F.lit("."), F.col("k")).alias("target"))


_CODES = "SELECT * FROM (VALUES (7, 'I7.1'), (8, 'I8.1'), (8, 'I8.2'), (10, 'I10.1'), (11, 'I11.1'), (11, 'I11.2')) AS c(concept_id, target)"


@query(with_tables("anns", f"SELECT doc_id, position, target FROM anns LEFT JOIN ({_CODES}) ON cui = concept_id"))
def join_code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.join_codes(Tables(spark, sf_dir).annotations(), _codes(spark)).select("doc_id", "position", "target")


@query(with_tables("anns", "SELECT anns.doc_id, position, description, length(text) AS size FROM anns LEFT JOIN docs ON anns.doc_id = docs.doc_id"))
def join_docs_annots(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return J.join_documents(t.annotations(), t.documents(), "doc_id").select("doc_id", "position", "description", F.length("text").cast("long").alias("size"))


_INDEX = "SELECT client_id, min(ts) AS index_ts FROM anns WHERE cui IN (9, 10) GROUP BY client_id"


@query(with_tables("anns", f"SELECT doc_id, position FROM anns JOIN ({_INDEX}) USING (client_id) WHERE ts > index_ts"))
def filter_rel_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Tables(spark, sf_dir).annotations()
    index = a.where(F.col("cui").isin(9, 10)).groupBy("client_id").agg(F.min("ts").alias("index_ts"))
    return J.relative_to_index(a, index, "after", ("updatetime", "ts")).select("doc_id", "position")


@query(with_tables("anns", "SELECT doc_id, position FROM anns WHERE ts >= (SELECT max(m) FROM (SELECT cui, min(ts) AS m FROM anns WHERE cui IN (9, 12) GROUP BY cui))"))
def filter_rel_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.relative_to_codes(Tables(spark, sf_dir).annotations(), "cui", [9, 12], "earliest", "after").select("doc_id", "position")


@query(with_tables("anns", "SELECT cui, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts FROM anns WHERE cui IN (9, 12) GROUP BY cui"))
def filter_rel_code_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.anchors(Tables(spark, sf_dir).annotations(), "cui", [9, 12], "latest").select("cui", stamp(F.col("ts")).alias("ts"))


_SAMPLES = "SELECT doc_id, position, word AS source_value, substr(word || ' ' || pretty_name, 1, 12) AS text_sample, Time_Value, Presence_Value, Subject_Value FROM anns"


_LABELLED = f""", s AS ({_SAMPLES}), l AS (SELECT DISTINCT substr(text_sample, 1, 8) AS near, source_value, CAST(Time_Value <> 'Past' AND Presence_Value = 'True' AND Subject_Value = 'Patient' AS INTEGER) AS label FROM s WHERE doc_id % 10 = 0)
SELECT doc_id, position, label FROM s JOIN l ON substr(s.text_sample, 1, 8) = l.near AND s.source_value = l.source_value"""


@query(with_tables("anns", _LABELLED), name="match_human_labels_whole")
@query(with_tables("anns", _LABELLED))
def match_human_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All annotations, with the labels of the persons' table, which stands for itself: that of every tenth document."""
    a = Tables(spark, sf_dir).annotations().select("doc_id", "position", F.col("word").alias("source_value"), F.substring(F.concat_ws(" ", "word", "pretty_name"), 1, 12).alias("text_sample"), "Time_Value", "Presence_Value", "Subject_Value")
    label = ((F.col("Time_Value") != "Past") & (F.col("Presence_Value") == "True") & (F.col("Subject_Value") == "Patient")).cast("int")
    return J.human_labels(a, a.where("doc_id % 10 = 0"), 8, label).select("doc_id", "position", "label")


_FIRSTS = " FULL JOIN ".join(f"(SELECT client_id, arg_min(word, (ts, tie)) AS {n} FROM anns WHERE {w} GROUP BY client_id) {n}_" + (" USING (client_id)" if n != "a" else "") for n, w in (("a", "cui <= 8"), ("b", "cui >= 7"), ("c", "cui % 3 = 0")))


@query(with_tables("anns", f"SELECT client_id, a, b, c FROM {_FIRSTS} WHERE a <> b OR a <> c OR b <> c"))
def compare_index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients whose first rows in three results differ."""
    a = Tables(spark, sf_dir).annotations()
    return J.first_rows_differ({"a": a.where("cui <= 8"), "b": a.where("cui >= 7"), "c": a.where("cui % 3 = 0")}, "word", "ts", "tie")


@query(with_tables("anns", """, m AS (SELECT cui, count(*) FILTER (acc < 0.2) AS fp, count(*) FILTER (acc >= 0.2 AND acc < 0.3) AS fn, count(*) FILTER (acc >= 0.3) AS tp, count(*) AS n FROM anns GROUP BY cui)
SELECT cui, CAST(nullif(fp, 0) AS DOUBLE) AS fp, CAST(nullif(fn, 0) AS DOUBLE) AS fn, CAST(nullif(tp, 0) AS DOUBLE) AS tp, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, CAST(n AS DOUBLE) AS count FROM m"""))
def ner_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, n = Tables(spark, sf_dir).annotations(), lambda rows: rows.groupBy("cui").agg(F.count("*").alias("value"))
    m = J.ner_results(n(a.where("acc < 0.2")), n(a.where("acc >= 0.2 and acc < 0.3")), n(a.where("acc >= 0.3")), "cui", n(a))
    return m.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_SAT = "SELECT DISTINCT client_id, slice_start, item FROM obs JOIN days ON ts >= slice_start AND ts < slice_start + INTERVAL 2 DAY"


@query(with_tables("obs days ords", f", v AS ({_SAT}), w AS (SELECT client_id, max(ts) AS win FROM ords GROUP BY client_id) SELECT client_id, strftime(slice_start, '%Y-%m-%d') AS slice_start, item, strftime(win, '%Y-%m-%d') AS win FROM v LEFT JOIN w USING (client_id)"))
def vectors_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    v = events_in_slices(t.obs(), DAILY).select("client_id", "slice_start", "item").dropDuplicates()
    w = t.orders().groupBy("client_id").agg(F.max("ts").alias("win"))
    return v.join(w, "client_id", "left").select("client_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"), "item", stamp(F.col("win"), "yyyy-MM-dd").alias("win"))


# --- annotations ------------------------------------------------------------------------------------


@query(with_tables("anns", "SELECT doc_id, position, word, cui, pretty_name FROM anns"))
def annotate_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).annotations().select("doc_id", "position", "word", "cui", "pretty_name")


#: Words of the vocabulary, and pairs of words of the benchmark that begin with one of six letters or more.
_OVERLAPPING = """, v2 AS (SELECT word, 1 AS n FROM vocab UNION SELECT DISTINCT w[i] || ' ' || w[i + 1], 2 FROM (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark), unnest(range(1, len(w))) AS r(i) WHERE length(w[i]) >= 6),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents), t AS (SELECT doc_id, i - 1 AS position, w[i] AS one, w[i] || ' ' || w[i + 1] AS two FROM d, unnest(range(1, len(w) + 1)) AS r(i)),
m AS (SELECT doc_id, position, word, n FROM t JOIN v2 ON v2.word = CASE n WHEN 1 THEN one ELSE two END),
k AS (SELECT doc_id, position, word, n FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.position < m.position + m.n AND o.position + o.n > m.position AND (o.n > m.n OR (o.n = m.n AND o.position < m.position))))"""


def _overlapping(t: Tables) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    pairs = t.raw("benchmark").select(words.alias("w")).select(F.explode(F.transform(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.col("w")[i + 1]))).alias("word"))
    return t.vocabulary().select("word").unionByName(pairs.where(F.length(F.split_part("word", F.lit(" "), F.lit(1))) >= 6)).distinct()


@query(with_tables("vocab", f"{_OVERLAPPING} SELECT doc_id, position, word FROM k"))
def annotate_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary of words and of pairs of words that overlap: the longest match counts."""
    t = Tables(spark, sf_dir)
    return A.longest(A.annotate(t.documents(), _overlapping(t), "doc_id", "text"), "doc_id").select("doc_id", "position", "word")


#: Signs for the driver's texts, which are no clinical ones.
_SIGNS = {"Presence_Value": ("True", {"False": ("the", "le")}), "Time_Value": ("Recent", {"Past": ("in", "of"), "Future": ("to",)})}


@query(with_tables("anns", """, s AS (SELECT * FROM (VALUES ('the', 1, 'False'), ('le', 1, 'False'), ('in', 2, 'Past'), ('of', 2, 'Past'), ('to', 2, 'Future')) AS v(word, rule, value)), h AS (SELECT doc_id, position, rule, value FROM mentions JOIN s USING (word)),
c AS (SELECT a.doc_id, a.position, arg_max(value, h.position) FILTER (rule = 1) AS p, arg_max(value, h.position) FILTER (rule = 2) AS t FROM anns a LEFT JOIN h ON h.doc_id = a.doc_id AND h.position < a.position AND h.position >= a.position - 5 GROUP BY ALL)
SELECT doc_id, position, coalesce(p, 'True') AS presence, coalesce(t, 'Recent') AS time FROM c"""))
def annotation_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mention's surroundings say of it."""
    t = Tables(spark, sf_dir)
    rows = A.in_context(t.documents(), t.annotations().select("doc_id", "position"), "doc_id", "text", _SIGNS)
    return rows.select("doc_id", "position", F.col("Presence_Value").alias("presence"), F.col("Time_Value").alias("time"))


def _nested(t: Tables) -> DataFrame:
    """Documents with their annotations as the annotator's JSON."""
    a = t.annotations()
    meta = F.create_map(F.lit("Time"), F.struct(F.col("Time_Value").alias("value"), F.col("acc").alias("confidence")), F.lit("Subject"), F.struct(F.col("Subject_Value").alias("value"), F.col("acc").alias("confidence")))
    entity = F.struct(F.concat(F.lit("e"), F.col("position")).alias("key"), F.struct(F.col("cui").cast("string").alias("cui"), "pretty_name", F.col("word").alias("source_value"), "acc", F.col("position").cast("int").alias("start"), (F.col("position") + F.length("word")).cast("int").alias("end"), meta.alias("meta_anns")).alias("value"))
    g = a.groupBy("doc_id").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entity)).alias("entities"))).alias("entities"))
    return t.documents().join(g, "doc_id")


_FLAT = """SELECT anns.doc_id, position AS start, CAST(cui AS VARCHAR) AS cui, acc, Time_Value, Subject_Value, sha256(substr(text, CAST(greatest(position - 10, 0) + 1 AS BIGINT), CAST(position + length(word) + 10 - greatest(position - 10, 0) AS BIGINT))) AS sample
FROM anns JOIN docs ON anns.doc_id = docs.doc_id"""


@query(with_tables("anns", _FLAT), name="flatten_annotations_whole")
@query(with_tables("anns", _FLAT))
def flatten_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.flatten(_nested(Tables(spark, sf_dir)), "doc_id", "text", "entities", (), 10)
    return rows.select("doc_id", F.col("start").cast("long").alias("start"), "cui", "acc", "Time_Value", "Subject_Value", F.sha2("text_sample", 256).alias("sample"))


_CODED = f"SELECT doc_id, position, target FROM anns JOIN ({_CODES}) ON cui = concept_id"


@query(with_tables("anns", _CODED), name="annotations_table_whole")
@query(with_tables("anns", _CODED))
def annotations_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = A.flatten(_nested(Tables(spark, sf_dir)), "doc_id", "text", "entities", ("client_id", "ts")).na.drop(subset=["client_id", "ts"])
    rows = flat.withColumn("cui", F.col("cui").try_cast("long"))
    return J.join_codes(rows, _codes(spark), inner=True).select("doc_id", F.col("start").cast("long").alias("position"), "target")


_FOUR = (("epr", "anns", "docs"), ("mct", "note_anns", "notes"), ("textual_obs", "tobs_anns", "tobs"), ("reports", "report_anns", "reports"))
#: By source: the columns of its id, time, description and text.
_NAMES = {
    "epr": ("document_guid", "updatetime", "document_description", "body_analysed"),
    "mct": ("observation_guid", "observationdocument_recordeddtm", "obscatalogmasteritem_displayname", "observation_valuetext_analysed"),
    "textual_obs": ("basicobs_guid", "basicobs_entered", "basicobs_itemname_analysed", "textualObs"),
    "reports": ("basicobs_guid", "updatetime", "basicobs_itemname_analysed", "textualObs"),
}


@query(with_tables("anns note_anns report_anns tobs_anns", " UNION ALL ".join(f"SELECT '{n}' AS annotation_batch_source, doc_id AS document_guid, position, strftime(ts, '%Y-%m-%d') AS day FROM {a}" for n, a, _ in _FOUR)))
def merged_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {n: rows.select("client_id", F.col("doc_id").alias(_NAMES[n][0]), F.col("ts").alias(_NAMES[n][1]), "position", "cui") for n, rows in Tables(spark, sf_dir).annotated().items()}
    m = A.merged(parts, A.ANNOTATION_CHAINS, ("cui",))
    return m.select("annotation_batch_source", "document_guid", "position", stamp(F.col("updatetime"), "yyyy-MM-dd").alias("day"))


@query(with_tables("docs notes reports tobs", " UNION ALL ".join(f"SELECT '{n}' AS document_batch_source, doc_id AS document_guid, length(text) AS size, description AS document_description, {up} AS up, {rec} AS rec FROM (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM {d})" for n, _, d in _FOUR for up, rec in [("t", "t")])))
def merged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sources, each with columns of its own, whose times fill one another."""
    t = Tables(spark, sf_dir)
    rows = {"epr": t.documents(), "mct": t.notes(), "textual_obs": t.textual_obs(), "reports": t.reports()}
    parts = {n: r.select("client_id", *(F.col(c).alias(name) for c, name in zip(("doc_id", "ts", "description", "text"), _NAMES[n]))) for n, r in rows.items()}
    m = A.merged(parts, A.DOCUMENT_CHAINS, tag="document_batch_source")
    return m.select("document_batch_source", "document_guid", F.length("body_analysed").cast("long").alias("size"), "document_description", stamp(F.col("updatetime")).alias("up"), stamp(F.col("observationdocument_recordeddtm")).alias("rec"))


#: The standard columns of consolidated tables, and what each of the seven sources has of them.
_STANDARD = {"client_id": "string", "ts": "timestamp_ntz", "item": "string", "value": "double", "text": "string", "record_id": "long", "gender": "string", "clinic": "long", "clientvisit_serviceguid": "string"}


def _seven(t: Tables) -> dict[str, DataFrame]:
    ward, orders = t.observations(), t.orders().withColumnRenamed("order_id", "record_id")
    return {
        "bloods": t.basic().withColumnRenamed("obs_id", "record_id"), "demographics": t.demographics(), "bmi": ward.where(F.col("item").startswith("OBS ")), "news": ward.where(F.col("item").startswith("NEWS")),
        "diagnostics": orders.where("kind = 'diagnostic'"), "drugs": orders.where("kind = 'medication'"), "appointments": t.appointments().withColumnRenamed("kind", "text"),
    }


_NO = {"item": "NULL", "value": "NULL", "text": "NULL", "record_id": "NULL", "gender": "NULL", "clinic": "NULL"}


def _standard_sql(source: str, rows: str, **own: str) -> str:
    kinds = {"item": "VARCHAR", "value": "DOUBLE", "text": "VARCHAR", "record_id": "BIGINT", "gender": "VARCHAR", "clinic": "BIGINT"}
    return f"SELECT '{source}' AS source, client_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, " + ", ".join(f"CAST({(_NO | own)[c]} AS {k}) AS {c}" for c, k in kinds.items()) + f", CAST(NULL AS VARCHAR) AS clientvisit_serviceguid FROM {rows}"


_SEVEN = " UNION ALL ".join([
    _standard_sql("bloods", "obs", item="item", value="value", text="CASE item WHEN 'purchase' THEN 'SARS POSITIVE' WHEN 'view' THEN 'negative' ELSE item END", record_id="obs_id"), _standard_sql("demographics", "demo", record_id="record_id", gender="gender"),
    _standard_sql("bmi", "ward WHERE item LIKE 'OBS %'", item="item", value="value", text="text"), _standard_sql("news", "ward WHERE item LIKE 'NEWS%'", item="item", value="value", text="text"),
    _standard_sql("diagnostics", "ords WHERE kind = 'diagnostic'", item="item", record_id="order_id"), _standard_sql("drugs", "ords WHERE kind = 'medication'", item="item", record_id="order_id"), _standard_sql("appointments", "appts", text="kind", clinic="clinic"),
])


@query(with_tables("obs demo ward ords appts", _SEVEN))
def merged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven sources as one table of standard columns."""
    return T.merged_sources(_seven(Tables(spark, sf_dir)), _STANDARD).withColumn("ts", stamp(F.col("ts")))


_FIRST = " UNION ALL ".join(f"SELECT client_id, {{f}}(ts, (ts, tie)) AS ts, {{f}}(cui, (ts, tie)) AS cui, {i} AS rank, '{n}' AS source FROM {a} WHERE cui IN (9, 11) GROUP BY client_id" for i, (n, a, _) in enumerate(_FOUR))
_INDEX_SQL = f""", b AS (SELECT client_id, arg_min(ts, (ts, rank)) AS ts, arg_min(cui, (ts, rank)) AS cui, arg_min(source, (ts, rank)) AS source FROM ({_FIRST}) GROUP BY client_id),
c AS (SELECT client_id FROM docs UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer)
SELECT c.client_id, strftime(coalesce(ts, TIMESTAMP '2020-01-01'), '%Y-%m-%d %H:%M:%S') AS index_ts, coalesce(source, 'fallback') AS source, cui, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updatetime, strftime(ts, '%Y-%m-%d %H:%M:%S') AS recorded FROM c LEFT JOIN b ON c.client_id = b.client_id"""


def _indexed(t: Tables, mode: str) -> DataFrame:
    """All clients; a source's rows have the one time column or the other, and the result has both."""
    clients = t.documents().select("client_id").unionByName(t.raw("customer").select(F.col("c_custkey").cast("string").alias("client_id")))
    none = F.lit(None).cast("timestamp_ntz")
    rows = t.annotated()
    parts = {n: rows[n].withColumns({"updatetime": F.col("ts") if _NAMES[n][1] == "updatetime" else none, "recorded": none if _NAMES[n][1] == "updatetime" else F.col("ts")}) for n, _, _ in _FOUR}
    out = A.filled_both_ways(A.index_events(clients, parts, [9, 11], mode, F.lit(datetime(2020, 1, 1)), ("cui", "updatetime", "recorded")), "updatetime", "recorded")
    return out.select("client_id", stamp(F.col("index_ts")).alias("index_ts"), "source", "cui", stamp(F.col("updatetime")).alias("updatetime"), stamp(F.col("recorded")).alias("recorded"))


_FOUR_ANNS = "docs anns note_anns tobs_anns report_anns"


@query(with_tables(_FOUR_ANNS, _INDEX_SQL.format(f="arg_min")), name="index_event_whole")
@query(with_tables(_FOUR_ANNS, _INDEX_SQL.format(f="arg_min")))
def index_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(Tables(spark, sf_dir), "earliest")


@query(with_tables(_FOUR_ANNS, _INDEX_SQL.format(f="arg_max")), name="index_events_whole")
@query(with_tables(_FOUR_ANNS, _INDEX_SQL.format(f="arg_max")))
def index_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(Tables(spark, sf_dir), "latest")


@query(with_tables("anns", f"SELECT client_id, strftime(index_ts + INTERVAL 3 MONTH, '%Y-%m-%d') AS win_from, strftime(index_ts + INTERVAL 3 MONTH + INTERVAL 1 YEAR, '%Y-%m-%d') AS win_to FROM ({_INDEX})"))
def index_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Tables(spark, sf_dir).annotations()
    w = A.index_windows(a.where(F.col("cui").isin(9, 10)).groupBy("client_id").agg(F.min("ts").alias("index_ts")))
    return w.select("client_id", stamp(F.col("win_from"), "yyyy-MM-dd").alias("win_from"), stamp(F.col("win_to"), "yyyy-MM-dd").alias("win_to"))


@query(with_tables("anns", f""", w AS ({_INDEX}), s AS (SELECT client_id, CAST(unnest(generate_series(CAST(index_ts AS DATE), CAST(index_ts AS DATE) + 14, INTERVAL 7 DAY)) AS DATE) AS d FROM w)
SELECT client_id, strftime(d, '%Y-%m-%d') AS slice_start, pretty_name AS feature, CAST(count(*) AS DOUBLE) AS value FROM s JOIN anns USING (client_id) WHERE ts >= d AND ts < d + INTERVAL 8 DAY GROUP BY ALL"""))
def index_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts per week after each client's index event: the slicing run again relative to it."""
    a = Tables(spark, sf_dir).annotations()
    w = a.where(F.col("cui").isin(9, 10)).groupBy("client_id").agg(F.min("ts").alias("win_from")).withColumn("win_to", ntz(F.date_add(F.col("win_from").cast("date"), 14)))
    s = individual_slices(w, RunSpec(start=datetime(2024, 1, 1).date(), span=Span(years=1), step=Span(days=7)))
    return X.concepts(events_in_client_slices(a, s)).withColumn("slice_start", F.date_format("slice_start", "yyyy-MM-dd"))


@query(with_tables("anns", ", o AS (SELECT DISTINCT client_id, cui FROM anns) SELECT x.cui AS a, y.cui AS b, count(*) AS clients FROM o x JOIN o y ON x.client_id = y.client_id AND x.cui < y.cui GROUP BY ALL"))
def cooccurring_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cooccurring(Tables(spark, sf_dir).annotations())


@query(with_tables("anns", ", o AS (SELECT DISTINCT client_id, cui FROM anns) SELECT x.cui AS a, y.cui AS b, count(*) AS clients FROM o x JOIN o y ON x.client_id = y.client_id AND x.cui < y.cui GROUP BY ALL ORDER BY clients DESC, a, b LIMIT 5"))
def cooccurring_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five commonest pairs."""
    return A.cooccurring(Tables(spark, sf_dir).annotations(), 5)


@query(with_tables("anns", "SELECT client_id FROM anns GROUP BY client_id HAVING bool_or(cui IN (9, 10)) AND bool_or(cui IN (11, 12))"))
def clients_with_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.clients_with_all(Tables(spark, sf_dir).annotations(), [[9, 10], [11, 12]])


def _with_all_trailers(docs: DataFrame) -> DataFrame:
    """All documents with a text, a trailer after each 100 characters but the last; every second without a date where doc_id % 3 = 0, none where doc_id % 10 = 0."""
    # cut once a document: from a row of an array of one, which is put in no other place
    d = docs.where("text is not null").select("doc_id", "text", "ts", "description", F.date_format("ts", "dd-MMM-yyyy").alias("tw_day"), F.explode(F.array(F.regexp_extract_all("text", F.lit("(?s).{1,100}"), F.lit(0)))).alias("tw_cut"))
    dated = lambda i: F.concat(F.lit(" Entered on - "), F.col("tw_day"), F.lit(" "), F.lpad((i % 24).cast("string"), 2, "0"), F.lit(":30  "))
    after = lambda i: F.when(i == F.size("tw_cut") - 1, "").when((F.col("doc_id") % 3 == 0) & (i % 2 == 1), " Entered on - (no date) ").otherwise(dated(i))
    body = F.array_join(F.transform("tw_cut", lambda x, i: F.concat(x, after(i))), "")
    return d.select("doc_id", F.explode(F.array(F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(body))).alias("text"), "ts", "description")


_ALL_TRAILERS = """, b AS (SELECT doc_id, ts, description, text, regexp_extract_all(text, '(?s).{1,100}') AS cut, strftime(ts, '%d-%b-%Y') AS day FROM docs WHERE text IS NOT NULL),
p AS (SELECT doc_id, ts, description, day, len(cut) AS n, generate_subscripts(cut, 1) - 1 AS chunk, unnest(cut) AS piece FROM b WHERE doc_id % 10 <> 0 AND len(cut) > 1),
q AS (SELECT *, lpad(CAST(chunk % 24 AS VARCHAR), 2, '0') || ':30' AS hour, doc_id % 3 = 0 AND chunk % 2 = 1 AS bare, CASE WHEN chunk = 0 THEN '' WHEN doc_id % 3 = 0 AND chunk % 2 = 0 THEN 'Entered on - (no date) ' ELSE ' ' END AS before FROM p WHERE chunk < n - 1)
SELECT doc_id, chunk, sha256(before || piece || CASE WHEN bare THEN ' ' ELSE ' Entered on - ' || day || ' ' || hour || ' ' END) AS text, CASE WHEN bare THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d') || ' ' || hour || ':00' END AS ts, description || '_clinical note chunk_' || chunk AS description FROM q
UNION ALL SELECT doc_id, NULL, sha256(text), strftime(ts, '%Y-%m-%d %H:%M:%S'), description FROM b WHERE doc_id % 10 = 0 OR len(cut) <= 1"""


@query(with_tables("docs", _ALL_TRAILERS), name="split_notes_whole")
@query(with_tables("docs", _ALL_TRAILERS))
def split_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.split_notes(_with_all_trailers(Tables(spark, sf_dir).documents()), "doc_id", "text", "ts", "description")
    return out.select("doc_id", "chunk", F.sha2("text", 256).alias("text"), stamp(F.col("ts")).alias("ts"), "description")


def _fetched(sql: str) -> str:
    return sql.replace("SELECT doc_id, chunk, sha256", "SELECT * FROM (SELECT doc_id, chunk, sha256", 1) + ") WHERE ts >= '2024-01-05 00:00:00' AND ts < '2024-01-21'"


def _fetch_split(docs: DataFrame) -> DataFrame:
    out = T.fetch_documents(_with_all_trailers(docs), "doc_id", "text", "ts", "description", date(2024, 1, 5), date(2024, 1, 20), split=True)
    return out.select("doc_id", "chunk", F.sha2("text", 256).alias("text"), stamp(F.col("ts")).alias("ts"), "description")


@query(with_tables("docs", _fetched(_ALL_TRAILERS)))
def fetch_documents_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into entries, and the entries whose own time is in range."""
    return _fetch_split(Tables(spark, sf_dir).documents())


@query(with_tables("notes", _fetched(_ALL_TRAILERS.replace("FROM docs WHERE text IS NOT NULL", "FROM notes WHERE text IS NOT NULL AND contains(lower(description), 'assist')"))))
def fetch_notes_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the notes whose description has a phrase."""
    return _fetch_split(Tables(spark, sf_dir).notes().where(has_phrase(F.col("description"), "assist")))


def _rows(t: Tables) -> DataFrame:
    a = t.annotations()
    meta = F.create_map(F.lit("Time"), F.col("Time_Value"), F.lit("Presence"), F.col("Presence_Value"))
    return a.select(F.concat(F.lit("project "), F.col("doc_id") % 4).alias("project"), F.col("doc_id").alias("document_id"), F.concat(F.lit('doc "'), F.col("doc_id"), F.lit('"')).alias("document_name"), F.concat(F.lit("text\n"), F.col("doc_id")).alias("text"), F.col("tie").alias("annotation_id"), F.col("cui").cast("string").alias("cui"), F.col("word").alias("value"), F.col("position").cast("int").alias("start"), (F.col("position") + 1).cast("int").alias("end"), (F.col("acc") > 0.5).alias("correct"), meta.alias("meta"))


_EXPORTED = """SELECT 'project ' || (doc_id % 4) AS project, doc_id AS document_id, 'doc "' || doc_id || '"' AS document_name, tie AS annotation_id, CAST(cui AS VARCHAR) AS cui, word AS value, acc > 0.5 AS correct, Time_Value AS time FROM anns"""


@query(with_tables("anns", _EXPORTED), name="export_to_rows_whole")
@query(with_tables("anns", _EXPORTED))
def export_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = A.export_to_rows(A.rows_to_export(_rows(Tables(spark, sf_dir))))
    return back.select("project", "document_id", "document_name", "annotation_id", "cui", "value", "correct", F.col("meta")["Time"].alias("time"))


_PROJECTS = "SELECT 'project ' || (doc_id % 4) AS project, count(DISTINCT doc_id) AS documents, count(*) AS annotations FROM anns GROUP BY 1"


@query(with_tables("anns", _PROJECTS), name="rows_to_export_whole")
@query(with_tables("anns", _PROJECTS))
def rows_to_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = A.rows_to_export(_rows(Tables(spark, sf_dir))).select(F.explode(F.from_json("value", A.EXPORT)["projects"]).alias("p"))
    own = F.aggregate("p.documents", F.lit(0).cast("long"), lambda s, d: s + F.size(d["annotations"]))
    return j.groupBy(F.col("p.name").alias("project")).agg(F.sum(F.size("p.documents")).alias("documents"), F.sum(own).alias("annotations"))


@query(with_tables("docs", "SELECT CASE WHEN r = 0 THEN description ELSE description || '_' || r END AS name, size FROM (SELECT description, length(text) AS size, row_number() OVER (PARTITION BY description ORDER BY doc_id) - 1 AS r FROM docs)"))
def labelling_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.unique_names(Tables(spark, sf_dir).documents(), "description", "text", "doc_id").select("name", F.length("text").cast("long").alias("size"))


# --- matrices ---------------------------------------------------------------------------------------


_MATRIX = "SELECT CAST(user_id AS VARCHAR) AS client_id, event_id, CASE WHEN event_type = 'view' THEN value END AS a, CASE WHEN event_type = 'click' AND user_id % 20 <> 0 THEN value END AS b, CAST(NULL AS DOUBLE) AS z FROM events"


def _matrix(t: Tables) -> DataFrame:
    e = t.raw("events")
    return e.select(F.col("user_id").cast("string").alias("client_id"), "event_id", F.when(F.col("event_type") == "view", F.col("value")).alias("a"), F.when((F.col("event_type") == "click") & (F.col("user_id") % 20 != 0), F.col("value")).alias("b"), F.lit(None).cast("double").alias("z"))


_FILL = "coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), first_value({c} IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"


@query(f"WITH m AS ({_MATRIX}), f AS (SELECT event_id, {_FILL.format(c='a')}, {_FILL.format(c='b')} FROM m) SELECT event_id, round(coalesce(a, (SELECT avg(a) FROM f)), 5) AS a, round(coalesce(b, (SELECT avg(b) FROM f)), 5) AS b FROM f")
def impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.impute(_matrix(Tables(spark, sf_dir)), "client_id", "event_id", ["a", "b"]).select("event_id", F.round("a", 5).alias("a"), F.round("b", 5).alias("b"))


@query(f"""WITH m AS (SELECT *, CASE event_id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM ({_MATRIX}))
SELECT event_id, split, round(coalesce(a, (SELECT avg(a) FROM m WHERE split = 'train')), 5) AS a, round(coalesce(b, (SELECT avg(b) FROM m WHERE split = 'train')), 5) AS b FROM m""")
def impute_train_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = F.when(F.col("event_id") % 5 == 0, "test").when(F.col("event_id") % 5 == 1, "val").otherwise("train")
    out = M.impute_train_mean(_matrix(Tables(spark, sf_dir)).withColumn("split", split), ["a", "b", "z"])
    return out.select("event_id", "split", F.round("a", 5).alias("a"), F.round("b", 5).alias("b"))


@query(f"""WITH m AS ({_MATRIX}) SELECT 'a' AS "column", round(avg(CAST(a IS NULL AS INTEGER)) * 100, 6) AS missing FROM m UNION ALL SELECT 'b', round(avg(CAST(b IS NULL AS INTEGER)) * 100, 6) FROM m UNION ALL SELECT 'z', 100.0 FROM m GROUP BY 1""")
def missing_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.missing_percentage(_matrix(Tables(spark, sf_dir)), ["a", "b", "z"]).withColumn("missing", F.round("missing", 6))


@query(f"SELECT event_id, client_id, round(a, 6) AS a, round(b, 6) AS b FROM ({_MATRIX})")
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.drop_all_null(_matrix(Tables(spark, sf_dir))).withColumns({"a": F.round("a", 6), "b": F.round("b", 6)})


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 2.5 END::DOUBLE AS census FROM events")
def true_to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 4
    e = Tables(spark, sf_dir).raw("events").select("event_id", F.when(n == 0, "True").when(n == 1, "false").when(n == 2, "2.5").otherwise("n/a").alias("census"))
    return M.true_to_number(e, ["census"])


@query(f"WITH m AS ({_MATRIX}), e AS (SELECT client_id, round(avg(a), 5) AS a, round(avg(b), 5) AS b, min(event_id) AS first FROM m GROUP BY client_id) SELECT client_id, CASE WHEN client_id LIKE '%5' THEN -1.0 ELSE a END::DOUBLE AS a, CASE WHEN client_id LIKE '%5' THEN -1.0 ELSE b END::DOUBLE AS b, CASE WHEN client_id LIKE '%5' THEN -1 ELSE first END AS first FROM e")
def mean_per_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of all clients, merged into an earlier output that holds some already."""
    m = _matrix(Tables(spark, sf_dir)).withColumn("first", F.col("event_id"))
    new = M.mean_per_client(m, "client_id", ["a", "b"], ["first"], "event_id").select("client_id", F.round("a", 5).alias("a"), F.round("b", 5).alias("b"), "first")
    old = new.where(F.col("client_id").endswith("5")).select("client_id", F.lit(-1.0).alias("a"), F.lit(-1.0).alias("b"), F.lit(-1).cast("long").alias("first"))
    return M.merge_means(new, old, "client_id")


@query("""SELECT p_type AS item, count(*) AS rows, (SELECT count(DISTINCT l_suppkey) FROM lineitem) - count(DISTINCT l_suppkey) AS lacking FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY rows DESC, item LIMIT 50""")
def item_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    j = t.raw("lineitem").join(t.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
    return M.item_coverage(j, "p_type", "l_suppkey", 50)


def _profiled(table: str) -> str:
    top = "(SELECT string_agg(v || ':' || n, ', ' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY v ORDER BY n DESC, v LIMIT 3)) AS top"
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct", min(CAST({c} AS VARCHAR)) AS low, max(CAST({c} AS VARCHAR)) AS high, {top.format(c=c, t=table)} FROM {table}""" for c in _PROFILED)


_PROFILED = ("client_id", "cui", "word", "Time_Value", "tie")


@query(with_tables("anns", _profiled("anns")))
def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.profile(Tables(spark, sf_dir).annotations(), list(_PROFILED), exact=True, top=3)


@query(with_tables("anns", f", mapped AS (SELECT anns.*, target FROM anns JOIN ({_CODES}) ON cui = concept_id) {_profiled('mapped')}"))
def profile_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the annotations that have an external code."""
    return M.profile(J.join_codes(Tables(spark, sf_dir).annotations(), _codes(spark), inner=True), list(_PROFILED), exact=True, top=3)


@query(with_tables("anns", "SELECT doc_id, position, word FROM anns ORDER BY md5('42|' || doc_id || '/' || position), doc_id || '/' || position LIMIT 100"))
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred annotations, drawn by a hash."""
    a = Tables(spark, sf_dir).annotations().withColumn("key", F.concat_ws("/", "doc_id", "position"))
    return drawn(a, "key", 100).select("doc_id", "position", "word")


@query(with_tables("anns", """, k AS (SELECT client_id, 'all' AS type, pretty_name FROM anns UNION ALL SELECT client_id, type, pretty_name FROM anns), c AS (SELECT client_id, type, pretty_name, count(*) AS n FROM k GROUP BY ALL),
b AS (SELECT client_id, type, quantile_cont(n, 0.25) AS bar, sum(n) AS total FROM c GROUP BY ALL)
SELECT client_id, type, CASE WHEN n <= bar THEN 'other' ELSE pretty_name END AS pretty_name, round(sum(n) / first(total), 6) AS share FROM c JOIN b USING (client_id, type) GROUP BY ALL"""))
def category_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all mentions, and over those of each semantic type."""
    return M.shares_by_type(Tables(spark, sf_dir).annotations(), "client_id", "pretty_name", "types").withColumn("share", F.round("share", 6))


# --- anonymisation ----------------------------------------------------------------------------------


_KEPT = ("bed_", "hosp_site_", "core_02_", "ConsultantCode_", "vte_status_", "Unnamed:", "smoking_status_")


@query(with_tables("obs days", f""", n AS (SELECT DISTINCT p || item AS feature FROM ({_SAT}), (SELECT unnest({list(_KEPT)}) AS p) UNION SELECT DISTINCT item || '_mean' FROM ({_SAT}) UNION SELECT DISTINCT 'bmi_' || item || '_median' FROM ({_SAT}) UNION SELECT DISTINCT item FROM ({_SAT})),
c AS (SELECT feature, regexp_extract(feature, '^(census_|news_resus_|news_|bed_|bmi_|hosp_site_|core_02_|core_resus_|ConsultantCode_|ClinicCode_|AppointmentType_|vte_status_|outcome_var_|client_idcode:|Unnamed:|__index_level_|date_time_stamp_|smoking_status_)', 1) AS b, regexp_extract(feature, '(_mean|_median)$', 1) AS a FROM n),
k AS (SELECT *, substr(feature, length(b) + 1, length(feature) - length(b) - length(a)) AS core, b = '' AND a = '' AS plain FROM c),
d AS (SELECT *, dense_rank() OVER (PARTITION BY plain ORDER BY core) - 1 AS i FROM k)
SELECT feature, CASE WHEN plain THEN 'feature_' || i ELSE b || 'concept_' || i || a END AS anonymous FROM d"""))
def anon_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = events_in_slices(Tables(spark, sf_dir).obs(), DAILY).select("item").distinct()
    names = s.select(F.explode(F.array(*(F.concat(F.lit(p), "item") for p in _KEPT), F.concat("item", F.lit("_mean")), F.concat(F.lit("bmi_"), "item", F.lit("_median")), F.col("item"))).alias("feature"))
    return N.feature_key(names)


@query(with_tables("obs days", """, g AS (SELECT client_id, slice_start, item, count(*) AS n FROM obs JOIN days ON ts >= slice_start AND ts < slice_start + INTERVAL 2 DAY GROUP BY ALL)
SELECT item || '_num-tests' AS feature, count(*) AS rows, CAST(sum(n) AS DOUBLE) AS total FROM g WHERE n >= 2 GROUP BY ALL"""))
def deanon_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features under anonymous names, and back."""
    rows = bloods_of(Tables(spark, sf_dir)).where(F.col("feature").endswith("_num-tests"))
    key = N.feature_key(rows)
    return N.named_again(N.anonymous(rows, key), key).groupBy("feature").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))


#: The kinds and their patterns once more, for the SQL.
_RULES = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "URL": r"https?://[^ \t\n<>]+",
    "PHONE": r"\+\d{1,3} ?\(?\d{2,4}\)?[\d -]{5,12}\d",
    "IP": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "DATE": r"\b\d{4}-\d{2}-\d{2}\b",
    "NUMBER": r"\b\d{9,}\b",
}


def _deid(text: str, label: bool) -> str:
    out = f"coalesce({text}, '')"
    for kind, p in _RULES.items():
        out = f"regexp_replace({out}, '{p}', '{f'[{kind}]' if label else '[****]'}', 'g')"
    return out


@query(f"SELECT doc_id, sha256({_deid('text', False)}) AS redacted, sha256({_deid('text', True)}) AS labelled FROM documents")
def deid_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents().select("doc_id", "text")
    red = N.deidentify(d, ["text"]).withColumn("redacted", F.sha2("text_anonymized", 256))
    return N.deidentify(red, ["text"], redact=False, in_place=True).select("doc_id", "redacted", F.sha2("text", 256).alias("labelled"))


_FOUND = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS label, unnest(regexp_extract_all(coalesce(text, ''), '{p}')) AS text FROM documents" for k, p in _RULES.items())


@query(f"SELECT doc_id, label, text, count(*) AS n FROM ({_FOUND}) GROUP BY ALL")
def deid_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.entities(Tables(spark, sf_dir).documents(), "doc_id", "text")


@query(f"""WITH c AS ({' UNION ALL '.join(f"SELECT '{k}' AS label, len(regexp_extract_all(coalesce(text, ''), '{p}')) AS n FROM documents" for k, p in _RULES.items())})
SELECT label, count(*) FILTER (n > 0) AS texts, CAST(sum(n) AS BIGINT) AS entities, round(avg(n), 6) AS per_text FROM c GROUP BY label""")
def deid_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.report(Tables(spark, sf_dir).documents(), "doc_id", "text").withColumn("per_text", F.round("per_text", 6))


@query(f"""WITH d AS (SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL ORDER BY md5('42|' || doc_id), doc_id LIMIT 100),
c AS ({' UNION ALL '.join(f"SELECT '{k}' AS label, len(regexp_extract_all(coalesce(text, ''), '{p}')) AS n FROM d" for k, p in _RULES.items())})
SELECT label, count(*) FILTER (n > 0) AS texts, CAST(sum(n) AS BIGINT) AS entities, round(avg(n), 6) AS per_text FROM c GROUP BY label""")
def deid_report_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over a hundred documents, drawn by a hash."""
    return N.report(Tables(spark, sf_dir).documents().where("doc_id is not null"), "doc_id", "text", sample=100).withColumn("per_text", F.round("per_text", 6))
