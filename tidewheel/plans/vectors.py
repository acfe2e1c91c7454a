"""Queries: slices, extractors, assembled vectors."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.times import FORMS, age_at, ntz, parsed, plus, stamp
from tidewheel.operators import features as X
from tidewheel.operators.extractors import EXTRACTORS, long_rows, vectors
from tidewheel.operators.slicing import client_windows, control_windows, decode_one_hot, events_in_client_slices, events_in_slices, in_window, individual_slices, one_hot, slice_table
from tidewheel.plans.registry import query
from tidewheel.sources.stand_ins import DAILY, HALF_YEARS, Tables, with_tables
from tidewheel.spec import RunSpec, Span

AS_OF = datetime(2024, 2, 1)
_IN_DAYS = "JOIN days ON ts >= slice_start AND ts < slice_start + INTERVAL 2 DAY"
_IN_HALVES = "JOIN halves ON ts >= slice_start AND ts < CAST(slice_start + INTERVAL 6 MONTH AS DATE) + INTERVAL 1 DAY"
_KEYS = "client_id, strftime(slice_start, '%Y-%m-%d') AS slice_start"


def shown(features: DataFrame) -> DataFrame:
    """Dates as text and values to six places, as the SQL has them."""
    return features.select("client_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"), "feature", F.round(F.col("value").cast("double"), 6).alias("value"))


def long_part(inner: str, pairs: dict[str, str], name: str = "'{}'") -> str:
    """inner: a grouped query; pairs: feature -> value. Rows (client_id, slice_start, feature, value)."""
    names = ", ".join(name.format(k) for k in pairs)
    values = ", ".join(f"CAST({v} AS DOUBLE)" for v in pairs.values())
    return f"SELECT client_id, slice_start, feature, value FROM (SELECT client_id, slice_start, unnest([{names}]) AS feature, unnest([{values}]) AS value FROM ({inner})) WHERE value IS NOT NULL"


def long_sql(tables: str, inner: str, pairs: dict[str, str], name: str = "'{}'") -> str:
    return with_tables(tables, f"SELECT {_KEYS}, feature, round(value, 6) AS value FROM ({long_part(inner, pairs, name)})")


def floor_days(later: str, earlier: str) -> str:
    return f"floor(epoch_us({later}) / 86400000000.0 - epoch_us({earlier}) / 86400000000.0)"


def floor_exact(later: str, earlier: str) -> str:
    return f"floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0)"


_BLOODS_INNER = f"""SELECT client_id, slice_start, item, count(value) AS n, avg(value) AS mean, arg_max(value, (ts, value)) AS recent, arg_min(value, (ts, value)) AS earliest,
 max(ts) AS last, min(ts) AS first, quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std, min(value) AS low, max(value) AS high,
 list_aggregate(list(value), 'histogram') AS h FROM obs {_IN_DAYS} WHERE value IS NOT NULL GROUP BY ALL"""
_MODE = "list_min(list_transform(list_filter(map_entries(h), lambda e: e.value = list_max(map_values(h))), lambda e: e.key))"
_BLOODS = {
    "mean": "mean", "most-recent": "CASE WHEN n >= 2 THEN recent END", "earliest-test": "CASE WHEN n >= 2 THEN earliest END",
    "days-since-last-test": f"CASE WHEN n >= 2 THEN {floor_exact("TIMESTAMP '2024-02-01'", 'last')} END", "num-tests": "CASE WHEN n >= 2 THEN n END",
    "median": "CASE WHEN n >= 3 THEN median END", "mode": f"CASE WHEN n >= 3 THEN {_MODE} END", "std": "CASE WHEN n >= 3 THEN std END", "min": "CASE WHEN n >= 3 THEN low END",
    "max": "CASE WHEN n >= 3 THEN high END", "contains-extreme-low": "CASE WHEN n >= 3 THEN CAST(low < mean - 3 * std AS INTEGER) END",
    "contains-extreme-high": "CASE WHEN n >= 3 THEN CAST(high > mean + 3 * std AS INTEGER) END", "days-between-first-last": f"CASE WHEN n >= 3 THEN {floor_exact('last', 'first')} END",
}


def bloods_of(t: Tables, spec: RunSpec = DAILY) -> DataFrame:
    return X.bloods(events_in_slices(t.obs(), spec), spec.as_of)


@query(long_sql("obs days", _BLOODS_INNER, _BLOODS, "item || '_{}'"))
def feat_bloods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(bloods_of(Tables(spark, sf_dir)))


def _orders_part(kind: str, name: str, rows: str = f"ords {_IN_HALVES}") -> str:
    inner = f"SELECT client_id, slice_start, item, count(*) AS n, max(ts) AS last, min(ts) AS first FROM {rows} WHERE kind = '{kind}' GROUP BY ALL"
    return long_part(inner, {f"num-{name}-order": "n", f"days-since-last-{name}-order": floor_exact("TIMESTAMP '2024-02-01'", "last"), f"days-between-first-last-{name}": f"CASE WHEN n >= 2 THEN {floor_exact('last', 'first')} END"}, "item || '_{}'")


def _orders_sql(kind: str, name: str) -> str:
    return with_tables("ords halves", f"SELECT {_KEYS}, feature, round(value, 6) AS value FROM ({_orders_part(kind, name)})")


@query(_orders_sql("medication", "drug"))
def feat_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.drugs(events_in_slices(Tables(spark, sf_dir).orders().where("kind = 'medication'"), HALF_YEARS), AS_OF))


@query(_orders_sql("diagnostic", "diagnostic"))
def feat_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.diagnostics(events_in_slices(Tables(spark, sf_dir).orders().where("kind = 'diagnostic'"), HALF_YEARS), AS_OF))


def _stats(column: str, name: str, more: tuple[str, ...] = ("max", "min")) -> str:
    own = {"mean": f"avg({column})", "median": f"quantile_cont({column}, 0.5)", "std": f"stddev_samp({column})", "max": f"max({column})", "min": f"min({column})", "n": f"nullif(count({column}), 0)"}
    return ", ".join(f"{own[s]} AS {name}_{s}" for s in ("mean", "median", "std", *more))


_BMI_ITEMS = {"bmi": "purchase", "height": "view", "weight": "click"}
_BODY_PAIRS = {f"bmi_{s}": f"bmi_{s}" for s in ("mean", "median", "std", "max", "min")} | {"bmi_high": "CAST(bmi_median > 24.9 AS INTEGER)", "bmi_low": "CAST(bmi_median < 18.5 AS INTEGER)", "bmi_extreme": "CAST(bmi_median > 30 AS INTEGER)"}
_BODY_PAIRS |= {f"{k}_{s}": f"CASE WHEN bmi_mean IS NOT NULL THEN {k}_{s} END" for k, ss in (("height", ("mean", "median", "std")), ("weight", ("mean", "median", "std", "max", "min"))) for s in ss}


def _body_inner(rows: str, bmi: str, height: str, weight: str) -> str:
    return f"""SELECT client_id, slice_start, {_stats('b', 'bmi')}, {_stats('h', 'height', ())}, {_stats('w', 'weight')}
FROM (SELECT *, CASE WHEN item = '{bmi}' AND value > 6 AND value < 200 THEN value END AS b, CASE WHEN item = '{height}' AND value > 30 AND value < 300 THEN value END AS h,
 CASE WHEN item = '{weight}' AND value > 1 AND value < 800 THEN value END AS w FROM {rows}) {_IN_DAYS} WHERE item IN ('{bmi}', '{height}', '{weight}') GROUP BY ALL"""


@query(long_sql("obs days", _body_inner("obs", "purchase", "view", "click"), _BODY_PAIRS))
def feat_bmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.body(events_in_slices(Tables(spark, sf_dir).obs(), DAILY), _BMI_ITEMS))


_NAMES = """(VALUES ('NEWS2_Score', 'news_score'), ('NEWS_Systolic_BP', 'news_systolic_bp'), ('NEWS_Diastolic_BP', 'news_diastolic_bp'), ('NEWS_Respiration_Rate', 'news_respiration_rate'),
 ('NEWS_Heart_Rate', 'news_heart_rate'), ('NEWS_Oxygen_Saturation', 'news_oxygen_saturation'), ('NEWS Temperature', 'news_temperature'), ('NEWS_AVPU', 'news_avpu'),
 ('NEWS_Supplemental_Oxygen', 'news_supplemental_oxygen'), ('NEWS2_Sp02_Target', 'news_sp02_target'), ('NEWS2_Sp02_Scale', 'news_sp02_scale'), ('NEWS_Pulse_Type', 'news_pulse_type'),
 ('NEWS_Pain_Score', 'news_pain_score'), ('NEWS Oxygen Litres', 'news_oxygen_litres'), ('NEWS Oxygen Delivery', 'news_oxygen_delivery')) AS names(item, name)"""
_NEWS_PART = long_part(f"SELECT client_id, slice_start, name, {_stats('value', 's', ('max', 'min', 'n'))} FROM (SELECT client_id, ts, name, value FROM ward JOIN {_NAMES} USING (item)) {_IN_DAYS} WHERE name <> 'news_score' OR (value > -20 AND value < 20) GROUP BY ALL", {s: f"s_{s}" for s in ("mean", "median", "std", "max", "min", "n")}, "name || '_{}'")


@query(with_tables("ward days", f"SELECT {_KEYS}, feature, round(value, 6) AS value FROM ({_NEWS_PART})"))
def feat_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(EXTRACTORS["news"].rows(Tables(spark, sf_dir).observations(), DAILY))


def _texts(t: Tables) -> DataFrame:
    """Observations whose text is the JSON payload."""
    return events_in_slices(t.raw("events").select(F.col("user_id").cast("string").alias("client_id"), ntz("ts").alias("ts"), F.col("event_type").alias("item"), F.col("event_type").alias("text")), DAILY)


_TEXTS = f"(SELECT CAST(user_id AS VARCHAR) AS client_id, ts, event_type AS item, event_type AS text FROM events) {_IN_DAYS}"


@query(long_sql("days", f"SELECT client_id, slice_start, {_stats('v', 'vte', ('max', 'min', 'n'))} FROM (SELECT *, CASE text WHEN 'purchase' THEN 1.0 WHEN 'view' THEN 0.0 END AS v FROM {_TEXTS}) WHERE v IS NOT NULL GROUP BY ALL", {f"vte_{s}": f"vte_{s}" for s in ("mean", "median", "std", "max", "min", "n")}))
def feat_vte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.mapped_status(_texts(Tables(spark, sf_dir)), {"purchase": 1, "view": 0}, "vte"))


def _flags_sql(parts: dict[str, str], low: bool) -> str:
    inner = ", ".join(f"max(CAST(contains({'lower(text)' if low else 'text'}, '{p}') AS INTEGER)) AS f{i}" for i, p in enumerate(parts.values()))
    return long_sql("days", f"SELECT client_id, slice_start, {inner} FROM {_TEXTS} GROUP BY ALL", {k: f"f{i}" for i, k in enumerate(parts)})


@query(_flags_sql({"smoking_current": "purch", "smoking_non": "view"}, True))
def feat_smoking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.flags(_texts(Tables(spark, sf_dir)), {"smoking_current": "Purch", "smoking_non": "view"}))


@query(_flags_sql({"site_dh": "cli", "site_ph": "add"}, False))
def feat_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.flags(_texts(Tables(spark, sf_dir)), {"site_dh": "cli", "site_ph": "add"}, ignore_case=False))


@query(long_sql("days", f"SELECT client_id, slice_start, count(*) FILTER (text = 'purchase') AS a, count(*) FILTER (text = 'click') AS b FROM {_TEXTS} GROUP BY ALL", {"resus_full": "a", "resus_not": "b"}))
def feat_resus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.value_counts(_texts(Tables(spark, sf_dir)), {"resus_full": "purchase", "resus_not": "click"}))


@query(with_tables("days", f"SELECT DISTINCT {_KEYS}, 'sat_' || replace(replace(text, '-', '_'), '%', 'pct') AS feature, 1.0::DOUBLE AS value FROM {_TEXTS}"))
def feat_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.presence(_texts(Tables(spark, sf_dir)), "sat_", clean=True))


@query(with_tables("days", f"SELECT DISTINCT {_KEYS}, 'bed_' || text AS feature, 1.0::DOUBLE AS value FROM {_TEXTS}"))
def feat_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.presence(_texts(Tables(spark, sf_dir)), "bed_"))


_COVID = "CASE text WHEN 'purchase' THEN 'SARS POSITIVE' WHEN 'view' THEN 'negative' ELSE text END"


@query(long_sql("days", f"SELECT client_id, slice_start, bool_or(contains(lower(x), 'positive')) AS yes, bool_or(contains(lower(x), 'negative')) AS no FROM (SELECT *, {_COVID} AS x FROM {_TEXTS}) GROUP BY ALL", {"covid": "CASE WHEN yes THEN 1 WHEN no THEN 0 END"}))
def feat_covid(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("text") == "purchase", "SARS POSITIVE").when(F.col("text") == "view", "negative").otherwise(F.col("text"))
    return shown(X.positive(_texts(Tables(spark, sf_dir)).withColumn("text", said), "covid"))


@query(with_tables("appts halves", f""", s AS (SELECT * FROM appts {_IN_HALVES} WHERE attended)
SELECT {_KEYS}, feature, CAST(count(*) AS DOUBLE) AS value FROM (SELECT client_id, slice_start, unnest(['consultant_' || consultant, 'clinic_' || clinic, 'type_' || kind]) AS feature FROM s) GROUP BY ALL"""))
def feat_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.appointments(events_in_slices(Tables(spark, sf_dir).appointments(), HALF_YEARS), {"consultant": "consultant_", "clinic": "clinic_", "kind": "type_"}))


#: The census rules written out once more, for the SQL: groups in the order in which a later one overrides, then single words.
_WHITE = "['english', 'welsh', 'scottish', 'northern', 'irish', 'british', 'gypsy', 'irish traveller', 'any other white background', 'white', 'caucasian', 'traveller', 'other white', 'white other']"
_ASIAN = "['asian', 'chinese', 'pakistani', 'bangladeshi', 'indian']"
_BLACK = "['black', 'african', 'caribbean', 'black british', 'black african', 'black carribean']"
_OTHERS = "['arab', 'not specified']"
_MIXED = "['mixed', 'multiple', 'biracial', 'multiracial', 'white and asian', 'white and black', 'white and hispanic', 'black and white', 'asian and white', 'hispanic and white']"
_GROUPS = {"white": _WHITE, "asian_or_asian_british": _ASIAN, "black_african_caribbean_or_black_british": _BLACK, "other_ethnic_group": _OTHERS, "mixed_or_multiple_ethnic_groups": _MIXED}


def _census_sql(column: str) -> str:
    """The last rule that holds is tried first."""
    last = {"mix": "mixed_or_multiple_ethnic_groups", "asian": "asian_or_asian_british", "white": "white", "black": "black_african_caribbean_or_black_british", "other": "other_ethnic_group"}
    rules = [(g, f"contains(e, '{w}')") for w, g in last.items()] + [(g, f"len(list_filter({words}, lambda w: contains(e, w))) > 0") for g, words in reversed(_GROUPS.items())]
    foreign = {g: " OR ".join(f"(list_contains({o}, e) AND NOT list_contains({own}, e))" for h, o in _GROUPS.items() if h != g) for g, own in _GROUPS.items()}
    return f"(SELECT CASE {' '.join(f"WHEN {held} AND NOT ({foreign[g]}) THEN '{g}'" for g, held in rules)} ELSE 'other_ethnic_group' END FROM (SELECT lower(coalesce({column}, 'other_ethnic_group')) AS e))"


_AGE = "date_part('year', ts) - date_part('year', born) - CASE WHEN strftime(ts, '%m%d') >= strftime(born, '%m%d') THEN 0 ELSE 1 END"
_FILL = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY ts, record_id ROWS UNBOUNDED PRECEDING) AS {c}" for c in ("gender", "racecode", "born", "died"))


def _demo_part(table: str, where: str) -> str:
    inner = f"""SELECT *, {_census_sql('racecode')} AS census FROM (SELECT *, row_number() OVER (PARTITION BY client_id, slice_start ORDER BY ts DESC, record_id DESC) AS r
FROM (SELECT client_id, ts, record_id, {_FILL} FROM {table}) {where}) WHERE r = 1"""
    pairs = {"male": "CASE lower(gender) WHEN 'male' THEN 1 WHEN 'female' THEN 0 END", "age": _AGE, "dead": "CAST(died IS NOT NULL AS INTEGER)"}
    return long_part(inner, pairs | {f"census_{g}": f"CASE WHEN racecode IS NOT NULL THEN CAST(census = '{g}' AS INTEGER) END" for g in _GROUPS})


@query(with_tables("demo halves", f"SELECT {_KEYS}, feature, round(value, 6) AS value FROM ({_demo_part('demo', _IN_HALVES)})"))
def feat_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.demographics(Tables(spark, sf_dir).demographics(), lambda r: events_in_slices(r, HALF_YEARS), HALF_YEARS.first, X.census_group, tuple(X.CENSUS)))


_FILL_SIX = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY ts, record_id ROWS UNBOUNDED PRECEDING) AS {c}" for c in X.FIELDS)


@query(with_tables("demo halves", f"""SELECT {_KEYS}, first_name, last_name, strftime(born, '%Y-%m-%d') AS born, gender, racecode, strftime(died, '%Y-%m-%d') AS died FROM (SELECT *, row_number() OVER (PARTITION BY client_id, slice_start ORDER BY ts DESC, record_id DESC) AS r
FROM (SELECT client_id, ts, record_id, {_FILL_SIX} FROM demo) {_IN_HALVES}) WHERE r = 1"""))
def demographics_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six fields, filled forward, of each client and half-year."""
    own = X.latest_records(Tables(spark, sf_dir).demographics(), lambda r: events_in_slices(r, HALF_YEARS), HALF_YEARS.first)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return own.select("client_id", day("slice_start"), "first_name", "last_name", day("born"), "gender", "racecode", day("died"))


#: Countries and nationalities that a user's table adds to the census words; the last is in no group.
_MORE_WORDS = [("white", "germany"), ("white", "France"), ("asian_or_asian_british", "japan"), ("black_african_caribbean_or_black_british", "ethiopia"), ("other_ethnic_group", "egypt")]


@query("""SELECT n_name AS entry, CASE WHEN contains(e, 'indian') OR contains(e, 'chinese') THEN 'asian_or_asian_british' WHEN contains(e, 'germany') OR contains(e, 'france') THEN 'white' WHEN contains(e, 'japan') THEN 'asian_or_asian_british'
WHEN contains(e, 'ethiopia') THEN 'black_african_caribbean_or_black_british' ELSE 'other_ethnic_group' END AS census, count(c_custkey) AS n FROM (SELECT *, lower(n_name) AS e FROM nation) LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def ethnicity_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations to census groups, with a table of countries beside the fixed words."""
    t = Tables(spark, sf_dir)
    more = X.census_words(spark.createDataFrame(_MORE_WORDS, "census string, word string"))
    counts = t.raw("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    n = t.raw("nation").join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return n.select(F.col("n_name").alias("entry"), X.census_group(F.col("n_name"), more).alias("census"), F.coalesce("n", F.lit(0)).alias("n"))


@query(f"SELECT n_name || ' ' || c_mktsegment AS entry, {_census_sql("n_name || ' ' || c_mktsegment")} AS census, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def ethnicity_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    c, n = t.raw("customer"), t.raw("nation")
    entry = F.concat_ws(" ", "n_name", "c_mktsegment")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).groupBy(entry.alias("entry")).agg(F.count("*").alias("n")).select("entry", X.census_group(F.col("entry")).alias("census"), "n")


@query(with_tables("demo", f"SELECT record_id, CAST({_AGE} AS BIGINT) AS age, CAST(floor(date_diff('day', born, CAST(ts AS DATE)) / 365) AS BIGINT) AS coarse FROM demo WHERE born IS NOT NULL"))
def age_at_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).demographics().where("born is not null")
    return d.select("record_id", age_at(F.col("born"), F.col("ts")).cast("long").alias("age"), F.floor(F.datediff(F.col("ts").cast("date"), "born") / 365).alias("coarse"))


@query(with_tables("demo", f"SELECT client_id, CAST({_AGE.replace('ts', 'now')} AS BIGINT) AS age FROM (SELECT client_id, max(born) AS born, TIMESTAMP '2024-02-01' AS now FROM demo GROUP BY client_id) WHERE born IS NOT NULL"))
def age_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).demographics().groupBy("client_id").agg(F.max("born").alias("born")).where("born is not null")
    return d.select("client_id", age_at(F.col("born"), F.lit(AS_OF).cast("timestamp_ntz")).cast("long").alias("age"))


def concepts_of(t: Tables) -> DataFrame:
    """Of all four kinds of documents."""
    return X.assemble(long_rows(t.annotated(), DAILY, dict.fromkeys(("annotations", "annotations_mrc", "annotations_reports", "textual_obs"), True)))


_ALL_ANNS = " UNION ALL ".join(f"SELECT client_id, ts, pretty_name FROM {a}" for a in ("anns", "note_anns", "report_anns", "tobs_anns"))
_CONCEPTS = f"SELECT client_id, slice_start, pretty_name AS feature, CAST(count(*) AS DOUBLE) AS value FROM ({_ALL_ANNS}) {_IN_DAYS} GROUP BY ALL"


@query(with_tables("anns note_anns report_anns tobs_anns days", f"SELECT {_KEYS}, feature, value FROM ({_CONCEPTS})"))
def feat_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(concepts_of(Tables(spark, sf_dir)))


@query(with_tables("obs days", f""", f AS (SELECT DISTINCT client_id, slice_start, 'sat_' || item AS feature FROM obs {_IN_DAYS}),
frame AS (SELECT DISTINCT client_id, slice_start FROM (SELECT DISTINCT client_id FROM obs), days)
SELECT {_KEYS.replace('client_id', 'frame.client_id', 1).replace('(slice_start', '(frame.slice_start')}, n.feature, CASE WHEN f.feature IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS value
FROM frame CROSS JOIN (SELECT unnest(['sat_view', 'sat_click', 'sat_purchase']) AS feature) n LEFT JOIN f ON f.client_id = frame.client_id AND f.slice_start = frame.slice_start AND f.feature = n.feature"""))
def negate_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    frame = t.obs().select("client_id").distinct().withColumn("slice_start", F.explode(F.lit(DAILY.starts())))
    names = ["sat_view", "sat_click", "sat_purchase"]
    return shown(X.with_missing(X.presence(_texts(t), "sat_"), frame, names, 0.0))


#: All extractors, as options.
ALL = dict.fromkeys(EXTRACTORS, True)
_TABLES = "obs ward ords29 appts29 demo29 anns note_anns report_anns tobs_anns days"


def _ward_flags(item: str, parts: dict[str, str]) -> str:
    inner = ", ".join(f"max(CAST(contains(text, '{p}') AS INTEGER)) AS f{i}" for i, p in enumerate(parts.values()))
    return long_part(f"SELECT client_id, slice_start, {inner} FROM ward {_IN_DAYS} WHERE item = '{item}' GROUP BY ALL", {k: f"f{i}" for i, k in enumerate(parts)})


def _ward_texts(item: str, feature: str) -> str:
    return f"SELECT DISTINCT client_id, slice_start, {feature} AS feature, 1.0::DOUBLE AS value FROM ward {_IN_DAYS} WHERE item = '{item}'"


_FOR, _NOT = "For cardiopulmonary resuscitation", "Not for cardiopulmonary resuscitation"
_RUN = {
    "demo": _demo_part("demo29", _IN_DAYS),
    "bmi": long_part(_body_inner("ward", "OBS BMI Calculation", "OBS Height", "OBS Weight"), _BODY_PAIRS),
    "bloods": long_part(_BLOODS_INNER, _BLOODS, "item || '_{}'"),
    "drugs": _orders_part("medication", "drug", f"ords29 {_IN_DAYS}"),
    "diagnostics": _orders_part("diagnostic", "diagnostic", f"ords29 {_IN_DAYS}"),
    "core_02": _ward_texts("CORE_SpO2", "'core_02_' || replace(replace(text, '-', '_'), '%', 'pct')"),
    "bed": _ward_texts("CORE_BedNumber3", "'bed_' || text"),
    "vte_status": long_part(f"SELECT client_id, slice_start, {_stats('v', 'vte_status', ('max', 'min', 'n'))} FROM (SELECT *, CASE text WHEN 'High risk of VTE High risk of bleeding' THEN 1.0 WHEN 'High risk of VTE Low risk of bleeding' THEN 0.0 END AS v FROM ward WHERE item = 'CORE_VTE_STATUS') {_IN_DAYS} WHERE v IS NOT NULL GROUP BY ALL", {f"vte_status_{s}": f"vte_status_{s}" for s in ("mean", "median", "std", "max", "min", "n")}),
    "hosp_site": _ward_flags("CORE_HospitalSite", {"hosp_site_dh": "DH", "hosp_site_ph": "PRUH"}),
    "core_resus": long_part(f"SELECT client_id, slice_start, count(*) FILTER (text = '{_FOR}') AS a, count(*) FILTER (text = '{_NOT}') AS b FROM ward {_IN_DAYS} WHERE item = 'CORE_RESUS_STATUS' GROUP BY ALL", {f"core_resus_status_{_FOR}": "a", f"core_resus_status_{_NOT}": "b"}),
    "news": _NEWS_PART,
    "smoking": _ward_flags("CORE_SmokingStatus", {"smoking_status_current": "Current Smoker", "smoking_status_non": "Non-Smoker"}),
    "covid": long_part(f"SELECT client_id, slice_start, bool_or(item = 'purchase') AS yes, bool_or(item = 'view') AS no FROM obs {_IN_DAYS} GROUP BY ALL", {"covid_positive": "CASE WHEN yes THEN 1 WHEN no THEN 0 END"}),
    "appointments": f"SELECT client_id, slice_start, feature, CAST(count(*) AS DOUBLE) AS value FROM (SELECT client_id, slice_start, unnest(['ConsultantCode_' || consultant, 'ClinicCode_' || clinic, 'AppointmentType_' || kind]) AS feature FROM appts29 {_IN_DAYS} WHERE attended) GROUP BY ALL",
    "concepts": _CONCEPTS,
}
_ASSEMBLED = f"SELECT client_id, slice_start, feature, sum(value) AS value FROM ({' UNION ALL '.join(f'({p})' for p in _RUN.values())}) GROUP BY ALL"


@query(with_tables(_TABLES, f"SELECT {_KEYS}, feature, round(value, 6) AS value FROM ({_ASSEMBLED})"))
def assemble_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(X.assemble(long_rows(Tables(spark, sf_dir).sources(), DAILY, ALL)))


def run_of(t: Tables) -> DataFrame:
    """Every client and slice with its map of features; an empty vector where nothing happened."""
    clients = t.obs().select("client_id").unionByName(t.documents().select("client_id"))
    return vectors(t.sources(), DAILY, ALL, clients)


@query(with_tables(_TABLES, f""", v AS (SELECT client_id, slice_start, count(*) AS n, sum(value) AS total FROM ({_ASSEMBLED}) GROUP BY ALL),
frame AS (SELECT * FROM (SELECT client_id FROM obs UNION SELECT client_id FROM docs), days)
SELECT {_KEYS}, coalesce(n, 0) AS features, round(coalesce(total, 0), 4) AS total FROM frame LEFT JOIN v USING (client_id, slice_start)"""))
def run_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_of(Tables(spark, sf_dir))
    values = F.map_values("features")
    return out.select("client_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"), F.size(values).cast("long").alias("features"), F.round(F.aggregate(values, F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


# --- slices -----------------------------------------------------------------------------------------


@query("""WITH w AS (SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-11') SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM w""")
def filter_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).raw("events")
    return e.where(in_window(ntz("ts"), date(2024, 1, 10), date(2024, 1, 5))).select("event_id", stamp(ntz("ts")).alias("ts"))


@query(with_tables("obs days", f"SELECT strftime(slice_start, '%Y-%m-%d') AS slice_start, strftime(slice_start + INTERVAL 1 DAY, '%Y-%m-%d') AS slice_end, count(obs_id) AS n FROM days LEFT JOIN obs ON ts >= slice_start AND ts < slice_start + INTERVAL 2 DAY GROUP BY ALL"))
def slice_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = events_in_slices(Tables(spark, sf_dir).obs(), DAILY).groupBy("slice_start").agg(F.count("*").alias("n"))
    d = slice_table(spark, DAILY).join(n, "slice_start", "left")
    return d.select(F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"), F.date_format("slice_end", "yyyy-MM-dd").alias("slice_end"), F.coalesce("n", F.lit(0)).alias("n"))


#: The date forms once more, for the SQL.
_SQL_FORMS = """['%d/%m/%y %H.%M.%S', '%d/%m/%Y %H.%M.%S', '%m/%d/%y %H.%M.%S', '%m/%d/%Y %H.%M.%S', '%d/%m/%y %H:%M:%S', '%d/%m/%Y %H:%M:%S', '%m/%d/%y %H:%M:%S', '%m/%d/%Y %H:%M:%S',
 '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H.%M.%S', '%d-%m-%Y %H:%M:%S', '%d-%m-%Y %H.%M.%S', '%Y/%m/%d %H:%M:%S', '%Y/%m/%d %H.%M.%S', '%d/%m/%y', '%m/%d/%y', '%d/%m/%Y', '%m/%d/%Y',
 '%Y-%m-%d', '%Y/%m/%d', '%d-%m-%Y', '%d.%m.%Y', '%d.%m.%y', '%Y.%m.%d']"""
#: DuckDB's %Y takes two digits, too, so that it must come after %y there.
_SQL_READ = _SQL_FORMS.replace("'%d.%m.%Y', '%d.%m.%y'", "'%d.%m.%y', '%d.%m.%Y'")


@query(f"""WITH w AS (SELECT event_id, CASE event_id % 26 {' '.join(f"WHEN {i} THEN strftime(ts + to_days(CAST(event_id % 97 AS INTEGER)), {_SQL_FORMS}[{i + 1}])" for i in range(24))} WHEN 24 THEN 'nan' ELSE '31/02/2024' END AS said FROM events)
SELECT event_id, said, strftime(t, '%Y-%m-%d %H:%M:%S') AS ts, strftime(t + INTERVAL 3 MONTH, '%Y-%m-%d %H:%M:%S') AS shifted FROM (SELECT *, try_strptime(said, {_SQL_READ}) AS t FROM w)""")
def add_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written in every form, then read back: the first form that fits, which is not always the one written."""
    e, t = Tables(spark, sf_dir).raw("events"), ntz("ts") + F.make_interval(days=(F.col("event_id") % 97).cast("int"))
    n, said = F.col("event_id") % 26, F.when(F.col("event_id") % 26 == 24, "nan")
    for i, form in enumerate(FORMS):
        said = said.when(n == i, stamp(t, re.sub("[dMHms]", lambda m: m[0] * 2, form)))
    rows = e.select("event_id", said.otherwise("31/02/2024").alias("said")).withColumn("t", parsed(F.col("said")))
    return rows.select("event_id", "said", stamp(F.col("t")).alias("ts"), stamp(plus(F.col("t"), months=3)).alias("shifted"))


_WINDOWS = "SELECT client_id, arg_max(ts, order_id) AS win_from, arg_max(ts, order_id) + INTERVAL 1 YEAR AS win_to FROM ords GROUP BY client_id"


def _windows(t: Tables) -> DataFrame:
    return client_windows(t.orders(), "client_id", "ts", "order_id")


@query(with_tables("ords", f"SELECT client_id, strftime(win_from, '%Y-%m-%d') AS win_from, strftime(win_to, '%Y-%m-%d') AS win_to FROM ({_WINDOWS})"), name="client_windows")
def client_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(Tables(spark, sf_dir)).select("client_id", stamp(F.col("win_from"), "yyyy-MM-dd").alias("win_from"), stamp(F.col("win_to"), "yyyy-MM-dd").alias("win_to"))


_QUARTERS = RunSpec(start=date(1995, 1, 1), span=Span(years=10), step=Span(days=91))


@query(with_tables("ords", f""", w AS ({_WINDOWS}),
s AS (SELECT client_id, CAST(unnest(generate_series(CAST(win_from AS DATE), CAST(win_to AS DATE), INTERVAL 91 DAY)) AS DATE) AS d FROM w)
SELECT client_id, strftime(d, '%Y-%m-%d') AS slice_start, strftime(d + 91, '%Y-%m-%d') AS slice_end FROM s"""), name="individual_slices")
def individual_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = individual_slices(_windows(Tables(spark, sf_dir)), _QUARTERS)
    return s.select("client_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"), F.date_format("slice_end", "yyyy-MM-dd").alias("slice_end"))


_BACK = RunSpec(start=date(1995, 1, 1), span=Span(days=400), step=Span(days=50), lookback=True)


@query(with_tables("ords", f""", w AS ({_WINDOWS}),
s AS (SELECT client_id, CAST(unnest(generate_series(CAST(greatest(CAST(win_to AS DATE) - 400, DATE '1995-01-01') AS TIMESTAMP), CAST(CAST(win_to AS DATE) AS TIMESTAMP), INTERVAL 50 DAY)) AS DATE) AS d FROM w)
SELECT client_id, strftime(d, '%Y-%m-%d') AS slice_start, strftime(d + 50, '%Y-%m-%d') AS slice_end FROM s"""), name="individual_slices_back")
def individual_slice_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that look back from the end of each client's window."""
    s = individual_slices(_windows(Tables(spark, sf_dir)), _BACK)
    return s.select("client_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"), F.date_format("slice_end", "yyyy-MM-dd").alias("slice_end"))


@query(with_tables("obs days", f"SELECT obs_id, strftime(slice_start, '%Y-%m-%d') AS slice_start FROM obs {_IN_DAYS}"), name="events_in_slices")
def events_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_in_slices(Tables(spark, sf_dir).obs(), DAILY).select("obs_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start"))


@query(with_tables("ords appts", f""", w AS ({_WINDOWS}),
s AS (SELECT client_id, CAST(unnest(generate_series(CAST(win_from AS DATE), CAST(win_to AS DATE), INTERVAL 91 DAY)) AS DATE) AS d FROM w)
SELECT client_id, strftime(d, '%Y-%m-%d') AS slice_start, count(*) AS n FROM s JOIN appts USING (client_id) WHERE ts >= d AND ts < d + INTERVAL 92 DAY GROUP BY ALL"""), name="events_in_client_slices")
def events_client_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    found = events_in_client_slices(t.appointments(), individual_slices(_windows(t), _QUARTERS))
    return found.groupBy("client_id", F.date_format("slice_start", "yyyy-MM-dd").alias("slice_start")).agg(F.count("*").alias("n"))


@query(with_tables("ords", """, w AS (SELECT client_id, arg_max(ts, order_id) AS win_from FROM ords WHERE item = '1-URGENT' GROUP BY client_id),
k AS (SELECT win_from, row_number() OVER (ORDER BY md5('42|' || client_id)) - 1 AS number FROM w)
SELECT c.client_id, strftime(win_from, '%Y-%m-%d') AS win_from FROM (SELECT CAST(c_custkey AS VARCHAR) AS client_id FROM customer) c JOIN k ON CAST('0x' || substr(md5('43|' || c.client_id), 1, 15) AS BIGINT) % (SELECT count(*) FROM w) = number
WHERE c.client_id NOT IN (SELECT client_id FROM w)"""), name="control_windows")
def control_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    treated = client_windows(t.orders().where("item = '1-URGENT'"), "client_id", "ts", "order_id")
    everyone = t.raw("customer").select(F.col("c_custkey").cast("string").alias("client_id"))
    return control_windows(everyone.join(treated.select("client_id"), "client_id", "left_anti"), treated).select("client_id", stamp(F.col("win_from"), "yyyy-MM-dd").alias("win_from"))


_WEEK = RunSpec(start=date(2024, 1, 1), span=Span(days=6))


@query(with_tables("obs days", f"SELECT DISTINCT {_KEYS}, " + ", ".join(f"CAST(slice_start = DATE '{d}' AS INTEGER) AS d_{d:%Y_%m_%d}" for d in _WEEK.starts()) + f" FROM obs {_IN_DAYS} WHERE slice_start < DATE '2024-01-08'"))
def slice_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events_in_slices(Tables(spark, sf_dir).obs(), _WEEK).select("client_id", "slice_start").distinct()
    return one_hot(own, _WEEK).withColumn("slice_start", F.date_format("slice_start", "yyyy-MM-dd"))


@query(with_tables("obs days", f"SELECT DISTINCT {_KEYS} FROM obs {_IN_DAYS} WHERE slice_start < DATE '2024-01-08'"), name="decode_one_hot")
def decode_one_hots(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events_in_slices(Tables(spark, sf_dir).obs(), _WEEK).select("client_id", "slice_start").distinct()
    return decode_one_hot(one_hot(own, _WEEK).drop("slice_start")).withColumn("slice_start", F.date_format("slice_start", "yyyy-MM-dd"))
