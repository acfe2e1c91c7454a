
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.times import ntz
from tidewheel.spec import RunSpec, Span

#: The flagship run: daily slices over the events' month.
DAILY = RunSpec(start=date(2024, 1, 1), span=Span(days=29))
#: Items of the ward observations, in turn, and the three texts that some have.
WARD_ITEMS = (
    "NEWS2_Score", "NEWS_Systolic_BP", "NEWS_Diastolic_BP", "NEWS_Respiration_Rate", "NEWS_Heart_Rate", "NEWS_Oxygen_Saturation", "NEWS Temperature", "NEWS_AVPU",
    "NEWS_Supplemental_Oxygen", "NEWS2_Sp02_Target", "NEWS2_Sp02_Scale", "NEWS_Pulse_Type", "NEWS_Pain_Score", "NEWS Oxygen Litres", "NEWS Oxygen Delivery", "OBS BMI Calculation",
    "OBS Height", "OBS Weight", "CORE_VTE_STATUS", "CORE_SmokingStatus", "CORE_HospitalSite", "CORE_RESUS_STATUS", "CORE_SpO2", "CORE_BedNumber3", "OTHER",
)
WARD_TEXTS = {
    "CORE_VTE_STATUS": ("High risk of VTE High risk of bleeding", "High risk of VTE Low risk of bleeding", "unknown"),
    "CORE_SmokingStatus": ("Current Smoker", "Non-Smoker", "Ex-Smoker"),
    "CORE_HospitalSite": ("DH North", "PRUH", "elsewhere"),
    "CORE_RESUS_STATUS": ("For cardiopulmonary resuscitation", "Not for cardiopulmonary resuscitation", "not known"),
    "CORE_SpO2": ("94-98%", "88-92%", "other"),
    "CORE_BedNumber3": ("bed 1", "bed 2", "bed 3"),
}
#: Order slices: half-years; each ends with the first day of the next.
HALF_YEARS = RunSpec(start=date(1995, 1, 1), span=Span(years=8), step=Span(months=6))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.size: tuple[int, int] | None = None  # the vocabulary's, once it has been asked for

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def obs(self) -> DataFrame:
        """Numeric observations."""
        return self.raw("events").select(F.col("user_id").cast("string").alias("client_id"), ntz("ts").alias("ts"), F.col("event_type").alias("item"), "value", F.col("event_id").alias("obs_id"))

    def observations(self) -> DataFrame:
        """Ward observations: scores, body measurements and statuses in turn, each with a value and a text."""
        e, n = self.raw("events"), F.col("event_id") % len(WARD_ITEMS)
        pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
        turn = F.floor(F.col("event_id") / len(WARD_ITEMS)) % 3
        text = F.lit("none")
        for item, texts in WARD_TEXTS.items():
            text = F.when(F.col("item") == item, pick(texts, turn)).otherwise(text)
        own = e.select(F.col("user_id").cast("string").alias("client_id"), ntz("ts").alias("ts"), pick(WARD_ITEMS, n).alias("item"), "value", "event_id")
        return own.withColumn("text", text)

    def basic(self) -> DataFrame:
        """Laboratory values with a text, which says now and then whether a test was positive."""
        said = F.when(F.col("item") == "purchase", "SARS POSITIVE").when(F.col("item") == "view", "negative").otherwise(F.col("item"))
        return self.obs().withColumn("text", said)

    def sources(self) -> dict[str, DataFrame]:
        """What the extractors read; orders, appointments and demographics 29 years later, in the time of the events."""
        later = lambda df: df.withColumn("ts", ntz(F.col("ts") + F.make_interval(F.lit(29))))
        out = {"basic": self.basic(), "observations": self.observations(), "orders": later(self.orders()), "appointments": later(self.appointments()), "demographics": later(self.demographics())}
        return out | self.annotated()

    def annotated(self) -> dict[str, DataFrame]:
        """The annotations of the four kinds of documents."""
        return {"epr": self.annotations(), "mct": self.annotations(self.notes()), "reports": self.annotations(self.reports()), "textual_obs": self.annotations(self.textual_obs())}

    def orders(self) -> DataFrame:
        o = self.raw("orders")
        kind = F.when(F.col("o_orderstatus") == "F", "diagnostic").otherwise("medication")
        return o.select(F.col("o_custkey").cast("string").alias("client_id"), ntz("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("item"), kind.alias("kind"), F.col("o_orderkey").alias("order_id"))

    def appointments(self) -> DataFrame:
        l, o = self.raw("lineitem"), self.raw("orders").select("o_orderkey", "o_custkey")
        j = l.join(o, l["l_orderkey"] == o["o_orderkey"])
        return j.select(F.col("o_custkey").cast("string").alias("client_id"), ntz("l_shipdate").alias("ts"), (F.col("l_returnflag") != "R").alias("attended"), (F.col("l_suppkey") % 7).alias("consultant"), (F.col("l_partkey") % 5).alias("clinic"), F.col("l_linestatus").alias("kind"))

    def demographics(self) -> DataFrame:
        """Records over time with gaps: names, gender, group, birth and death are each there now and then."""
        o, c, n = self.raw("orders"), self.raw("customer"), self.raw("nation")
        j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
        gender = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female")
        words = F.array(*map(F.lit, ("White British", "Asian - Indian", "Black African", "Mixed: white and asian", "Other", "Not specified")))
        group = F.when(F.col("o_orderkey") % 4 != 0, F.element_at(words, (F.col("c_nationkey") % 6 + 1).cast("int")))
        born = F.when(F.col("o_orderkey") % 5 != 0, F.date_add(F.lit(date(1930, 1, 1)), (F.col("c_custkey") % 20000).cast("int")))
        died = F.when(F.col("o_orderkey") % 97 == 0, ntz("o_orderdate"))
        first = F.when(F.col("o_orderkey") % 6 != 0, F.split_part("c_name", F.lit("#"), F.lit(1)))
        last = F.when(F.col("o_orderkey") % 7 != 0, F.split_part("c_name", F.lit("#"), F.lit(2)))
        return j.select(F.col("c_custkey").cast("string").alias("client_id"), ntz("o_orderdate").alias("ts"), F.col("o_orderkey").alias("record_id"), first.alias("first_name"), last.alias("last_name"), gender.alias("gender"), group.alias("racecode"), born.alias("born"), died.alias("died"))

    def documents(self) -> DataFrame:
        client = F.concat(F.lit("c"), F.col("doc_id") % 50)
        ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=(F.col("doc_id") % 720).cast("int"))
        return self.raw("documents").select("doc_id", client.alias("client_id"), ntz(ts).alias("ts"), "text", F.col("source").alias("description"))

    def notes(self) -> DataFrame:
        ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(days=(F.col("conv_id") % 28).cast("int"), hours=F.col("turn").cast("int"))
        return self.raw("conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("doc_id"), F.concat(F.lit("c"), F.col("conv_id") % 50).alias("client_id"), ntz(ts).alias("ts"), "text", F.col("role").alias("description"))

    def reports(self) -> DataFrame:
        ts = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz") + F.make_interval(days=(F.col("page_id") % 28).cast("int"))
        return self.raw("pages").select(F.col("page_id").alias("doc_id"), F.concat(F.lit("c"), F.col("page_id") % 50).alias("client_id"), ntz(ts).alias("ts"), F.col("html").alias("text"), F.col("url").alias("description"))

    def textual_obs(self, few_labels: bool = False) -> DataFrame:
        """Textual observations: the documents that have a label, at a time of their own. few_labels: they are known to be
        so few that they can be broadcast, and no text is shuffled."""
        d, l = self.raw("documents"), self.raw("labels").select(F.col("doc_id").alias("labelled"), "quality")
        l = F.broadcast(l) if few_labels else l
        ts = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=(F.col("doc_id") % 650).cast("int"))
        j = d.join(l, d["doc_id"] == l["labelled"])
        return j.select("doc_id", F.concat(F.lit("c"), F.col("doc_id") % 50).alias("client_id"), ntz(ts).alias("ts"), "text", F.concat(F.lit("quality "), F.col("quality")).alias("description"))

    def vocabulary(self) -> DataFrame:
        """Words of six letters or more in the benchmark; cui is the word's CRC-32 in a thousand."""
        words = self.raw("benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).where("length(word) >= 6").distinct()
        size = F.length("word")
        return words.select("word", size.cast("long").alias("cui"), F.concat(F.lit("concept "), F.substring("word", 1, 2)).alias("pretty_name"), F.array(F.when(size % 2 == 0, "disorder").otherwise("finding")).alias("types"))

    def annotations(self, docs: DataFrame | None = None) -> DataFrame:
        """Mentions in documents, with confidence and context that follow from their place."""
        from tidewheel.operators.annotations import annotate, size_of

        vocabulary = self.vocabulary()
        self.size = self.size or size_of(vocabulary)
        a = annotate(docs if docs is not None else self.documents(), vocabulary, "doc_id", "text", ("client_id", "ts"), self.size)
        n = F.col("doc_id") * 7 + F.col("position") * 13
        pick = lambda k, *v: F.element_at(F.array(*map(F.lit, v)), (n % k + 1).cast("int"))
        return a.select("client_id", "doc_id", "ts", "position", "word", "cui", "pretty_name", "types", ((n % 100) / 100).alias("acc"), pick(3, "Recent", "Past", "Future").alias("Time_Value"), pick(4, "True", "True", "False", "True").alias("Presence_Value"), pick(5, "Patient", "Patient", "Family", "Patient", "Patient").alias("Subject_Value"), n.alias("tie"))


#: The same tables in SQL, as common table expressions by name; a query takes those it names.
SQL = {
    "obs": "SELECT CAST(user_id AS VARCHAR) AS client_id, ts, event_type AS item, value, event_id AS obs_id FROM events",
    "ords": "SELECT CAST(o_custkey AS VARCHAR) AS client_id, o_orderdate AS ts, o_orderpriority AS item, CASE WHEN o_orderstatus = 'F' THEN 'diagnostic' ELSE 'medication' END AS kind, o_orderkey AS order_id FROM orders",
    "appts": "SELECT CAST(o_custkey AS VARCHAR) AS client_id, l_shipdate AS ts, l_returnflag <> 'R' AS attended, l_suppkey % 7 AS consultant, l_partkey % 5 AS clinic, l_linestatus AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "demo": """SELECT CAST(c_custkey AS VARCHAR) AS client_id, o_orderdate AS ts, o_orderkey AS record_id,
        CASE WHEN o_orderkey % 6 <> 0 THEN split_part(c_name, '#', 1) END AS first_name, CASE WHEN o_orderkey % 7 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
        CASE WHEN o_orderkey % 4 <> 0 THEN ['White British', 'Asian - Indian', 'Black African', 'Mixed: white and asian', 'Other', 'Not specified'][c_nationkey % 6 + 1] END AS racecode,
        CASE WHEN o_orderkey % 5 <> 0 THEN DATE '1930-01-01' + CAST(c_custkey % 20000 AS INTEGER) END AS born,
        CASE WHEN o_orderkey % 97 = 0 THEN o_orderdate END AS died
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "docs": "SELECT doc_id, 'c' || (doc_id % 50) AS client_id, TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 720 AS BIGINT)) AS ts, text, source AS description FROM documents",
    "notes": "SELECT conv_id * 100 + turn AS doc_id, 'c' || (conv_id % 50) AS client_id, TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 28 AS INTEGER)) + to_hours(turn) AS ts, text, role AS description FROM conversations",
    "ward": f"""SELECT CAST(user_id AS VARCHAR) AS client_id, ts, item, value,
        CASE item {' '.join(f"WHEN '{i}' THEN [{', '.join(f"'{t}'" for t in ts)}][CAST(event_id // {len(WARD_ITEMS)} % 3 AS INTEGER) + 1]" for i, ts in WARD_TEXTS.items())} ELSE 'none' END AS text
        FROM (SELECT *, [{', '.join(f"'{i}'" for i in WARD_ITEMS)}][CAST(event_id % {len(WARD_ITEMS)} AS INTEGER) + 1] AS item FROM events)""",
    **{f"{t}29": f"SELECT * REPLACE (ts + INTERVAL 29 YEAR AS ts) FROM {t}" for t in ("ords", "appts", "demo")},
    "reports": "SELECT page_id AS doc_id, 'c' || (page_id % 50) AS client_id, TIMESTAMP '2024-01-01 12:00:00' + to_days(CAST(page_id % 28 AS INTEGER)) AS ts, html AS text, url AS description FROM pages",
    "tobs": "SELECT doc_id, 'c' || (doc_id % 50) AS client_id, TIMESTAMP '2024-01-02' + to_hours(CAST(doc_id % 650 AS BIGINT)) AS ts, text, 'quality ' || quality AS description FROM documents JOIN labels USING (doc_id)",
    "vocab": """SELECT DISTINCT word, CAST(length(word) AS BIGINT) AS cui, 'concept ' || substr(word, 1, 2) AS pretty_name,
        CASE WHEN length(word) % 2 = 0 THEN 'disorder' ELSE 'finding' END AS type
        FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark) WHERE length(word) >= 6""",
    "mentions": """SELECT *, doc_id * 7 + position * 13 AS n FROM (SELECT doc_id, client_id, ts, generate_subscripts(ws, 1) - 1 AS position, unnest(ws) AS word
        FROM (SELECT *, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM docs))""",
    "anns": """SELECT client_id, doc_id, ts, position, word, cui, pretty_name, type, (n % 100) / 100.0 AS acc, ['Recent', 'Past', 'Future'][n % 3 + 1] AS Time_Value,
        ['True', 'True', 'False', 'True'][n % 4 + 1] AS Presence_Value, ['Patient', 'Patient', 'Family', 'Patient', 'Patient'][n % 5 + 1] AS Subject_Value, n AS tie
        FROM mentions JOIN vocab USING (word)""",
    **{
        f"{name}_anns": f"""SELECT client_id, doc_id, ts, position, word, cui, pretty_name, doc_id * 7 + position * 13 AS tie
        FROM (SELECT doc_id, client_id, ts, generate_subscripts(ws, 1) - 1 AS position, unnest(ws) AS word FROM (SELECT *, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM {source})) JOIN vocab USING (word)"""
        for name, source in (("note", "notes"), ("report", "reports"), ("tobs", "tobs"))
    },
    "days": "SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS slice_start",
    "halves": "SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2003-01-01', INTERVAL 6 MONTH)) AS DATE) AS slice_start",
}
NEEDS = {"ords29": ("ords",), "appts29": ("appts",), "demo29": ("demo",), "mentions": ("docs",), "anns": ("vocab", "docs", "mentions"), "note_anns": ("vocab", "notes"), "report_anns": ("vocab", "reports"), "tobs_anns": ("vocab", "tobs")}


def with_tables(names: str, sql: str) -> str:
    """A WITH clause of the named tables (and those they need) in front of sql, which may go on with its own after a comma."""
    order: list[str] = []
    for name in names.split():
        order += [n for n in (*NEEDS.get(name, ()), name) if n not in order]
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + ("" if sql.lstrip().startswith(",") else "\n") + sql
