"""Concept annotations: made from documents, flattened, merged; index events; note splitting; labelling exports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.times import ntz, parsed, plus
from tidewheel.operators.numbering import numbered

#: Rows of a vocabulary up to which it is broadcast.
VOCABULARY = 500_000


def size_of(vocabulary: DataFrame) -> tuple[int, int]:
    """Rows of a vocabulary, and words in its longest concept."""
    n, longest = vocabulary.agg(F.count("*"), F.max(F.size(F.split("word", " ")))).first()
    return n, longest or 1


def annotate(docs: DataFrame, vocabulary: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), size: tuple[int, int] | None = None) -> DataFrame:
    """key, keep, position (of the first word, from 0), cui, pretty_name and what else the vocabulary says of each match.

    vocabulary: word (one, or several with a space between), cui, pretty_name, ... Words of a text are lower-case runs of
    a to z. One pass over the documents and an equi-join on the first word; with a vocabulary known to be small (a small
    job, unless size has its size_of) it is broadcast, and words become rows and meet it in one generated loop.
    """
    n, longest = size_of(vocabulary) if size is None else size
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
    if longest == 1:
        found = docs.select(key, *keep, F.posexplode(words).alias("position", "word"))
        return found.join(F.broadcast(vocabulary) if n <= VOCABULARY else vocabulary, "word")

    # a text's words are found once and become rows; what follows a word is put together only where a concept begins with it
    found = docs.select(key, *keep, words.alias("tw_words")).select(key, *keep, "tw_words", F.posexplode("tw_words").alias("position", "head"))
    heads = vocabulary.withColumn("head", F.split("word", " ")[0]).withColumn("tw_size", F.size(F.split("word", " ")))
    if n > VOCABULARY:  # rows are shuffled, without their texts
        found = found.withColumn("tw_words", F.slice("tw_words", F.col("position") + 1, longest)).withColumn("tw_from", F.lit(1))
    else:
        found, heads = found.withColumn("tw_from", F.col("position") + 1), F.broadcast(heads)
    follows = F.array_join(F.slice("tw_words", F.col("tw_from"), F.col("tw_size")), " ")
    return found.join(heads, "head").where((F.col("tw_size") == 1) | (follows == F.col("word"))).drop("head", "tw_words", "tw_from", "tw_size")


def longest(matches: DataFrame, key: str, words: str = "word") -> DataFrame:
    """Of matches that overlap in their words, the longest; of equally long ones the first; of equal ones all (they are
    different concepts under one name). Matches are made and dealt once, by key: each word of a match looks for the best
    match over it, and a match stays if it is the best over all its words. Matches without a key are not compared."""
    n = F.size(F.split(words, " "))
    best = F.struct(n.alias("n"), (-F.col("position")).alias("at"))
    each = matches.select("*", best.alias("tw_best"), F.explode(F.sequence(F.col("position"), F.col("position") + n - 1)).alias("tw_token")).repartition(key)
    top = F.max("tw_best").over(Window.partitionBy(key, "tw_token"))
    seen = each.withColumn("tw_is_top", F.col("tw_best") == top)
    kept = seen.withColumn("tw_kept", F.min("tw_is_top").over(Window.partitionBy(key, "tw_best")))
    return kept.where((F.col("tw_token") == F.col("position")) & (F.col("tw_kept") | F.col(key).isNull())).select(*matches.columns)


#: Context of a mention: column -> (value without a sign, value -> words that are signs of it).
CONTEXT = {
    "Presence_Value": ("True", {"False": ("no", "not", "without", "denies", "negative")}),
    "Time_Value": ("Recent", {"Past": ("history", "previous", "previously", "past", "former"), "Future": ("will", "planned", "future", "risk")}),
    "Subject_Value": ("Patient", {"Family": ("mother", "father", "family", "brother", "sister", "familial")}),
}


def in_context(docs: DataFrame, matches: DataFrame, key: str, text: str, rules: dict[str, tuple[str, dict[str, tuple[str, ...]]]] = CONTEXT, window: int = 5) -> DataFrame:
    """matches with a column for each rule: the value whose signs stand among the window words before the mention, that of the
    nearest sign, else the rule's first. Signs are found by one look at each text's words; texts are not joined."""
    signs = docs.sparkSession.createDataFrame([(w, c, v) for c, (_, values) in rules.items() for v, ws in values.items() for w in ws], "word string, tw_rule string, tw_value string")
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
    seen = docs.select(F.col(key).alias("tw_key"), F.posexplode(words).alias("tw_at", "word")).join(F.broadcast(signs), "word")  # the rules' words
    reach = seen.select("tw_key", "tw_rule", "tw_value", "tw_at", F.explode(F.sequence(F.col("tw_at") + 1, F.col("tw_at") + window)).alias("tw_position"))
    nearest = reach.groupBy("tw_key", "tw_position").agg(*(F.max_by("tw_value", F.when(F.col("tw_rule") == c, F.col("tw_at"))).alias(f"tw_{c}") for c in rules))
    joined = matches.join(nearest, (matches[key] == nearest["tw_key"]) & (matches["position"] == nearest["tw_position"]), "left")
    return joined.select(*(matches[c] for c in matches.columns if c not in rules), *(F.coalesce(f"tw_{c}", F.lit(d)).alias(c) for c, (d, _) in rules.items()))


def annotate_with_model(docs: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """A model's rows for each batch of documents; the model is loaded once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield model(batch)

    return docs.mapInPandas(run, schema)


ENTITY = "map<string, struct<cui string, pretty_name string, source_value string, acc double, start int, end int, meta_anns map<string, struct<value string, confidence double>>>>"


def flatten(docs: DataFrame, key: str, text: str, entities: str, keep: tuple[str, ...] = (), window: int = 300) -> DataFrame:
    """Rows of nested JSON {"entities": {id: {...}}}, with context values and the text around the mention.

    The experiencer is read from `Subject/Experiencer`, else from `Subject`. JSON that doesn't parse gives no rows.
    """
    parsed_ = F.from_json(F.col(entities), f"struct<entities: {ENTITY}>")["entities"]
    rows = docs.select(key, *keep, F.col(text).alias("tw_text"), F.explode(F.map_values(parsed_)).alias("e"))
    meta = lambda n, f: F.col("e.meta_anns")[n][f]
    low = F.greatest(F.col("e.start") - window, F.lit(0))
    sample = F.substring(F.col("tw_text"), low + 1, F.col("e.end") + window - low)
    context = [F.coalesce(*(meta(n, f) for n in names)).alias(f"{out}_{f.capitalize()}") for out, names in (("Time", ["Time"]), ("Presence", ["Presence"]), ("Subject", ["Subject/Experiencer", "Subject"])) for f in ("value", "confidence")]
    return rows.select(key, *keep, *(F.col(f"e.{c}").alias(c) for c in ("cui", "pretty_name", "source_value", "acc", "start", "end")), *context, sample.alias("text_sample"))


#: The columns that fill one another where sources differ, for documents and for annotations, in order.
DOCUMENT_CHAINS = {
    "updatetime": ["updatetime", "observationdocument_recordeddtm", "basicobs_entered"],
    "observationdocument_recordeddtm": ["observationdocument_recordeddtm", "updatetime"],
    "document_guid": ["document_guid", "observation_guid", "basicobs_guid"],
    "document_description": ["document_description", "obscatalogmasteritem_displayname", "basicobs_itemname_analysed"],
    "body_analysed": ["body_analysed", "observation_valuetext_analysed", "textualObs"],
}
ANNOTATION_CHAINS = {
    "updatetime": ["updatetime", "observationannotation_recordeddtm", "basicobs_entered", "observationdocument_recordeddtm"],
    "document_guid": ["document_guid", "basicobs_guid", "observation_guid"],
    "annotation_description": ["annotation_description", "obscatalogmasteritem_displayname"],
}


def merged(parts: dict[str, DataFrame], chains: dict[str, list[str]], drop: tuple[str, ...] = (), tag: str = "annotation_batch_source") -> DataFrame:
    """The sources' rows under one another, tagged with their source, each chain of columns coalesced into its first name.

    Chains are filled in order, a later one from what an earlier one has filled; what is no chain's name goes."""
    out = None
    for name, rows in parts.items():
        own = rows.withColumn(tag, F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    for name, chain in chains.items():
        if held := [F.col(c) for c in chain if c in out.columns]:
            out = out.withColumn(name, F.coalesce(*held))
    gone = {c for chain in chains.values() for c in chain if c not in chains} | set(drop)
    return out.drop(*gone)


def filled_both_ways(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Two columns, each filled from the other where it is null."""
    return rows.withColumns({a: F.coalesce(a, b), b: F.coalesce(b, a)})


def index_events(clients: DataFrame, parts: dict[str, DataFrame], codes: list | None, mode: str, fallback: Column, keep: tuple[str, ...] = ("cui",)) -> DataFrame:
    """client_id, index_ts, source, keep...: one index event a client.

    Each source (client_id, ts, tie, cui, ...) gives its earliest or latest row of the codes; of the sources' rows the
    one with the earliest time wins, also in latest mode, on a tie the source named first. Clients without any get the
    fallback time, source `fallback`.
    """
    pick, best = (F.min_by if mode == "earliest" else F.max_by), None
    for i, (name, rows) in enumerate(parts.items()):
        own = rows.where("ts is not null")
        own = own if codes is None else own.where(F.col("cui").isin(codes))
        one = own.groupBy("client_id").agg(pick(F.struct("ts", "tie", *keep), F.struct("ts", "tie")).alias("r")).select("client_id", F.lit(i).alias("rank"), F.lit(name).alias("source"), "r.*")
        best = one if best is None else best.unionByName(one)
    first = best.groupBy("client_id").agg(F.min_by(F.struct("ts", "source", *keep), F.struct("ts", "rank")).alias("r")).select("client_id", "r.*")
    out = clients.select("client_id").distinct().join(first, "client_id", "left")
    return out.select("client_id", F.coalesce("ts", ntz(fallback)).alias("index_ts"), F.coalesce("source", F.lit("fallback")).alias("source"), *keep)


def index_windows(index: DataFrame, buffer_months: int = 3, years: int = 1) -> DataFrame:
    """client_id, win_from, win_to: from a buffer after the index event for so many years."""
    start = ntz(plus(F.col("index_ts"), months=buffer_months))
    return index.select("client_id", start.alias("win_from"), ntz(plus(start, years=years)).alias("win_to"))


def _pairs(own: DataFrame) -> DataFrame:
    pairs = own.select("client_id", F.col("cui").alias("a")).join(own.select("client_id", F.col("cui").alias("b")), "client_id").where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("clients"))


def cooccurring(annotations: DataFrame, top: int | None = None, tried: int = 200) -> DataFrame:
    """a, b, clients: how many clients have each pair of concepts; a < b. A client with n concepts gives n (n - 1) / 2
    pairs: that is the result's size before it is counted.

    With top, only so many of the commonest pairs, ties by a and b. A pair has no more clients than either of its concepts:
    the pairs of the `tried` commonest concepts give a count that the last of the top has at least, and concepts with fewer
    clients than that make no pairs. The result is that of all pairs.
    """
    own = annotations.select("client_id", "cui").where("cui is not null").distinct()
    if top is None:
        return _pairs(own)
    single = own.groupBy("cui").agg(F.count("*").alias("n"))
    common = single.orderBy(F.desc("n"), "cui").limit(tried).select("cui")
    order = (F.desc("clients"), "a", "b")
    first = _pairs(own.join(F.broadcast(common), "cui", "left_semi")).orderBy(*order).limit(top).collect()  # top rows
    least = first[-1]["clients"] if len(first) == top else 1
    able = single.where(F.col("n") >= least).select("cui")
    return _pairs(own.join(able, "cui", "left_semi")).orderBy(*order).limit(top)


def clients_with_all(annotations: DataFrame, lists: list[list]) -> DataFrame:
    """Clients with a code of every list."""
    has = annotations.groupBy("client_id").agg(*(F.bool_or(F.col("cui").isin(own)).alias(f"l{i}") for i, own in enumerate(lists)))
    keep = F.lit(True)
    for i in range(len(lists)):
        keep = keep & F.col(f"l{i}")
    return has.where(keep).select("client_id")


#: The trailer of a note's entry and the form of its date.
MARK, DATE = "Entered on -", r"(\d{2}-[A-Za-z]{3}-\d{4} \d{2}:\d{2})"


def split_notes(docs: DataFrame, key: str, text: str, ts: str, description: str, window: int = 20) -> DataFrame:
    """Notes cut at their entries' trailers: key, chunk, text, ts, description.

    The mark ends an entry and its date stands in the next characters. An entry runs from the end of the one before to
    the end of its date and one character more, and has that date. Where there is no date, the entry keeps the note's
    time and ends at the mark, where the next one starts. Text after the last mark is dropped. Notes without a mark,
    and notes with a date that is none, pass through unsplit (chunk null).
    """
    once = lambda c: F.explode(F.array(c))

    def entry(piece: Column, k: Column) -> Column:
        """What follows mark k: its date, and how many characters of the piece the entry takes (null without a date)."""
        near = F.substring(piece, 1, window)
        dated = lambda hit: F.struct(piece.alias("piece"), k.alias("k"), (hit != "").alias("dated"), F.when(hit != "", F.instr(near, hit) + F.length(hit)).alias("taken"), F.when(hit != "", ntz(F.try_to_timestamp(hit, F.lit("dd-MMM-yyyy HH:mm")))).alias("date"))
        return F.transform(F.array(F.regexp_extract(near, DATE, 1)), dated)[0]

    def chunk(before: Column, own: Column) -> Column:
        over = (before["k"] > 0) & (before["taken"] > F.length(before["piece"]))  # the character more is the next mark's first
        rest = F.when(before["k"] == 0, before["piece"]).when(before["taken"].isNull(), F.concat(F.lit(MARK), before["piece"])).otherwise(F.substr(before["piece"], before["taken"] + 1))
        mark = F.when(over, F.lit(MARK[1:])).otherwise(F.lit(MARK))
        more = F.when((own["taken"] > F.length(own["piece"])) & (own["k"] < F.col("tw_n")), F.lit(MARK[0])).otherwise(F.lit(""))
        return F.struct(F.when(own["taken"].isNull(), rest).otherwise(F.concat(rest, mark, F.substr(own["piece"], F.lit(1), own["taken"]), more)).alias("text"), own["date"].alias("date"))

    # Entries come from a row of an array of one: a column would be put in the place of each of its uses, also of those
    # within lambdas, and find a note's entries again for each entry. Piece 0 lies before the first mark.
    found = docs.select(key, text, ts, description, once(F.transform(F.split(F.col(text), MARK), entry)).alias("tw_entries")).where("tw_entries is not null")
    bad = F.exists("tw_entries", lambda e: (e["k"] > 0) & e["dated"] & e["date"].isNull())
    marked = found.select("*", once(F.struct((F.size("tw_entries") - 1).alias("n"), bad.alias("bad"))).alias("tw_m")).select("*", F.col("tw_m.n").alias("tw_n"), (F.col("tw_m.bad") | (F.col("tw_m.n") == 0)).alias("tw_whole"))
    as_is = F.array(F.struct(F.col(text).alias("text"), F.lit(None).cast("timestamp_ntz").alias("date")))
    chunks = F.when(F.col("tw_whole"), as_is).otherwise(F.zip_with(F.slice("tw_entries", 1, F.greatest("tw_n", F.lit(0))), F.slice("tw_entries", 2, F.greatest("tw_n", F.lit(0))), chunk))
    split = marked.select(key, ts, description, "tw_whole", F.posexplode(chunks).alias("tw_i", "z")).withColumn("chunk", F.when(~F.col("tw_whole"), F.col("tw_i")))
    named = F.when(F.col("tw_whole"), F.col(description)).otherwise(F.concat(F.col(description), F.lit("_clinical note chunk_"), F.col("tw_i")))
    return split.select(key, "chunk", F.col("z.text").alias(text), F.coalesce(F.col("z.date"), ntz(F.col(ts))).alias(ts), named.alias(description))


EXPORT = "struct<projects: array<struct<name: string, id: bigint, documents: array<struct<id: bigint, name: string, text: string, annotations: array<struct<id: bigint, cui: string, value: string, start: int, end: int, correct: boolean, meta_anns: map<string, struct<name: string, value: string>>>>>>>>>"


def export_to_rows(exports: DataFrame, column: str = "value") -> DataFrame:
    """A labelling tool's nested export as rows; context values in the map meta."""
    top = exports.select(F.explode(F.from_json(column, EXPORT)["projects"]).alias("p"))
    docs = top.select(F.col("p.name").alias("project"), F.explode("p.documents").alias("d"))
    anns = docs.select("project", F.col("d.id").alias("document_id"), F.col("d.name").alias("document_name"), F.col("d.text").alias("text"), F.explode("d.annotations").alias("a"))
    return anns.select("project", "document_id", "document_name", "text", F.col("a.id").alias("annotation_id"), *(F.col(f"a.{c}").alias(c) for c in ("cui", "value", "start", "end", "correct")), F.transform_values("a.meta_anns", lambda k, v: v["value"]).alias("meta"))


def rows_to_export(rows: DataFrame) -> DataFrame:
    """value: one JSON text a document, with its project's name around it; the inverse of export_to_rows."""
    meta = F.transform_values("meta", lambda k, v: F.struct(k.alias("name"), v.alias("value")))
    ann = F.struct(F.col("annotation_id").alias("id"), "cui", "value", "start", "end", "correct", meta.alias("meta_anns"))
    docs = rows.groupBy("project", "document_id", "document_name", "text").agg(F.sort_array(F.collect_list(F.struct("annotation_id", F.to_json(ann).alias("j")))).alias("l"))
    docs = docs.withColumn("l", F.transform("l", lambda x: x["j"]))
    quoted = lambda c: F.to_json(F.struct(F.col(c).alias("x")))
    inner = lambda c: F.substring(quoted(c), F.lit(6), F.length(quoted(c)) - 6)
    doc = F.concat(F.lit('{"id":'), F.col("document_id").cast("string"), F.lit(',"name":'), inner("document_name"), F.lit(',"text":'), inner("text"), F.lit(',"annotations":['), F.array_join("l", ","), F.lit("]}"))
    return docs.select(F.concat(F.lit('{"projects":[{"name":'), inner("project"), F.lit(',"documents":['), doc, F.lit("]}]}")).alias("value"))


def unique_names(docs: DataFrame, name: str, text: str, order: str) -> DataFrame:
    """name, text: a name that repeats gets _1, _2, ... from its second row on, in an order of numbers.

    Names of any number of rows are numbered over many tasks (numbered)."""
    n = F.col("tw_number")
    own = numbered(docs.select(F.col(name).alias("name"), F.col(text).alias("text"), F.col(order).alias("tw_order")), "name", "tw_order", "tw_number")
    return own.select(F.when(n == 0, F.col("name")).otherwise(F.concat("name", F.lit("_"), n)).alias("name"), "text")
