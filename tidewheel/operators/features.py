"""Feature extractors: rows (client_id, slice_start, feature, value) from events that lie in slices.

Each takes events with client_id, slice_start, ts, item, value (double) and text, as far as it needs them, and
is one partial-then-final aggregation by client, slice and item. A null value is no measurement.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.times import age_at, days_floor
from tidewheel.operators.quantiles import split_large, with_medians, with_middle, with_order_statistics

KEYS = ("client_id", "slice_start")
LONG = (*KEYS, "feature", "value")


def _as_of(when: datetime) -> Column:
    return F.lit(when).cast("timestamp_ntz")


def long_form(wide: DataFrame, names: dict[str, Column]) -> DataFrame:
    """A row for each feature that is not null."""
    pairs = F.array(*(F.struct((F.lit(n) if isinstance(n, str) else n).alias("feature"), c.cast("double").alias("value")) for n, c in names.items()))
    return wide.select(*KEYS, F.explode(pairs).alias("f")).select(*KEYS, "f.feature", "f.value").where("value is not null")


def _named(wide: DataFrame, item: str, stats: dict[str, Column]) -> DataFrame:
    pairs = F.array(*(F.struct(F.concat(F.col(item), F.lit("_" + n)).alias("feature"), c.cast("double").alias("value")) for n, c in stats.items()))
    return wide.select(*KEYS, F.explode(pairs).alias("f")).select(*KEYS, "f.feature", "f.value").where("value is not null")


def bloods(events: DataFrame, as_of: datetime, exact: bool = True) -> DataFrame:
    """Per item: mean; from two values most-recent, earliest-test, days-since-last-test and num-tests; from three
    median, mode (smallest of ties), std, min, max, contains-extreme-low and -high (3 std from the mean) and
    days-between-first-last. Medians and modes are exact in groups of any size (operators/quantiles.py); exact=False
    takes approximate medians."""
    own = events.where("value is not null and ts is not null")
    v, t = F.col("value"), F.col("ts")
    aggregates = [
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.max_by(v, F.struct(t, v)).alias("recent"), F.min_by(v, F.struct(t, v)).alias("earliest"),
        F.max(t).alias("last"), F.min(t).alias("first"), F.stddev_samp(v).alias("std"), F.min(v).alias("low"), F.max(v).alias("high"),
    ]
    keys = [*KEYS, "item"]
    if exact:
        g = with_order_statistics(own, keys, "value", aggregates, unit=list(KEYS))
    else:
        g = own.repartition(*KEYS).groupBy(*keys).agg(*aggregates, F.percentile_approx(v, 0.5).alias("median"), F.mode(v, True).alias("mode"))
    c = F.col
    two, three = (lambda x: F.when(c("n") >= 2, x)), (lambda x: F.when(c("n") >= 3, x))
    return _named(g, "item", {
        "mean": c("mean"), "most-recent": two(c("recent")), "earliest-test": two(c("earliest")), "days-since-last-test": two(days_floor(_as_of(as_of), c("last"))),
        "num-tests": two(c("n")), "median": three(c("median")), "mode": three(c("mode")), "std": three(c("std")), "min": three(c("low")), "max": three(c("high")),
        "contains-extreme-low": three((c("low") < c("mean") - 3 * c("std")).cast("int")), "contains-extreme-high": three((c("high") > c("mean") + 3 * c("std")).cast("int")),
        "days-between-first-last": three(days_floor(c("last"), c("first"))),
    })


def orders_by_kind(events: DataFrame, as_of: datetime, names: dict[str, str], which: tuple[str, ...] = ("num", "since", "between")) -> DataFrame:
    """names: kind -> name. Per kind and order: num-<name>-order, days-since-last-<name>-order and, from two,
    days-between-first-last-<name>."""
    g = events.where("item is not null and ts is not null").groupBy(*KEYS, "kind", "item").agg(F.count("*").alias("n"), F.max("ts").alias("last"), F.min("ts").alias("first"))
    name = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col("kind")]
    stats = {"num": (("_num-", "-order"), F.col("n")), "since": (("_days-since-last-", "-order"), days_floor(_as_of(as_of), F.col("last"))), "between": (("_days-between-first-last-", ""), F.when(F.col("n") >= 2, days_floor(F.col("last"), F.col("first"))))}
    pairs = F.array(*(F.struct(F.concat(F.col("item"), F.lit(before), F.col("name"), F.lit(after)).alias("feature"), v.cast("double").alias("value")) for w in which for (before, after), v in [stats[w]]))
    return g.withColumn("name", name).where("name is not null").select(*KEYS, F.explode(pairs).alias("f")).select(*KEYS, "f.feature", "f.value").where("value is not null")


def orders(events: DataFrame, as_of: datetime, kind: str, which: tuple[str, ...] = ("num", "since", "between")) -> DataFrame:
    """All events as orders of one kind."""
    return orders_by_kind(events.withColumn("kind", F.lit(kind)), as_of, {kind: kind}, which)


def drugs(events: DataFrame, as_of: datetime, which: tuple[str, ...] = ("num", "since", "between")) -> DataFrame:
    return orders(events, as_of, "drug", which)


def diagnostics(events: DataFrame, as_of: datetime) -> DataFrame:
    return orders(events, as_of, "diagnostic")


#: The ranges (open) in which a measurement counts.
BODY = {"bmi": (6, 200), "height": (30, 300), "weight": (1, 800)}


@dataclass(frozen=True)
class BySlice:
    """What an extractor reads off a slice: its aggregates by name, and an array of its (feature, value) made from them;
    the items that it looks at, if not at all. middles: columns by name that hold the middle values of each item's numbers
    (quantiles.with_middle), for aggregates to use. present: an event's feature that is 1 wherever it occurs."""

    aggregates: dict[str, Column]
    features: Column | None
    items: tuple[str, ...] | None = None
    middles: dict[str, Column] = field(default_factory=dict)
    present: Column | None = None


def _array(pairs: dict[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(n).alias("feature"), c.cast("double").alias("value")) for n, c in pairs.items()))


def by_slice(events: DataFrame, parts: list[BySlice]) -> DataFrame:
    """All parts in one aggregation by client and slice; its rows lie by client and slice.

    An event's features that are there or not are keys of the aggregation, beside a null one for all that is aggregated, so
    that its buffers are numbers alone. Slices of very many events are aggregated over all tasks (operators/quantiles.py).
    """
    if all(p.items for p in parts):
        events = events.where(F.col("item").isin([i for p in parts for i in p.items]))
    middles = {n: c for p in parts for n, c in p.middles.items()}
    present = [p.present for p in parts if p.present is not None]
    if not middles and not present:
        return _sums(events, parts, [])
    small, large = split_large(events, list(KEYS))
    small = small.repartition(*KEYS)
    for n, c in middles.items():
        small = with_middle(small, [*KEYS, "item"], c, n)
        large = None if large is None else with_medians(large, [*KEYS, "item"], c, n)
    out = _sums(small, parts, present)
    return out if large is None else out.unionByName(_sums(large, parts, present).repartition(*KEYS))


def _sums(events: DataFrame, parts: list[BySlice], present: list[Column]) -> DataFrame:
    keys, own = list(KEYS), [p for p in parts if p.features is not None]
    if present:
        whole = F.lit(bool(own)) if not own or not all(p.items for p in own) else F.col("item").isin([i for p in own for i in p.items])
        keys.append("tw_present")
        events = events.select("*", F.posexplode(F.array(F.lit(None).cast("string"), *present)).alias("tw_at", "tw_present"))
        events = events.where(((F.col("tw_at") == 0) & whole) | F.col("tw_present").isNotNull())
    aggregates = [c.alias(n) for p in own for n, c in p.aggregates.items()]
    g = events.groupBy(*keys).agg(*aggregates) if aggregates else events.select(*keys).distinct()
    features = [p.features for p in own]
    met = F.array(F.struct(F.col("tw_present").alias("feature"), F.lit(1.0).alias("value"))) if present else None
    pairs = met if not own else F.concat(*features) if not present else F.when(F.col("tw_present").isNotNull(), met).otherwise(F.concat(*features))
    return g.select(*KEYS, F.explode(pairs).alias("f")).select(*KEYS, "f.feature", "f.value").where("value is not null")


def body_part(items: dict[str, str], require_bmi: bool = True) -> BySlice:
    v, aggs, middles = F.col("value"), {}, {}
    for k in BODY:
        own = F.when((F.col("item") == items[k]) & (v > BODY[k][0]) & (v < BODY[k][1]), v)
        middles[f"middle {k}"] = own
        middle = F.col(f"middle {k}")
        aggs |= {f"{k}_mean": F.avg(own), f"{k}_median": (F.min(middle) + F.max(middle)) / 2, f"{k}_std": F.stddev_samp(own), f"{k}_max": F.max(own), f"{k}_min": F.min(own)}
    has = F.col("bmi_mean").isNotNull() if require_bmi else F.lit(True)
    out = {f"bmi_{s}": F.col(f"bmi_{s}") for s in ("mean", "median", "std", "max", "min")}
    out |= {"bmi_high": (F.col("bmi_median") > 24.9).cast("int"), "bmi_low": (F.col("bmi_median") < 18.5).cast("int"), "bmi_extreme": (F.col("bmi_median") > 30).cast("int")}
    out |= {f"{k}_{s}": F.when(has, F.col(f"{k}_{s}")) for k, ss in (("height", ("mean", "median", "std")), ("weight", ("mean", "median", "std", "max", "min"))) for s in ss}
    if len(set(items.values())) == len(items):  # one column, so one sort
        one = F.coalesce(*middles.values())
        aggs |= {f"{k}_median": (F.min(m) + F.max(m)) / 2 for k in BODY for m in [F.when(F.col("item") == items[k], F.col("middle"))]}
        middles = {"middle": one}
    return BySlice(aggs, _array(out), tuple(items.values()), middles)


def body(events: DataFrame, items: dict[str, str], require_bmi: bool = True) -> DataFrame:
    """items: the item of bmi, height and weight. mean, median, std of each within its range; max and min of bmi and
    weight; high, low and extreme from the median bmi. Height and weight need a bmi in the slice, unless not required."""
    return by_slice(events, [body_part(items, require_bmi)])


def scores(events: DataFrame, names: dict[str, str], limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """names: item -> feature. Of each: mean, median, std, max, min, n; a named feature keeps only values inside its open limits."""
    name = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col("item")]
    own = events.where("value is not null").withColumn("name", name).where("name is not null")
    for n, (low, high) in (limits or {}).items():
        own = own.where((F.col("name") != n) | ((F.col("value") > low) & (F.col("value") < high)))
    v = F.col("value")
    aggregates = [F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.max(v).alias("max"), F.min(v).alias("min"), F.count(v).alias("n")]
    g = with_order_statistics(own, [*KEYS, "name"], "value", aggregates, unit=list(KEYS))
    return _named(g, "name", {s: F.col(s) for s in ("mean", "median", "std", "max", "min", "n")})


def mapped_status(events: DataFrame, values: dict[str, float], name: str) -> DataFrame:
    """Texts mapped to numbers (others are dropped), then the six statistics."""
    mapped = F.create_map(*(F.lit(x) for k, v in values.items() for x in (k, float(v))))[F.col("text")]
    return scores(events.withColumn("value", mapped).withColumn("item", F.lit(name)), {name: name})


def _of(item: str | None, value: Column) -> Column:
    return value if item is None else F.when(F.col("item") == item, value)


def flags_part(parts: dict[str, str], ignore_case: bool = True, item: str | None = None) -> BySlice:
    text = F.lower("text") if ignore_case else F.col("text")
    held = {f: F.coalesce(text.contains(p.lower() if ignore_case else p), F.lit(False)).cast("int") for f, p in parts.items()}
    return BySlice({f"flag {f}": F.max(_of(item, c)) for f, c in held.items()}, _array({f: F.col(f"flag {f}") for f in parts}), item and (item,))


def flags(events: DataFrame, parts: dict[str, str], ignore_case: bool = True) -> DataFrame:
    """feature -> substring: 1 if any text in the slice holds it, else 0."""
    return by_slice(events, [flags_part(parts, ignore_case)])


def counts_part(values: dict[str, str], item: str | None = None) -> BySlice:
    """No rows for slices without any event of the item."""
    own = F.lit(True) if item is None else F.col("item") == item
    counts = {f"count {f}": F.when(F.count_if(own) > 0, F.count_if(own & (F.col("text") == v))) for f, v in values.items()}
    return BySlice(counts, _array({f: F.col(f"count {f}") for f in values}), item and (item,))


def value_counts(events: DataFrame, values: dict[str, str]) -> DataFrame:
    """feature -> exact text: how often it occurs in the slice."""
    return by_slice(events, [counts_part(values)])


def presence_part(prefix: str, item: str | None = None, clean: bool = False) -> BySlice:
    text = F.replace(F.replace(F.col("text"), F.lit("-"), F.lit("_")), F.lit("%"), F.lit("pct")) if clean else F.col("text")
    return BySlice({}, None, item and (item,), present=F.concat(F.lit(prefix), _of(item, text)))


def presence(events: DataFrame, prefix: str, clean: bool = False) -> DataFrame:
    """1 for each distinct text; clean writes "-" as "_" and "%" as "pct"."""
    return by_slice(events, [presence_part(prefix, None, clean)])


def positive_part(name: str, negate: bool = False) -> BySlice:
    text = F.lower("text")
    out = F.when(F.col(f"yes {name}"), 1).when(F.col(f"no {name}"), 0)
    return BySlice({f"yes {name}": F.bool_or(text.contains("positive")), f"no {name}": F.bool_or(text.contains("negative"))}, _array({name: F.coalesce(out, F.lit(0)) if negate else out}))


def positive(events: DataFrame, name: str, negate: bool = False) -> DataFrame:
    """1 if any text says positive, else 0 if any says negative, else null (no row), or 0 if negate."""
    return by_slice(events, [positive_part(name, negate)])


def appointments(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Attended ones only; column -> prefix: how often each of its values occurs."""
    pairs = F.explode(F.array(*(F.struct(F.concat(F.lit(p), F.col(c).cast("string")).alias("feature")) for c, p in columns.items())))
    return events.where("attended").select(*KEYS, pairs.alias("f")).where("f.feature is not null").groupBy(*KEYS, F.col("f.feature").alias("feature")).agg(F.count("*").cast("double").alias("value"))


#: What is filled forward of a client's records, as far as they have it.
FIELDS = ("first_name", "last_name", "born", "gender", "racecode", "died")


def latest_records(records: DataFrame, sliced: Callable[[DataFrame], DataFrame], start: date, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """client_id, slice_start, ts (of the slice's last record) and each field's last value so far, filled forward in time.

    sliced deals records to slices that leave no gap, start is where the first begins. Each slice's last values are one
    aggregation; what a slice lacks is carried over the client's slices before it, or from records before start. Records
    without a time are left out.
    """
    own = [c for c in fields if c in records.columns]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("ts", "record_id"))).alias(c) for c in own]
    held = sliced(records).groupBy(*KEYS).agg(F.max("ts").alias("ts"), *last)
    earlier = records.where(F.col("ts") < F.lit(start).cast("timestamp_ntz")).groupBy("client_id").agg(*last)
    past = Window.partitionBy("client_id").orderBy("slice_start").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as slices
    both = held.unionByName(earlier, allowMissingColumns=True)  # without a slice, so first
    return both.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in own}).where("slice_start is not null")


def demographics(records: DataFrame, sliced: Callable[[DataFrame], DataFrame], start: date, group: Callable[[Column], Column], groups: tuple[str, ...]) -> DataFrame:
    """Of each slice's last record, its fields filled forward: male (1, 0), age at the record, dead (0 when unknown), and a
    one-hot of the census group."""
    latest = latest_records(records, sliced, start, ("gender", "racecode", "born", "died")).withColumn("census", group(F.col("racecode")))
    sex = F.lower("gender")
    out = {"male": F.when(sex == "male", 1).when(sex == "female", 0), "age": age_at(F.col("born"), F.col("ts")), "dead": F.col("died").isNotNull().cast("int")}
    out |= {f"census_{g}": F.when(F.col("racecode").isNotNull(), (F.col("census") == g).cast("int")) for g in groups}
    return long_form(latest, out)


#: Census groups and the words that lead to them, in the order of the rules; a later one overrides.
CENSUS = {
    "white": ("english", "welsh", "scottish", "northern", "irish", "british", "gypsy", "irish traveller", "any other white background", "white", "caucasian", "traveller", "other white", "white other"),
    "asian_or_asian_british": ("asian", "chinese", "pakistani", "bangladeshi", "indian"),
    "black_african_caribbean_or_black_british": ("black", "african", "caribbean", "black british", "black african", "black carribean"),
    "other_ethnic_group": ("arab", "not specified"),
    "mixed_or_multiple_ethnic_groups": ("mixed", "multiple", "biracial", "multiracial", "white and asian", "white and black", "white and hispanic", "black and white", "asian and white", "hispanic and white"),
}
#: Last rules, a literal and its group.
LAST = (("other", "other_ethnic_group"), ("black", "black_african_caribbean_or_black_british"), ("white", "white"), ("asian", "asian_or_asian_british"), ("mix", "mixed_or_multiple_ethnic_groups"))


#: Words that a table may add to the census groups.
MOST_WORDS = 10_000


def census_words(rows: DataFrame) -> dict[str, tuple[str, ...]]:
    """What census_group takes as more, from a table of census and word (countries and nationalities, say)."""
    own = rows.select("census", F.lower("word").alias("word")).na.drop().distinct().limit(MOST_WORDS + 1).collect()
    if len(own) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words")
    if unknown := {r["census"] for r in own} - set(CENSUS):
        raise ValueError(f"no such groups: {sorted(unknown)}")
    return {g: tuple(sorted(r["word"] for r in own if r["census"] == g)) for g in CENSUS}


def census_group(text: Column, more: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Free text to one of five groups. An entry equal to a word of another group is left out of a group; more adds
    words to groups (countries and nationalities, say). Null and unmatched text is other_ethnic_group."""
    words = {g: tuple(w.lower() for w in (*ws, *(more or {}).get(g, ()))) for g, ws in CENSUS.items()}
    entry = F.lower(F.coalesce(text, F.lit("other_ethnic_group")))
    out = F.lit("other_ethnic_group")
    for g, own in [*words.items(), *((g, (w,)) for w, g in LAST)]:
        others = sorted({w for h, ws in words.items() if h != g for w in ws} - set(words[g]))
        held = F.lit(False)
        for w in own:
            held = held | entry.contains(w)
        out = F.when(held & ~entry.isin(others), F.lit(g)).otherwise(out)
    return out


def concepts(annotations: DataFrame) -> DataFrame:
    """How often each concept is mentioned; the sources' counts add up."""
    return annotations.where("pretty_name is not null").groupBy(*KEYS, F.col("pretty_name").alias("feature")).agg(F.count("*").cast("double").alias("value"))


def with_missing(features: DataFrame, frame: DataFrame, names: list[str], fill: float | None = None) -> DataFrame:
    """A row for each (client, slice) of frame and each name, fill (or null) where features has none."""
    wanted = frame.select(*KEYS).distinct().withColumn("feature", F.explode(F.lit(names)))
    out = wanted.join(features, [*KEYS, "feature"], "left")
    return out if fill is None else out.withColumn("value", F.coalesce("value", F.lit(fill)))


def union_of(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select(*LONG)
    for p in parts[1:]:
        out = out.unionByName(p.select(*LONG))
    return out


def assemble(parts: list[DataFrame]) -> DataFrame:
    """All extractors' rows; the values of equal features add up."""
    return union_of(parts).groupBy(*KEYS, "feature").agg(F.sum("value").alias("value"))


def packed(features: DataFrame, marked: bool = False) -> DataFrame:
    """One row a client and slice, its features in a map; the values of equal features add up. A row without a feature
    marks its client and slice as wanted; marked leaves out those that have no mark."""
    one = features.groupBy(*KEYS, "feature").agg(F.sum("value").alias("value"))
    pairs = F.collect_list(F.when(F.col("feature").isNotNull(), F.struct("feature", "value")))
    g = one.groupBy(*KEYS).agg(F.map_from_entries(F.sort_array(pairs)).alias("features"), F.bool_or(F.col("feature").isNull()).alias("marked"))
    return (g.where("marked") if marked else g).select(*KEYS, "features")


def unpacked(vectors: DataFrame) -> DataFrame:
    return vectors.select(*KEYS, F.explode("features").alias("feature", "value"))


def pivoted(features: DataFrame, names: list[str]) -> DataFrame:
    """Wide rows with exactly the named columns, so that the schema never depends on the data."""
    return features.groupBy(*KEYS).pivot("feature", names).agg(F.first("value"))
