"""The extractors by name, and vectors of the chosen ones: one pass a source, not one an extractor.

An extractor reads one source and gives long rows (client_id, slice_start, feature, value). Those of one source that
aggregate in the same way are run as one aggregation: scores and the VTE status by item, all that is read off a slice's
texts (and body measurements) by slice, orders by kind and item, concepts of all kinds of documents by concept.

Sources: basic (client_id, ts, item, value, text: laboratory values), observations (the same columns: ward observations),
orders (client_id, ts, item, kind), appointments (client_id, ts, attended and the columns counted), demographics
(client_id, ts, record_id, gender, racecode, born, died), and epr, mct, reports and textual_obs (annotations: client_id,
ts, pretty_name).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators import features as X
from tidewheel.operators.slicing import events_in_slices
from tidewheel.spec import RunSpec

#: The items of body measurements, scores and statuses, and the texts that count.
BODY_ITEMS = {"bmi": "OBS BMI Calculation", "height": "OBS Height", "weight": "OBS Weight"}
SCORES = {
    "NEWS2_Score": "news_score",
    "NEWS_Systolic_BP": "news_systolic_bp",
    "NEWS_Diastolic_BP": "news_diastolic_bp",
    "NEWS_Respiration_Rate": "news_respiration_rate",
    "NEWS_Heart_Rate": "news_heart_rate",
    "NEWS_Oxygen_Saturation": "news_oxygen_saturation",
    "NEWS Temperature": "news_temperature",
    "NEWS_AVPU": "news_avpu",
    "NEWS_Supplemental_Oxygen": "news_supplemental_oxygen",
    "NEWS2_Sp02_Target": "news_sp02_target",
    "NEWS2_Sp02_Scale": "news_sp02_scale",
    "NEWS_Pulse_Type": "news_pulse_type",
    "NEWS_Pain_Score": "news_pain_score",
    "NEWS Oxygen Litres": "news_oxygen_litres",
    "NEWS Oxygen Delivery": "news_oxygen_delivery",
}
SCORE_LIMITS = {"news_score": (-20, 20)}
VTE, VTE_VALUES = "CORE_VTE_STATUS", {"High risk of VTE High risk of bleeding": 1, "High risk of VTE Low risk of bleeding": 0}
SMOKING, SMOKING_TEXTS = "CORE_SmokingStatus", {"smoking_status_current": "Current Smoker", "smoking_status_non": "Non-Smoker"}
SITE, SITE_TEXTS = "CORE_HospitalSite", {"hosp_site_dh": "DH", "hosp_site_ph": "PRUH"}
RESUS, RESUS_TEXTS = "CORE_RESUS_STATUS", {f"core_resus_status_{t}": t for t in ("For cardiopulmonary resuscitation", "Not for cardiopulmonary resuscitation")}
SATURATION, BED = "CORE_SpO2", "CORE_BedNumber3"


@dataclass(frozen=True)
class Extractor:
    """joint: extractors of a source that one aggregation serves; part: makes what this one adds to it."""

    source: str
    joint: str
    part: Callable[[], object] = lambda: None

    def rows(self, events: DataFrame, spec: RunSpec) -> DataFrame:
        """This extractor alone on its source."""
        return JOINT[self.joint](events, [self.part()], spec)


def _scores(events: DataFrame, parts: list, spec: RunSpec) -> DataFrame:
    """parts: (item -> feature, limits, item -> text -> number)."""
    names, limits, value = {}, {}, F.col("value")
    for own, bounds, texts in parts:
        names |= own
        limits |= bounds
        for item, numbers in texts.items():
            value = F.when(F.col("item") == item, F.create_map(*(F.lit(x) for k, v in numbers.items() for x in (k, float(v))))[F.col("text")]).otherwise(value)
    return X.scores(events_in_slices(events.where(F.col("item").isin(list(names))).withColumn("value", value), spec), names, limits)


def _by_slice(events: DataFrame, parts: list, spec: RunSpec) -> DataFrame:
    return X.by_slice(events_in_slices(events, spec), parts)


def _orders(events: DataFrame, parts: list, spec: RunSpec) -> DataFrame:
    return X.orders_by_kind(events_in_slices(events.where(F.col("kind").isin([k for k, _ in parts])), spec), spec.as_of, dict(parts))


def _demographics(records: DataFrame, parts: list, spec: RunSpec) -> DataFrame:
    return X.demographics(records, lambda r: events_in_slices(r, spec), spec.first, X.census_group, tuple(X.CENSUS))


JOINT: dict[str, Callable[[DataFrame, list, RunSpec], DataFrame]] = {
    "bloods": lambda events, parts, spec: X.bloods(events_in_slices(events, spec), spec.as_of),
    "scores": _scores,
    "by_slice": _by_slice,
    "orders": _orders,
    "appointments": lambda events, parts, spec: X.appointments(events_in_slices(events, spec), parts[0]),
    "demographics": _demographics,
    "concepts": lambda events, parts, spec: X.concepts(events_in_slices(events, spec)),
}


EXTRACTORS: dict[str, Extractor] = {
    "demo": Extractor("demographics", "demographics"),
    "bmi": Extractor("observations", "by_slice", lambda: X.body_part(BODY_ITEMS)),
    "bloods": Extractor("basic", "bloods"),
    "drugs": Extractor("orders", "orders", lambda: ("medication", "drug")),
    "diagnostics": Extractor("orders", "orders", lambda: ("diagnostic", "diagnostic")),
    "core_02": Extractor("observations", "by_slice", lambda: X.presence_part("core_02_", SATURATION, clean=True)),
    "bed": Extractor("observations", "by_slice", lambda: X.presence_part("bed_", BED)),
    "vte_status": Extractor("observations", "scores", lambda: ({VTE: "vte_status"}, {}, {VTE: VTE_VALUES})),
    "hosp_site": Extractor("observations", "by_slice", lambda: X.flags_part(SITE_TEXTS, False, SITE)),
    "core_resus": Extractor("observations", "by_slice", lambda: X.counts_part(RESUS_TEXTS, RESUS)),
    "news": Extractor("observations", "scores", lambda: (SCORES, SCORE_LIMITS, {})),
    "smoking": Extractor("observations", "by_slice", lambda: X.flags_part(SMOKING_TEXTS, False, SMOKING)),
    "covid": Extractor("basic", "by_slice", lambda: X.positive_part("covid_positive")),
    "appointments": Extractor("appointments", "appointments", lambda: {"consultant": "ConsultantCode_", "clinic": "ClinicCode_", "kind": "AppointmentType_"}),
    "annotations": Extractor("epr", "concepts"),
    "annotations_mrc": Extractor("mct", "concepts"),
    "annotations_reports": Extractor("reports", "concepts"),
    "textual_obs": Extractor("textual_obs", "concepts"),
}
#: Aggregations whose rows lie by client and slice; those of others, which are few or counts, are dealt so.
DEALT = ("bloods", "scores", "by_slice")
DOCUMENT_SOURCES = ("epr", "mct", "reports", "textual_obs")


def register(name: str, extractor: Extractor) -> None:
    """Adds an extractor, or puts another in a name's place."""
    EXTRACTORS[name] = extractor


def long_rows(sources: dict[str, DataFrame], spec: RunSpec, options: dict[str, bool]) -> list[DataFrame]:
    """The rows of the extractors chosen by options (name -> whether), as one DataFrame an aggregation. All lie by client and
    slice, so that Spark deals none of them anew to add them up."""
    if unknown := set(options) - set(EXTRACTORS):
        raise ValueError(f"no such extractors: {sorted(unknown)}")
    chosen: dict[tuple[str, str], list] = {}
    for name, e in EXTRACTORS.items():
        if options.get(name):
            chosen.setdefault(("documents" if e.joint == "concepts" else e.source, e.joint), []).append(e)
    out = []
    for (source, joint), own in chosen.items():
        if source == "documents":  # their concepts add up
            events = None
            for e in own:
                part = sources[e.source].select("client_id", "ts", "pretty_name")
                events = part if events is None else events.unionByName(part)
        else:
            events = sources[source]
        rows = JOINT[joint](events, [e.part() for e in own], spec)
        out.append(rows if joint in DEALT else rows.repartition(*X.KEYS))
    return out


def vectors(sources: dict[str, DataFrame], spec: RunSpec, options: dict[str, bool], clients: DataFrame | None = None) -> DataFrame:
    """client_id, slice_start, features (a map): values of equal features add up. With clients (client_id), each of them
    has a row for every slice, its map empty where nothing happened, and others have none.

    Events are dealt by client and slice once; features, sums and maps are made where they lie.
    """
    parts = long_rows(sources, spec, options)
    if clients is not None:
        parts.append(clients.select("client_id").distinct().withColumn("slice_start", F.explode(F.lit(spec.starts()))).withColumns({"feature": F.lit(None).cast("string"), "value": F.lit(None).cast("double")}).repartition(*X.KEYS))
    return X.packed(X.union_of(parts), clients is not None)
