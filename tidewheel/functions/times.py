"""Columns for timestamps without a zone, which stand for UTC throughout."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000
#: The date forms that text is tried in, first hit wins (one or two digits for day, month and hour).
FORMS = (
    "d/M/yy H.m.s",
    "d/M/yyyy H.m.s",
    "M/d/yy H.m.s",
    "M/d/yyyy H.m.s",
    "d/M/yy H:m:s",
    "d/M/yyyy H:m:s",
    "M/d/yy H:m:s",
    "M/d/yyyy H:m:s",
    "yyyy-M-d H:m:s",
    "yyyy-M-d H.m.s",
    "d-M-yyyy H:m:s",
    "d-M-yyyy H.m.s",
    "yyyy/M/d H:m:s",
    "yyyy/M/d H.m.s",
    "d/M/yy",
    "M/d/yy",
    "d/M/yyyy",
    "M/d/yyyy",
    "yyyy-M-d",
    "yyyy/M/d",
    "d-M-yyyy",
    "d.M.yyyy",
    "d.M.yy",
    "yyyy.M.d",
)
#: Forms beyond the fixed ones: times without seconds, names of months.
MORE_FORMS = ("yyyy-M-d H:m", "d-M-yyyy H:m", "d/M/yyyy H:m", "d-MMM-yyyy H:m", "d-MMM-yyyy", "d MMM yyyy")
#: Texts that stand for no date.
NO_DATE = ("", "nan", "nat", "none", "null")


def ntz(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _in_form(text: Column, form: str) -> Column:
    """Two-digit years are 1969 to 2068."""
    t = F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")
    if "yyyy" in form or "yy" not in form:
        return t
    return F.when(F.year(t) > 2068, t - F.make_interval(F.lit(100))).otherwise(t)


def _may_be(text: Column, bare: Column, form: str) -> Column:
    """Whether a text, and what it has besides digits and plus signs, may be of a form: looked at first, since a form that
    does not fit costs an exception. The year's digits are two or, from four on, any number."""
    if "MMM" in form:
        return text.rlike("[A-Za-z]")
    year = r"^\+?\d{4}" if form.startswith("yyyy") else r"^\d+\D\d+\D\+?\d{4}" if "yyyy" in form else r"^\d+\D\d+\D\d\d(?!\d)" if "yy" in form else ""
    return (bare == re.sub("[A-Za-z]", "", form)) & text.rlike(year)


def parsed(text: Column, forms: tuple[str, ...] = FORMS + MORE_FORMS) -> Column:
    """Text as a timestamp: an ISO instant in UTC (zone offsets count), else the first form that fits, else null."""
    known = lambda f: not set(re.findall("[A-Za-z]+", f)) - {"d", "dd", "M", "MM", "MMM", "yy", "yyyy", "H", "HH", "m", "mm", "s", "ss"}

    def first(s: Column) -> Column:
        said, bare = s["said"], s["bare"]
        iso = F.convert_timezone(F.current_timezone(), F.lit("UTC"), said.try_cast("timestamp").cast("timestamp_ntz"))
        return F.coalesce(iso, *(F.when(_may_be(said, bare, f), _in_form(said, f)) if known(f) else _in_form(said, f) for f in forms))

    # within an array of one, so that the text is trimmed and stripped once and not for each form
    trimmed = F.transform(F.array(F.trim(text)), lambda t: F.struct(F.when(~F.lower(t).isin(*NO_DATE), t).alias("said"), F.translate(t, "+0123456789", "").alias("bare")))
    return F.transform(trimmed, first)[0]


def days_floor(later: Column, earlier: Column) -> Column:
    """Whole days from earlier to later, rounded down also below zero (-36 h is -2)."""
    return F.floor(F.timestamp_diff("MICROSECOND", earlier, later) / DAY)


def stamp(c: Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(c, form)


def plus(c: Column, years: int = 0, months: int = 0, days: int = 0) -> Column:
    return c + F.make_interval(F.lit(years), F.lit(months), F.lit(0), F.lit(days))


def age_at(born: Column, when: Column) -> Column:
    """Full years, birthday-aware."""
    had = F.date_format(when, "MMdd") >= F.date_format(born, "MMdd")
    return F.year(when) - F.year(born) - F.when(had, 0).otherwise(1)
