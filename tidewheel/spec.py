"""What a run needs to know: bounds, step, direction, reference time."""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

#: Slices of a calendar step; a step so small over so long a time is a mistake, and is said to be one.
MOST_SLICES = 10_000


def add(day: date, years: int = 0, months: int = 0, days: int = 0, sign: int = 1) -> date:
    """A calendar step; a day past the month's end falls on its last day."""
    at = day.year * 12 + day.month - 1 + sign * (12 * years + months)
    year, month = divmod(at, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1])) + timedelta(days=sign * days)


@dataclass(frozen=True)
class Span:
    years: int = 0
    months: int = 0
    days: int = 0

    def __post_init__(self) -> None:
        if min(self.years, self.months, self.days) < 0:
            raise ValueError("a span can't be negative")

    def after(self, day: date) -> date:
        return add(day, self.years, self.months, self.days)

    def before(self, day: date) -> date:
        return add(day, self.years, self.months, self.days, -1)

    @property
    def empty(self) -> bool:
        return not (self.years or self.months or self.days)

    @property
    def only_days(self) -> int | None:
        return self.days if not (self.years or self.months) else None


def real_date(year: int, month: int, day: int) -> date:
    """A valid calendar date, also from text parts; raises ValueError otherwise."""
    return date(int(year), int(month), int(day))


@dataclass(frozen=True)
class RunSpec:
    """Slices start at start, one step apart, over span (before start if lookback), clamped to the global bounds.

    as_of stands in for the present in all "days since" features, so that results can be repeated.
    """

    start: date
    span: Span
    step: Span = field(default_factory=lambda: Span(days=1))
    lookback: bool = False
    global_start: date = date(1995, 1, 1)
    global_end: date = date(2100, 1, 1)
    as_of: datetime = datetime(2024, 2, 1)

    def __post_init__(self) -> None:
        if self.step.empty:
            raise ValueError("the step must be positive")
        if self.global_start > self.global_end:  # reversed bounds are taken as meant
            low, high = self.global_end, self.global_start
            object.__setattr__(self, "global_start", low)
            object.__setattr__(self, "global_end", high)

    @property
    def bounds(self) -> tuple[date, date]:
        """First and last day that a slice may start on; the first is later than the last if there is none."""
        first, last = (self.span.before(self.start), self.start) if self.lookback else (self.start, self.span.after(self.start))
        return max(first, self.global_start), min(last, self.global_end)

    @property
    def first(self) -> date:
        return self.bounds[0]

    @property
    def n(self) -> int:
        """How many slices there are; raises ValueError beyond MOST_SLICES calendar steps (steps of whole days have no bound)."""
        first, last = self.bounds
        if self.step.only_days:
            return max(0, (last - first).days // self.step.only_days + 1)
        return len(self.starts())

    def starts(self) -> list[date]:
        """Each start is stepped from the one before it, so that a month's end sticks once it is met."""
        now, last = self.bounds
        out: list[date] = []
        while now <= last:
            if len(out) == MOST_SLICES and not self.step.only_days:
                raise ValueError(f"more than {MOST_SLICES} slices between {out[0]} and {last}")
            out.append(now)
            now = self.step.after(now)
        return out

    def windows(self) -> list[tuple[date, date]]:
        """(start, last day); both days belong to the slice, so neighbours share one."""
        return [(d, self.step.after(d)) for d in self.starts()]


def whole_steps(start: date, span: Span, step: Span) -> int:
    """How many steps fit between start and start + span."""
    if step.empty:
        raise ValueError("the step must be positive")
    n, now, end = 0, step.after(start), span.after(start)
    while now <= end:
        n, now = n + 1, step.after(now)
    return n
