"""Period keys (columns) and period windows (driver-side dates).

Weeks start on Sunday.  Window bounds are plain ``datetime.date`` values worked
out once on the driver, so they reach the scan as literals and can be pushed
down; nothing here reads the wall clock.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

Unit = Literal["week", "month", "quarter"]
UNITS: tuple[Unit, ...] = ("week", "month", "quarter")


# --- column expressions -----------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(c: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(c)) - 1


def week_start(c: Column | str) -> Column:
    """The Sunday on or before the date: step back by the day of the week."""
    d = _col(c).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_start_by_trunc(c: Column | str) -> Column:
    """Same key through a Monday-start truncation shifted by one day."""
    return F.date_sub(F.trunc(F.date_add(_col(c).cast("date"), 1), "week"), 1)


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def quarter_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "quarter")


def period_key(c: Column | str, unit: Unit) -> Column:
    """Week, month or quarter key; the unit is resolved here, not per row."""
    if unit == "week":
        return week_start(c)
    if unit == "month":
        return month_start(c)
    if unit == "quarter":
        return quarter_start(c)
    raise ValueError(f"unknown period unit: {unit!r}")


def split_cutover(week: Column | str, day: Column | str, cutover_week: date) -> Column:
    """Daily key inside one named week, weekly key everywhere else."""
    return F.when(_col(week) == F.lit(cutover_week), _col(day)).otherwise(_col(week))


def reroll_cutover(key: Column | str, cutover_week: date) -> Column:
    """Fold the daily keys of the cutover week back to the week."""
    in_week = _col(key).between(F.lit(cutover_week), F.lit(cutover_week + timedelta(days=6)))
    return F.when(in_week, week_start(key)).otherwise(_col(key))


# --- driver-side dates ------------------------------------------------------


def floor_date(d: date, unit: Unit) -> date:
    if unit == "week":
        return d - timedelta(days=d.isoweekday() % 7)
    if unit == "month":
        return d.replace(day=1)
    return date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)


def shift_date(d: date, unit: Unit, n: int) -> date:
    """Move a period start by ``n`` periods."""
    if unit == "week":
        return d + timedelta(weeks=n)
    months = d.year * 12 + d.month - 1 + n * (3 if unit == "quarter" else 1)
    return date(months // 12, months % 12 + 1, d.day)


@dataclass(frozen=True)
class PeriodWindow:
    """Inclusive range of period starts, plus an optional comparison period."""

    unit: Unit
    lo: date
    hi: date
    anchor: date | None = None

    def holds(self, period: Column | str) -> Column:
        p = _col(period)
        inside = p.between(F.lit(self.lo), F.lit(self.hi))
        return inside if self.anchor is None else inside | (p == F.lit(self.anchor))

    @property
    def spans(self) -> list[tuple[date, date]]:
        """Day ranges (end excluded) that the periods cover: the window's, and the comparison period's where it lies apart."""
        lo, end = self.lo, shift_date(self.hi, self.unit, 1)
        if self.anchor is None:
            return [(lo, end)]
        # the anchor is a Sunday: only a period that starts there can equal it
        after = shift_date(floor_date(self.anchor, self.unit), self.unit, 1)
        if self.anchor <= end and after >= lo:
            return [(min(lo, self.anchor), max(end, after))]
        return [(self.anchor, after), (lo, end)]

    def holds_day(self, day: Column | str) -> Column:
        """Days implied by :meth:`holds`, as plain ranges; redundant, so that scans can prune."""
        d = _col(day)
        return reduce(lambda x, y: x | y, ((d >= F.lit(a)) & (d < F.lit(b)) for a, b in self.spans))

    def may_hold_text(self, day: Column | str) -> Column:
        """Texts of days that may lie in the window, as plain comparisons of text, so that scans can prune.

        Left out is only what sorts as an ISO date of another period: from 1900 to the window, and
        from the window to 2100. Texts that are no ISO dates of other years, and other spellings of the window's
        own years, stay in and are read (or fail) as before.
        """
        d, (lo, hi) = _col(day), (self.spans[0][0], self.spans[-1][1])
        inside = reduce(lambda x, y: x | y, ((d >= a.isoformat()) & (d < b.isoformat()) for a, b in self.spans))
        own_year = reduce(
            lambda x, y: x | y,
            ((d >= f"{year:04d}.") & (d < f"{year + 1:04d}-") for year in range(lo.year, hi.year + 1)),
        )
        return inside | own_year | (d < "1900-") | (d >= "2100-")


def trailing(as_of: date, unit: Unit, n: int) -> PeriodWindow:
    """The last ``n`` complete periods before the one that holds ``as_of``."""
    here = floor_date(as_of, unit)
    return PeriodWindow(unit, shift_date(here, unit, -n), shift_date(here, unit, -1))


def monday_rule_start(as_of: date, unit: Unit) -> date:
    """Current period start as the scorecard reckons it.

    For weeks this is the day before the ISO Monday, so on a Sunday it still
    names the week that has just ended (one week behind :func:`floor_date`).
    """
    if unit == "week":
        return as_of - timedelta(days=as_of.weekday() + 1)
    return floor_date(as_of, unit)


def scorecard_window(as_of: date, unit: Unit, n: int = 14) -> PeriodWindow:
    """``n`` complete periods and the week 53 weeks before the current one."""
    here = monday_rule_start(as_of, unit)
    return PeriodWindow(
        unit, shift_date(here, unit, -n), shift_date(here, unit, -1), same_week_last_year(as_of)
    )


def same_week_last_year(as_of: date) -> date:
    return monday_rule_start(as_of, "week") - timedelta(weeks=53)


def coarse_day_bound(as_of: date, unit: Unit, n: int = 14, slack_days: int = 20) -> date:
    """Loose lower bound on a raw date, for partition pruning.

    The rule is "after bound A or after bound B", which is one bound: the lesser.
    """
    window_bound = scorecard_window(as_of, unit, n).lo - timedelta(days=slack_days)
    year_bound = monday_rule_start(as_of, "week") - timedelta(weeks=55)
    return min(window_bound, year_bound)


def comparison_period(as_of: date, unit: Unit, lookback: int) -> date:
    """Period start ``lookback`` periods before the current one."""
    return shift_date(monday_rule_start(as_of, unit), unit, -lookback)


def is_immature(as_of: date, ages: tuple[int, ...] = (8,)) -> bool:
    """True while the last complete week is too young for its refunds to be in."""
    last_week = shift_date(floor_date(as_of, "week"), "week", -1)
    return (as_of - last_week).days in ages
