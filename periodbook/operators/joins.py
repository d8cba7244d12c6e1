"""Join shapes of the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def left_filtered(left: DataFrame, right: DataFrame, cond: Column) -> DataFrame:
    """Left join that keeps every left row, also those failing a left-side predicate."""
    return left.join(right, cond, "left")


def full_outer_zero(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """Full outer join on named keys; keys coalesced, missing measures read 0.

    NULL keys never match (plain equality).
    """
    joined = left.join(right, list(keys), "full")
    return joined.select(
        *keys, *(F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures)
    )


def attach_to_segment(
    base: DataFrame,
    period: str,
    segment_col: str,
    segment: str,
    extras: Sequence[tuple[DataFrame, str]],
    unbounded: Sequence[tuple[DataFrame, str]] = (),
) -> DataFrame:
    """Attach period-level results to the rows of one segment only.

    ``extras`` are ``(frame, its period column)`` aggregated to one row per period of
    the window (some fifteen rows), hence the broadcast.  Frames whose rows per period
    depend on a sheet go into ``unbounded``; for them Spark picks the join by size.
    """
    for frames, bounded in ((extras, True), (unbounded, False)):
        for extra, key in frames:
            cond = (base[period] == extra[key]) & (base[segment_col] == F.lit(segment))
            right = F.broadcast(extra) if bounded else extra
            base = base.join(right, cond, "left").drop(extra[key])
    return base


def value_of_member(
    value: Column | str, member: Column, period: str
) -> Column:
    """One member's value repeated on every row of its period (role self-join)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(member, v)).over(Window.partitionBy(period))


def interval_map(
    intervals: DataFrame,
    key: str,
    start: str,
    end: str,
    keep: Sequence[str],
    out: str = "_spans",
    by: str = "day",
) -> DataFrame:
    """One row per ``key`` and day: the intervals that touch the day as an array in order of their starts.

    Columns ``_key``, ``_day`` and ``out``, an array of structs of ``start``, ``end`` and ``keep``.
    The map of a day is as long as the day has intervals, however many a key has in all.
    With ``by="month"`` there is a row per month, whose first day is ``_day``: long intervals
    are listed under some months instead of each of their days.
    """
    if by not in ("day", "month"):
        raise ValueError(f"an interval map is by day or month, not {by!r}")
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    if by == "month":
        days = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
    else:
        days = F.sequence(first, last)
    return (
        intervals.filter(F.col(start) < F.col(end))
        .select(
            F.col(key).alias("_key"),
            F.explode(days).alias("_day"),
            F.struct(F.col(start).alias("start"), F.col(end).alias("end"), *keep).alias("_span"),
        )
        .groupBy("_key", "_day")
        .agg(F.sort_array(F.collect_list("_span")).alias(out))
    )


def covering(spans: Column, at: Column) -> Column:
    """The elements of ``spans`` (sorted by ``start``) with ``start <= at < end``.

    A binary search finds how many have begun; only their ends are looked at.
    """
    steps = F.array(*(F.lit(1 << k) for k in range(20, -1, -1)))
    begun = F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(
            (n + step <= F.size(spans)) & (F.get(spans, n + step - 1)["start"] <= at), n + step
        ).otherwise(n),
    )
    return F.filter(F.slice(spans, F.lit(1), begun), lambda s: s["end"] > at)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    event_time: str,
    start: str,
    end: str,
    keep: Sequence[str],
    when: Column | None = None,
) -> DataFrame:
    """Left join on equal keys and ``start <= event_time < end``.

    A left row joins every interval that covers it; ``when`` limits which left rows
    may match at all.  ``keep`` names the right columns to bring along.

    Each interval is listed under the days it touches and the join is on keys *and day*, so
    a key that holds much of the data is spread over its days and an event only meets the
    intervals of its day.  There is no hint: whether the intervals are broadcast is decided
    by their size, statically or once it is known at run time.
    """
    cols = [*dict.fromkeys([*on.values(), start, end, *keep])]
    r = right.filter(F.col(start) < F.col(end)).select(
        *(F.col(c).alias(f"_r_{c}") for c in cols)
    )
    cond = (F.col(event_time) >= F.col(f"_r_{start}")) & (
        F.col(event_time) < F.col(f"_r_{end}")
    )
    for lcol, rcol in on.items():
        cond = cond & (F.col(lcol) == F.col(f"_r_{rcol}"))
    if when is not None:
        cond = cond & when
    days = F.sequence(F.col(f"_r_{start}").cast("date"), F.col(f"_r_{end}").cast("date"))
    by_day = r.withColumn("_r_day", F.explode(days))
    joined = left.join(by_day, cond & (F.col(event_time).cast("date") == F.col("_r_day")), "left")
    return joined.select(*left.columns, *(F.col(f"_r_{c}").alias(c) for c in keep))
