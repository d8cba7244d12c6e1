"""Rank and lag operators.  They run on aggregated rows or sheets, never on facts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodbook.functions.periods import month_start


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest period.

    Same rows as ``dense_rank() over (order by period desc) = 1`` without a window
    that would pull every row into one task: a one-row maximum joined back.
    """
    newest = df.agg(F.max(period).alias(period))
    return df.join(F.broadcast(newest), period).select(*df.columns)


def rank_newest(df: DataFrame, member: str, period: str, out: str = "rn") -> DataFrame:
    """Dense rank of periods inside each member, newest first.

    The rank is taken over the distinct (member, period) pairs and joined back, so
    a member with many rows per period is never sorted in one task.
    """
    pairs = df.select(member, period).distinct()
    w = Window.partitionBy(member).orderBy(F.col(period).desc())
    ranks = pairs.withColumn(out, F.dense_rank().over(w))
    r = ranks.select(
        F.col(member).alias("_m"), F.col(period).alias("_p"), F.col(out)
    )
    cond = df[member].eqNullSafe(r["_m"]) & df[period].eqNullSafe(r["_p"])
    return df.join(r, cond).select(*df.columns, out)


def week_rank_in_month(
    df: DataFrame, week: str, out: str = "rk", present: DataFrame | None = None
) -> DataFrame:
    """Dense rank of the weeks present in each month, newest first.

    Ranked over the distinct weeks (some fifty a year) and joined back.  ``present``
    gives the weeks where they can be had for less than by computing ``df`` twice.
    """
    weeks = (df if present is None else present).select(week).distinct()
    w = Window.partitionBy(month_start(week)).orderBy(F.col(week).desc())
    ranks = weeks.withColumn(out, F.dense_rank().over(w))
    return df.join(F.broadcast(ranks), week).select(*df.columns, out)


def with_lag(df: DataFrame, value: str, member: str, period: str, out: str) -> DataFrame:
    w = Window.partitionBy(member).orderBy(period)
    return df.withColumn(out, F.lag(value, 1).over(w))


def carry_prior(
    value: str,
    member: str,
    period: str,
    newest: date,
    otherwise: str | None = None,
) -> Column:
    """Previous period's value on the newest period's row, own value elsewhere."""
    w = Window.partitionBy(member).orderBy(period)
    return F.when(F.col(period) == F.lit(newest), F.lag(value, 1).over(w)).otherwise(
        F.col(otherwise or value)
    )


def carry_all(
    df: DataFrame,
    measures: Mapping[str, str],
    member: str,
    period: str,
    newest: date,
) -> DataFrame:
    """:func:`carry_prior` for several measures: output -> column used elsewhere."""
    return df.withColumns(
        {out: carry_prior(out, member, period, newest, other) for out, other in measures.items()}
    )
