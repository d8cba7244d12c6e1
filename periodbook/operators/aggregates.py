"""Aggregate building blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.scalars import as_money, exact_avg, safe_div
from periodbook.operators.distincts import distinct_counts


def sum_when(cond: Column, value: Column | str) -> Column:
    """Conditional sum; 0 when nothing matches."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))


def sum_only(cond: Column, value: Column | str) -> Column:
    """Conditional sum without an else branch: NULL when nothing matches."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, v))


def avg_when(cond: Column, value: Column | str) -> Column:
    """Mean of the matching rows; NULL when nothing matches."""
    v = F.col(value) if isinstance(value, str) else value
    return exact_avg(F.when(cond, v))


def sum_or_zero(value: Column | str, places: int | None = None) -> Column:
    """Sum with NULL read as 0, each value rounded first if ``places`` is given."""
    v = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))
    return F.sum(v if places is None else F.round(v, places))


def ratio_of_sums(num: Column | str, den: Column | str) -> Column:
    return safe_div(F.sum(num), F.sum(den))


def ratio_pivot(
    df: DataFrame,
    keys: Sequence[str],
    members: Mapping[str, Column],
    num: str,
    den: str,
    suffix: str = "",
) -> DataFrame:
    """Ratio of sums for every member condition, one column per member."""
    return df.groupBy(*keys).agg(
        *(
            safe_div(sum_only(cond, num), sum_only(cond, den)).alias(f"{name}{suffix}")
            for name, cond in members.items()
        )
    )


def max_then_sum(
    df: DataFrame, keys: Sequence[str], entity: str, value: str, out: str
) -> DataFrame:
    """Value repeated on each row of an entity: take it once, then sum per group."""
    once = df.groupBy(*keys, entity).agg(F.max(value).alias("_once"))
    return once.groupBy(*keys).agg(F.sum("_once").alias(out))


def share_of_total(df: DataFrame, period: str, value: str, out: str) -> DataFrame:
    """Each row's part of its period's total; NULL when the total is 0 or NULL.

    ``df`` is aggregated (a handful of rows per period), so the window is small.
    """
    total = F.sum(value).over(Window.partitionBy(period))
    return df.withColumn(out, safe_div(F.col(value), total))


def with_company_total(
    df: DataFrame,
    key: Mapping[str, object],
    group: Sequence[str],
    measures: Sequence[Column],
) -> DataFrame:
    """Aggregate by ``group`` and add the company row of each period.

    The company row is computed from the same rows, not from the regional results,
    so distinct counts stay right.  ``key`` gives the constant member values.
    Each row is unfolded into its own and the company's entry, so ``df`` is computed
    once; both entries meet the map-side combine before anything is shuffled.
    """
    types = {f.name: f.dataType for f in df.schema}
    own = F.struct(*(F.col(k).alias(k) for k in key))
    company = F.struct(*(F.lit(v).cast(types[k]).alias(k) for k, v in key.items()))
    others = [F.col(c) for c in df.columns if c not in key]
    rows = df.select(*others, F.inline(F.array(own, company)))
    return rows.groupBy(*group).agg(*measures)


def add_company_row(
    df: DataFrame,
    period: str,
    region: str,
    measures: Sequence[str],
    apart: Sequence[str] = (),
) -> DataFrame:
    """Sums per region and the company row as the sum of the regions' rows.

    For additive measures only.  ``apart`` names columns that keep a region's rows
    separate (and are dropped); the company row sums over all of them.
    """
    types = {f.name: f.dataType for f in df.schema}
    own = F.struct(F.col(region), *(F.col(a) for a in apart))
    company = F.struct(
        F.lit(dim.COMPANY).cast(types[region]).alias(region),
        *(F.lit(None).cast(types[a]).alias(a) for a in apart),
    )
    rows = df.select(period, *measures, F.inline(F.array(own, company)))
    return (
        rows.groupBy(period, region, *apart)
        .agg(*(F.sum(m).alias(m) for m in measures))
        .drop(*apart)
    )


def net_promoter_scores(
    df: DataFrame, keys: Sequence[str], members: Mapping[str, Column | None]
) -> DataFrame:
    """(promoters - detractors) per 100 distinct responses, one column per member."""
    always = F.lit(True)
    score = F.coalesce("promoter_flag", F.lit(0)) - F.coalesce("detractor_flag", F.lit(0))
    both = distinct_counts(
        df,
        keys,
        {"response_id": {f"_n_{name}": cond for name, cond in members.items()}},
        {
            f"_net_{name}": F.when(always if cond is None else cond, score).otherwise(F.lit(0))
            for name, cond in members.items()
        },
    )
    return both.select(
        *keys,
        *(
            F.round(safe_div(F.col(f"_net_{m}") * 100.0, F.col(f"_n_{m}")), 0).alias(m)
            for m in members
        ),
    )


def one_minus_ratio(bad: Column, total: Column) -> Column:
    return F.lit(1.0) - safe_div(bad, total)


def blend_by_days(now: Column, other: Column, days_now: Column, days: int = 7) -> Column:
    """Mean of two plan values weighted by days."""
    return safe_div(now * days_now + (F.lit(days) - days_now) * other, F.lit(days))


def lifetime_value(
    df: DataFrame, keys: Sequence[str], week: str, value: str, last_week: int, tail_weeks: int
) -> DataFrame:
    """Sum of the weekly values plus ``tail_weeks`` times the last week's value.

    Groups without a row for the last week are dropped, as an inner join would.
    """
    totals = df.groupBy(*keys).agg(
        F.sum(as_money(value)).alias("_sum"),
        F.max(F.when(F.col(week) == last_week, F.lit(1))).alias("_has_last"),
        F.max(F.when(F.col(week) == last_week, as_money(value))).alias("_last"),
    )
    return totals.filter(F.col("_has_last") == 1).select(
        *keys, as_money(F.col("_sum") + F.lit(tail_weeks) * F.col("_last")).alias("ltv")
    )
