"""Unions that relabel or extend a result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(first: DataFrame, *more: DataFrame) -> DataFrame:
    """``UNION ALL`` with columns matched by name."""
    for df in more:
        first = first.unionByName(df)
    return first


def append_comparison(
    df: DataFrame, period: str, label: str, source: date, shown_as: date
) -> DataFrame:
    """Label each row with its period and append a copy of one older period under
    a label of its own, so a report shows it next to the current periods.

    Each row is unfolded into its labels, so ``df`` is computed once.
    """
    labels = F.when(
        F.col(period) == F.lit(source), F.array(F.col(period), F.lit(shown_as).cast(df.schema[period].dataType))
    ).otherwise(F.array(F.col(period)))
    return df.select(F.explode(labels).alias(label), *df.columns)
