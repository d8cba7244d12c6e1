"""Results: column contract, order, and partitioned Parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def report_result(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The report as delivered: fixed column positions, sorted."""
    return df.select(*columns).orderBy(*order_by)


def write_report(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Store a report; with a partition column, rerunning a period replaces only that period."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
