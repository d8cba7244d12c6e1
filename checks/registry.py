"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.compare import plain
from checks.standins import tables
from periodbook.functions.periods import PeriodWindow
from periodbook.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(
        self,
        name: str,
        build: Callable[[Tables], DataFrame],
        sql: str | None = None,
        window: PeriodWindow | None = None,
    ) -> None:
        """``build`` gets the stand-in tables of the data folder, with the joined rows of ``window`` kept if given."""
        if name in self.queries:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(tables(spark, sf_dir, window)))

        self.queries[name] = run
        if sql is not None:
            self.oracle[name] = sql
