"""Reading: declared schemas, lazily opened table sets, period-pruned scans, calendar."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from periodbook.functions.periods import PeriodWindow, month_start, quarter_start, week_start
from periodbook.sources.schemas import SCHEMAS
from periodbook.sources.sheets import union_sheets


def read_table(
    spark: SparkSession, base_dir: str, name: str, schema: StructType | str | None = None
) -> DataFrame:
    """Parquet table ``<base_dir>/<name>.parquet`` (file or directory), declared schema.

    With a schema the read needs no footer inference and fails on a type clash, but a
    column that the files lack is NULL: check with :func:`conform` where that matters.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base_dir}/{name}.parquet")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check a frame against the contract of table ``name`` and cast to its types."""
    want = StructType.fromDDL(SCHEMAS[name])
    missing = [f.name for f in want if f.name not in df.columns]
    if missing:
        raise ValueError(f"table {name!r} lacks columns {missing}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in want))


class Tables:
    """Named inputs of the reports, opened on first use.

    ``openers`` maps a table name of :data:`SCHEMAS` to a function that returns
    its frame, so a report only touches the tables it needs.
    """

    def __init__(
        self,
        openers: Mapping[str, Callable[[], DataFrame]],
        many: Callable[[Sequence[str]], DataFrame] | None = None,
    ):
        self._openers = dict(openers)
        self._many = many
        self._open: dict[str, DataFrame] = {}

    @classmethod
    def from_dir(cls, spark: SparkSession, base_dir: str) -> Tables:
        return cls(
            {
                n: (lambda n=n: conform(read_table(spark, base_dir, n), n))
                for n in SCHEMAS
            },
            lambda names: conform(
                spark.read.parquet(*(f"{base_dir}/{n}.parquet" for n in names)), names[0]
            ),
        )

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Tables:
        """``names`` maps a table name here to one known to the session catalog."""
        return cls({n: (lambda n=n, t=t: conform(spark.table(t), n)) for n, t in names.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def stacked(self, names: Sequence[str]) -> DataFrame:
        """All rows of tables of one shape: one scan of all paths in a folder of files, else a union."""
        if len({SCHEMAS.get(n) for n in names}) > 1:
            raise ValueError(f"tables {list(names)} differ in their columns")
        if self._many is not None and len(names) > 1:
            return self._many(names)
        return union_sheets(self[n] for n in names)

    def __contains__(self, name: str) -> bool:
        return name in self._openers


def pruned_scan(
    df: DataFrame,
    period: Column,
    window: PeriodWindow,
    raw_date: str | None = None,
    not_before: date | None = None,
    day: str | None = None,
) -> DataFrame:
    """Rows of the window's periods.

    ``raw_date >= not_before`` is the loose bound of the report (it also decides
    which rows count when the raw date is not the day behind the period).  ``day``
    names the date the period is derived from: the window's day range is then added
    as well.  Both are plain comparisons with literals, so partition pruning and
    row-group statistics apply; a predicate on a truncated date reaches neither.
    """
    if day is not None:
        df = df.filter(window.holds_day(day))
    if raw_date is not None and not_before is not None:
        df = df.filter(F.col(raw_date) >= F.lit(not_before))
    return df.filter(window.holds(period))


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last`` of the one-row frame ``bounds``."""
    days = bounds.select(F.explode(F.sequence(first, last)).alias("cal_date"))
    return days.select(
        "cal_date",
        week_start("cal_date").alias("week_begin_date"),
        month_start("cal_date").alias("month_begin_date"),
        quarter_start("cal_date").alias("quarter_begin_date"),
    )


def calendar_between(spark: SparkSession, lo: date, hi: date) -> DataFrame:
    one = spark.range(1).select(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    return calendar(one, "lo", "hi")
