"""Sheets kept by hand: union of same-shape sheets and typing of text columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook.functions.scalars import month_from_label, number_from_text, strict_cast


def union_sheets(sheets: Iterable[DataFrame]) -> DataFrame:
    """All rows of the sheets; columns are matched by name, duplicates are kept."""
    return reduce(DataFrame.unionByName, sheets)


@dataclass(frozen=True)
class SheetSpec:
    """How to type a text sheet.

    ``numbers`` maps an output column to its text column; ``absolute`` drops signs.
    ``period`` is (output, text column); ``month_labels`` says the text is a month
    label (``Mar'00``) and drops rows without an apostrophe, else it is a date.
    """

    period: tuple[str, str]
    numbers: dict[str, str]
    keep: Sequence[str | Column] = ()
    required: Sequence[str] = field(default_factory=tuple)
    absolute: bool = False
    month_labels: bool = False


def split_rejects(df: DataFrame, spec: SheetSpec) -> tuple[DataFrame, DataFrame]:
    """The rows of a sheet that :func:`parse_sheet` can type, and the others with the reason.

    The second frame has the sheet's columns, ``reason`` (each unreadable cell as ``column: text``) and
    ``rejects``, how many rows have the same reason.  Nothing fails: a report can be made of
    the first frame while the second is sent back to whoever keeps the sheet.
    """
    out, text = spec.period
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    if spec.month_labels:
        label = F.when(F.col(text).contains("'"), blank(text))
        bad_period = label.isNotNull() & F.try_to_date(F.concat(F.lit("01 "), F.regexp_replace(label, r"[' ]+", " ")), "dd MMM yy").isNull()
    else:
        bad_period = blank(text).isNotNull() & blank(text).try_cast("date").isNull()
    bad = {text: bad_period} | {
        c: blank(c).isNotNull() & blank(c).try_cast("double").isNull() for c in spec.numbers.values()
    }
    unused = F.lit(False)  # rows that parsing leaves out are no rejects
    for c in spec.required:
        unused = unused | F.coalesce(F.col(c) == "", F.lit(True))
    if spec.month_labels:
        unused = unused | ~F.coalesce(F.col(text).contains("'"), F.lit(False))
    cells = F.filter(
        F.array(*(F.when(cond, F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c, cond in bad.items())),
        lambda cell: cell.isNotNull(),
    )
    marked = df.withColumn("_cells", F.when(unused, F.array().cast("array<string>")).otherwise(cells))
    good = marked.filter(F.size("_cells") == 0).drop("_cells")
    failed = marked.filter(F.size("_cells") > 0).withColumn("reason", F.concat_ws("; ", "_cells")).drop("_cells")
    counts = failed.groupBy("reason").agg(F.count(F.lit(1)).alias("rejects"))
    return good, failed.join(counts, "reason").select(*df.columns, "reason", "rejects")


def parse_sheet(df: DataFrame, spec: SheetSpec) -> DataFrame:
    for c in spec.required:  # an empty cell marks a row that is not filled in
        df = df.filter(F.col(c) != "")
    out, text = spec.period
    if spec.month_labels:
        df = df.filter(F.col(text).contains("'"))
        period = month_from_label(text)
    else:
        period = strict_cast(text, "date")

    def number(c: str) -> Column:
        n = number_from_text(c)
        return F.abs(n) if spec.absolute else n

    return df.select(
        *spec.keep,
        period.alias(out),
        *(number(c).alias(name) for name, c in spec.numbers.items()),
    )
