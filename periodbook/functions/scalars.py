"""Scalar helpers for the places where a plain built-in would change a result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
MONEY = "decimal(24,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Double division; a zero or NULL denominator gives NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def as_money(c: Column | str) -> Column:
    """Fix a computed amount to six places so that its sum has one value
    whatever the order in which the tasks deliver rows."""
    return _col(c).cast(MONEY)


def exact_avg(c: Column | str) -> Column:
    """Mean over the non-NULL values, summed as decimals (order-independent)."""
    v = _col(c)
    return safe_div(F.sum(as_money(v)), F.count(v))


def lookup(key: Column | str, table: Mapping, default: Column | None = None) -> Column:
    """Small fixed lookup as an expression: no join, stays in generated code.

    Values of ``table`` are lists of keys; an unlisted key gives ``default`` (NULL).
    """
    k = _col(key)
    out = None
    for value, members in table.items():
        hit = k.isin(*members)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out if default is None else out.otherwise(default)


def part_of(c: Column | str, sep: str, n: int) -> Column:
    """``n``-th field, trailing blanks ignored (warehouse comparison rule)."""
    return F.rtrim(F.split_part(_col(c), F.lit(sep), F.lit(n)))


def whole_div(c: Column | str, n: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", _col(c).cast("bigint"), F.lit(n).cast("bigint"))


def utc_to_local(ts: Column | str, zone: str) -> Column:
    """UTC wall clock to local wall clock; independent of the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts).cast("timestamp_ntz"))


def epoch_to_local(seconds: Column | str, zone: str) -> Column:
    utc = F.timestamp_add("SECOND", _col(seconds).cast("bigint"), F.expr(EPOCH))
    return utc_to_local(utc, zone)


def month_from_label(c: Column | str) -> Column:
    """First day of a month written like ``Mar'00`` or ``Mar 00``.

    Two-digit years from 70 on belong to the last century.
    """
    text = F.nullif(F.trim(_col(c)), F.lit(""))
    tidy = F.regexp_replace(text, r"[' ]+", " ")
    label = F.when(text.contains("'"), text)  # other texts, such as a total's, are no month
    d = _readable(label, F.try_to_date(F.concat(F.lit("01 "), tidy), "dd MMM yy"), "date")
    return F.when(F.year(d) >= 2070, F.add_months(d, -1200)).otherwise(d)


def number_from_text(c: Column | str) -> Column:
    """Number held as text; blank gives NULL, anything else must be a number."""
    return strict_cast(c, "double")


def strict_cast(c: Column | str, kind: str) -> Column:
    """Typed text: blank gives NULL, text that does not parse fails the job instead of losing its row."""
    text = F.nullif(F.trim(_col(c).cast("string")), F.lit(""))
    return _readable(text, text.try_cast(kind), kind)


def _readable(text: Column, value: Column, kind: str) -> Column:
    error = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    return F.when(text.isNotNull() & value.isNull(), error).otherwise(value)
