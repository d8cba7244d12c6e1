"""Row classifications shared by the reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook import dimensions as dim


def is_pantry(biz_type: str = "biz_type") -> Column:
    return F.lower(biz_type).contains("pantry")


def fold_region(
    df: DataFrame, region_id: str = "sales_region_id", title: str = "sales_region_title"
) -> DataFrame:
    """Replace the region pair by mail order for mail-order-fresh and pantry rows."""
    mail = (F.col(region_id) == dim.MAIL_ORDER_FRESH) | is_pantry()
    return df.withColumns(
        {
            region_id: F.when(mail, F.lit(dim.MAIL_ORDER)).otherwise(F.col(region_id)),
            title: F.when(mail, F.lit(dim.MAIL_ORDER_TITLE)).otherwise(F.col(title)),
        }
    )


def bucket_conditions() -> dict[str, Column]:
    """Scorecard bucket -> condition on region title and business type.

    The conditions exclude each other.  A NULL business type can only meet the
    mail-order condition (through the title), as ``NOT (NULL)`` is not true.
    """
    title = F.col("sales_region_title")
    local = {b: (title == t) & ~is_pantry() for b, t in dim.BUCKET_TITLES.items()}
    return local | {"mo": title.isin(*dim.MAIL_ORDER_TITLES) | is_pantry()}


def region_bucket() -> Column:
    """The bucket as a label; NULL for rows outside every bucket."""
    return F.coalesce(*(F.when(cond, F.lit(b)) for b, cond in bucket_conditions().items()))


def in_buckets(column: str = "bucket") -> dict[str, Column]:
    """Bucket -> condition, once the label has been computed: the text tests run
    once per row instead of once per output column."""
    return {b: F.col(column) == b for b in dim.BUCKETS}


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)
