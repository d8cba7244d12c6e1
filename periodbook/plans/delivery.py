"""Delivery cost by region: dispatched routes, shipped mail orders, company total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import PeriodWindow, period_key
from periodbook.functions.scalars import strict_cast
from periodbook.operators.aggregates import add_company_row, max_then_sum
from periodbook.sources.tables import pruned_scan

PLAN_TYPE = "grocery"


def delivery_cost(
    dispatch: DataFrame, shipments: DataFrame, window: PeriodWindow, period: str
) -> DataFrame:
    """Per period and region, mail order as region 3, with the company row.

    A mail order's rate is repeated on each of its shipment rows and is taken once.
    Mail-order rows are appended, not merged: a dispatched region 3 stays a row apart.
    """
    local = (
        pruned_scan(
            dispatch.withColumn(period, period_key("delivery_date", window.unit)),
            F.col(period),
            window,
            day="delivery_date",
        )
        .filter(F.col("delivery_plan_type") == PLAN_TYPE)
        .groupBy(period, "sales_region_id")
        .agg((F.sum("total_delivery_cost") + F.sum("linehaul_cost")).alias("delivery_cost"))
        .withColumn("kind", F.lit("dispatch"))
    )
    # the text's own range reaches the scan, the parsed day's cannot
    shipped = shipments.filter(window.may_hold_text("deal_delivery_date")).withColumn("_day", strict_cast("deal_delivery_date", "date"))
    shipped = pruned_scan(
        shipped.withColumn(period, period_key("_day", window.unit)),
        F.col(period),
        window,
        day="_day",
    )
    mail = max_then_sum(shipped, [period], "wms_order_id", "rate", "delivery_cost").select(
        period,
        F.lit(dim.MAIL_ORDER).cast("bigint").alias("sales_region_id"),
        "delivery_cost",
        F.lit("mail").alias("kind"),
    )
    return add_company_row(
        local.unionByName(mail), period, "sales_region_id", ["delivery_cost"], apart=["kind"]
    )
