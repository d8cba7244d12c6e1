"""Monthly P&L: net revenue, rate costs, delivery and labour per region and company."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.functions.periods import trailing
from periodbook.plans import delivery, labor, rates, revenue
from periodbook.sources.sinks import report_result
from periodbook.sources.tables import Tables

COLUMNS = (
    "delivery_month", "sales_region_id", "sales_region_title", "rebate_rate", "new_user",
    "active_user", "gross_rev", "total_coupon_rev", "new_user_coupon", "coupon_rev",
    "refund_rev", "oos_rev", "cogs_rev", "net_rev", "inbound_rev", "processing_rev",
    "packaging_rev", "cs_rev", "warehouse_rev", "misc_rev", "ops_rev", "delivery_cost",
    *labor.MONTHLY_MEASURES,
)


def order_grain_base(t: Tables, as_of: date) -> DataFrame:
    return revenue.order_grain(t["order_product"], "delivery_month", trailing(as_of, "month", 1))


def net_revenue(t: Tables, as_of: date) -> DataFrame:
    return revenue.monthly_net_revenue(order_grain_base(t, as_of))


def rate_costs(t: Tables, as_of: date) -> DataFrame:
    reported = rates.reported_rates_latest(t["monthly_actual_pl"], as_of)
    return rates.monthly_rate_costs(net_revenue(t, as_of), reported)


def delivery_cost(t: Tables, as_of: date) -> DataFrame:
    return delivery.delivery_cost(
        t["dispatch_performance"], t["mail_order_shipment"],
        trailing(as_of, "month", 1), "delivery_month",
    )


def labor_base(t: Tables, as_of: date, cutover: labor.Cutover = labor.CUTOVER) -> DataFrame:
    return labor.labor_allocation_base(
        t["labor_cost_detail"], t["order_product"], [t["nj_labor"], t["chi_labor"]],
        as_of, cutover,
    )


def labor_final(t: Tables, as_of: date, cutover: labor.Cutover = labor.CUTOVER) -> DataFrame:
    return labor.labor_final_by_region(
        labor_base(t, as_of, cutover), t["labor_cost_detail"], trailing(as_of, "month", 1)
    )


def labor_rollup(t: Tables, as_of: date, cutover: labor.Cutover = labor.CUTOVER) -> DataFrame:
    return labor.labor_period_rollup(labor_final(t, as_of, cutover))


def monthly_pnl(
    t: Tables,
    as_of: date,
    cutover: labor.Cutover = labor.CUTOVER,
    corrected: bool = False,
) -> DataFrame:
    """The report, ordered by region.

    Labour is looked up through the delivery row, so a region without delivery cost
    shows no labour either; ``corrected`` looks it up by region directly.
    """
    keys = ["delivery_month", "sales_region_id"]
    sales = rate_costs(t, as_of)
    cost = delivery_cost(t, as_of).withColumn("_delivered", F.lit(True))
    work = labor_rollup(t, as_of, cutover)
    joined = sales.join(cost, keys, "left")
    if corrected:
        joined = joined.join(work, keys, "left")
    else:
        w = work.select(*(F.col(k).alias(f"_w_{k}") for k in keys), *labor.MONTHLY_MEASURES)
        cond = F.col("_delivered") & (joined["delivery_month"] == w["_w_delivery_month"]) & (
            joined["sales_region_id"] == w["_w_sales_region_id"]
        )
        joined = joined.join(w, cond, "left")
    return report_result(joined, COLUMNS, ["sales_region_id"])
