"""Weekly P&L of the last four weeks, with nine weeks of revenue behind it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import floor_date, shift_date, trailing
from periodbook.functions.scalars import safe_div
from periodbook.operators.windows import carry_all
from periodbook.plans import delivery, labor, rates, revenue
from periodbook.sources.sinks import report_result
from periodbook.sources.tables import Tables

WEEKS_READ = 9
WEEKS_SHOWN = 4
SHEETS = (
    "ba_pl", "la_pl", "nj_pl", "sea_pl", "fl_pl", "tx_pl", "mo_pl", "groc_pl", "chi_pl",
)

COLUMNS = (
    "delivery_week", "sales_region_id", "sales_region_title", "rebate_rate", "new_user",
    "active_user", "gross_rev", "total_coupon_rev", "new_user_coupon", "coupon_rev", "arpu",
    "refund_rev", "oos_rev", "total_refund_rev", "cogs_rev", "net_rev", "inbound_rev",
    "processing_rev", "packaging_rev", "warehouse_rev", "misc_rev", "cs_rev", "ops_rev",
    *labor.WEEKLY_MEASURES,
    "delivery_cost", "delivery_cost_pct", "packaging_pct", "processing_pct", "wh_labor_pct",
)


def order_grain_base(t: Tables, as_of: date) -> DataFrame:
    return revenue.order_grain(
        t["order_product"], "delivery_week", trailing(as_of, "week", WEEKS_READ)
    )


def ranked_order_grain(t: Tables, as_of: date) -> DataFrame:
    return revenue.ranked_order_grain(t["order_product"], trailing(as_of, "week", WEEKS_READ))


def net_revenue(t: Tables, as_of: date, corrected: bool = False) -> DataFrame:
    return revenue.weekly_net_revenue(order_grain_base(t, as_of), as_of, corrected)


def rate_costs(
    t: Tables, as_of: date, sheets: Sequence[str] = SHEETS, corrected: bool = False
) -> DataFrame:
    sales = net_revenue(t, as_of, corrected)
    reported = rates.reported_rates_ranked([t.stacked(sheets)])
    return rates.windowed_rate_costs(sales, reported, as_of, trailing(as_of, "week", WEEKS_SHOWN))


def delivery_cost(t: Tables, as_of: date) -> DataFrame:
    return delivery.delivery_cost(
        t["dispatch_performance"], t["mail_order_shipment"],
        trailing(as_of, "week", WEEKS_SHOWN), "delivery_week",
    )


def labor_base(t: Tables, as_of: date, cutover: labor.Cutover = labor.CUTOVER) -> DataFrame:
    return labor.weekly_labor_allocation_base(
        t["labor_cost_detail"], t["order_product"], [t["nj_labor"], t["chi_labor"]],
        as_of, cutover,
    )


def labor_final(t: Tables, as_of: date, cutover: labor.Cutover = labor.CUTOVER) -> DataFrame:
    return labor.weekly_labor_final(
        labor_base(t, as_of, cutover), t["labor_cost_detail"], cutover,
        trailing(as_of, "week", WEEKS_SHOWN),
    )


def labor_rollup(t: Tables, as_of: date, cutover: labor.Cutover = labor.CUTOVER) -> DataFrame:
    return labor.weekly_labor_rollup(labor_final(t, as_of, cutover), cutover)


def weekly_pnl_base(
    t: Tables,
    as_of: date,
    cutover: labor.Cutover = labor.CUTOVER,
    sheets: Sequence[str] = SHEETS,
    corrected: bool = False,
) -> DataFrame:
    """Sales with delivery (a region without delivery cost drops out) and labour.

    The delivery share of revenue carries an uplift, the delivery cost does not.
    """
    keys = ["delivery_week", "sales_region_id"]
    joined = (
        rate_costs(t, as_of, sheets, corrected)
        .join(delivery_cost(t, as_of), keys, "left" if corrected else "inner")
        .join(labor_rollup(t, as_of, cutover), keys, "left")
    )
    uplifted = F.col("delivery_cost").cast("double") * F.lit(dim.DELIVERY_UPLIFT)
    return joined.withColumns(
        {
            "delivery_cost_pct": safe_div(uplifted, "net_rev"),
            "wh_labor_pct": safe_div("final_labor_cost", "net_rev"),
        }
    )


def weekly_pnl(
    t: Tables,
    as_of: date,
    cutover: labor.Cutover = labor.CUTOVER,
    sheets: Sequence[str] = SHEETS,
    corrected: bool = False,
) -> DataFrame:
    """The report.  The newest week shows the week before's labour and delivery, as its
    own are not in yet.  On older weeks two columns show another measure (mail-order
    labour: the allocation, final labour: the delivery cost); ``corrected`` shows each
    column's own value.
    """
    newest = shift_date(floor_date(as_of, "week"), "week", -1)
    carried = {
        m: m for m in (*labor.WEEKLY_MEASURES, "delivery_cost", "delivery_cost_pct", "wh_labor_pct")
    }
    if not corrected:
        carried |= {"mo_labor": "allo_cost", "final_labor_cost": "delivery_cost"}
    base = weekly_pnl_base(t, as_of, cutover, sheets, corrected)
    shown = carry_all(base, carried, "sales_region_id", "delivery_week", newest)
    return report_result(shown, COLUMNS, ["sales_region_id", "delivery_week"])
