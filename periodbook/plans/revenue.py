"""Order grain and net-revenue waterfall of the P&L reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import PeriodWindow, floor_date, is_immature, month_start, shift_date
from periodbook.functions.predicates import fold_region
from periodbook.functions.scalars import as_money, safe_div
from periodbook.operators.aggregates import sum_when, with_company_total
from periodbook.operators.windows import week_rank_in_month
from periodbook.sources.tables import pruned_scan

REGION = ["sales_region_id", "sales_region_title"]


def pnl_lines(lines: DataFrame, period: str, window: PeriodWindow) -> DataFrame:
    """Lines of the window that count in the P&L."""
    return pruned_scan(lines, F.col(period), window, day="delivery_day").filter(
        F.col("order_biz_type").isin(*dim.PNL_BIZ_TYPES)
    )


def order_grain(lines: DataFrame, period: str, window: PeriodWindow) -> DataFrame:
    """Order lines collapsed to one row per period, folded region, order, buyer, invoice.

    Values repeated on each line of an order (coupon, new-user flag) are taken once.
    """
    rows = pnl_lines(lines, period, window)
    new_user_coupon = F.when(
        F.col("coupon").isin(*dim.NEW_USER_COUPONS), F.col("discount")
    ).otherwise(F.lit(0))
    return (
        fold_region(rows)
        .groupBy(period, *REGION, "order_id", "buyer_id", "group_invoice_id")
        .agg(
            F.max("daily_new_users_flag").alias("daily_new_users_flag"),
            F.sum("sub_total").alias("sub_total"),
            sum_when(F.col("is_gm") == 0, "sub_total").alias("oos"),
            sum_when(F.col("is_gm") == 1, "product_refund_amount").alias("refund"),
            F.max("discount").alias("order_discount"),
            F.max(new_user_coupon).alias("new_user_coupon"),
            F.sum(F.col("gm_cost") * F.col("is_gm")).alias("cogs"),
            F.sum("gm_margin").alias("gm_margin"),
            F.sum("gm_base").alias("gm_base"),
        )
        .withColumnRenamed("order_discount", "coupon")
    )


def _measures() -> list[Column]:
    return [
        F.sum("daily_new_users_flag").alias("new_user"),
        F.count_distinct("buyer_id").alias("active_user"),
        F.sum("sub_total").alias("gross_rev"),
        F.sum("coupon").alias("total_coupon_rev"),
        F.sum("new_user_coupon").alias("new_user_coupon"),
        F.sum("refund").alias("refund_sum"),
        F.sum("oos").alias("oos_rev"),
        F.sum("cogs").alias("cogs_rev"),
    ]


def _net(coupon: Column, refund: Column) -> Column:
    gross = F.col("gross_rev")
    return gross - F.col("oos_rev") - refund - coupon - gross * F.lit(dim.REBATE_RATE)


def monthly_net_revenue(base: DataFrame) -> DataFrame:
    """Waterfall per region and for the company, from the monthly order grain."""
    sums = with_company_total(
        base,
        {"sales_region_id": dim.COMPANY, "sales_region_title": "Company"},
        ["delivery_month", *REGION],
        _measures(),
    )
    coupon = F.col("total_coupon_rev") - F.col("new_user_coupon")
    return sums.select(
        "delivery_month",
        *REGION,
        F.lit(dim.REBATE_RATE).alias("rebate_rate"),
        "new_user",
        "active_user",
        "gross_rev",
        "total_coupon_rev",
        "new_user_coupon",
        coupon.alias("coupon_rev"),
        F.col("refund_sum").alias("refund_rev"),
        "oos_rev",
        "cogs_rev",
        _net(coupon, F.col("refund_sum")).alias("net_rev"),
    )


def ranked_order_grain(lines: DataFrame, window: PeriodWindow) -> DataFrame:
    """Weekly order grain with the rank of the week in its month."""
    base = order_grain(lines, "delivery_week", window)
    present = pnl_lines(lines, "delivery_week", window)
    return week_rank_in_month(base, "delivery_week", present=present)


def weekly_net_revenue(base: DataFrame, as_of: date, corrected: bool = False) -> DataFrame:
    """Waterfall per week and region, and for the company.

    While the last week's refunds are incomplete, regional refunds of that week are
    divided by the share that is normally in by then.  The company row keeps the raw
    sum; with ``corrected`` it is the sum of the regional values.
    """
    last_week = shift_date(floor_date(as_of, "week"), "week", -1)
    sums = with_company_total(
        base,
        {"sales_region_id": dim.COMPANY, "sales_region_title": "Company Total"},
        ["delivery_week", *REGION],
        _measures(),
    )
    region = F.col("sales_region_id")
    refund = as_money("refund_sum")
    if is_immature(as_of):
        raw = F.col("refund_sum").cast("double")
        grown = F.when(
            region == dim.MAIL_ORDER, as_money(raw / F.lit(dim.REFUND_SHARE_MAIL_ORDER))
        ).otherwise(as_money(raw / F.lit(dim.REFUND_SHARE_LOCAL)))
        young = (F.col("delivery_week") == F.lit(last_week)) & (region != dim.COMPANY)
        refund = F.when(young, grown).otherwise(refund)
    rows = sums.withColumn("refund_rev", refund)
    if corrected and is_immature(as_of):
        regional = F.sum(F.when(region != dim.COMPANY, F.col("refund_rev"))).over(
            Window.partitionBy("delivery_week")
        )
        whole = F.when(region == dim.COMPANY, as_money(regional)).otherwise(F.col("refund_rev"))
        rows = rows.withColumn("refund_rev", whole)
    coupon = F.col("total_coupon_rev") - F.lit(dim.NEW_USER_COUPON_VALUE) * F.col("new_user")
    # weeks x regions rows by now: a window over them is small
    by_month = Window.partitionBy(month_start("delivery_week")).orderBy(F.desc("delivery_week"))
    return rows.select(
        "delivery_week",
        F.dense_rank().over(by_month).alias("rk"),
        *REGION,
        F.lit(dim.REBATE_RATE).alias("rebate_rate"),
        "new_user",
        "active_user",
        "gross_rev",
        safe_div("gross_rev", "active_user").alias("arpu"),
        "total_coupon_rev",
        "new_user_coupon",
        coupon.alias("coupon_rev"),
        "refund_rev",
        "oos_rev",
        (F.col("oos_rev") + F.col("refund_rev")).alias("total_refund_rev"),
        "cogs_rev",
        _net(coupon, F.col("refund_rev")).alias("net_rev"),
    )


def regions_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("sales_region_id") != dim.COMPANY)


def company_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("sales_region_id") == dim.COMPANY)
