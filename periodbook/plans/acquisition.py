"""Customer acquisition: new buyers, lifetime value and what was spent on them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import (
    PeriodWindow,
    Unit,
    floor_date,
    period_key,
    scorecard_window,
    shift_date,
    week_start,
)
from periodbook.functions.scalars import as_money, lookup, safe_div, utc_to_local, whole_div
from periodbook.operators.aggregates import lifetime_value, sum_or_zero
from periodbook.operators.joins import full_outer_zero
from periodbook.sources.tables import Tables

BOOKING_START = date(2020, 12, 27)
OVERHEAD_START = date(2020, 12, 1)

DAY = ["time_day_unit", "time_week_unit"]
SEGMENT = ["device", "language", "region"]
OVERHEADS = (
    "content_marketing_spend", "salary_cost", "agency_fee", "contractor_fee", "tools_cost",
)
MONEY_SUM = "decimal(28,4)"
ETHNIC = ("es_ethnic_cost", "ja_ethnic_cost", "ko_ethnic_cost", "vi_ethnic_cost")


def _segment_columns() -> list[Column]:
    other = F.lit
    return [
        lookup("device_type", dim.DEVICES, other(dim.OTHER_DEVICE)).alias("device"),
        lookup("language", dim.LANGUAGES, other(dim.OTHER_LANGUAGE)).alias("language"),
        F.when(F.col("sales_org_id").isin(*dim.MAIL_ORGS), F.lit("Mail"))
        .otherwise(F.lit("Grocery"))
        .alias("region"),
    ]


def _new_buyers(
    orders: DataFrame, day: str, week: str, flag: str, start: date, as_of: date, out: str
) -> DataFrame:
    rows = orders.filter(
        (F.col("payment_mode") == "F")
        & (F.col(flag) == 1)
        & F.col(day).between(F.lit(start), F.lit(as_of - timedelta(days=1)))
    )
    return (
        rows.select(
            F.col(day).alias(DAY[0]), F.col(week).alias(DAY[1]), *_segment_columns(), "buyer_id"
        )
        .groupBy(*DAY, *SEGMENT)
        .agg(F.count_distinct("buyer_id").alias(out))
    )


def new_buyers_by_order_day(
    orders: DataFrame, as_of: date, start: date = BOOKING_START, out: str = "new_d2c"
) -> DataFrame:
    return _new_buyers(
        orders, "order_day", "order_week", "daily_new_users_flag_order", start, as_of, out
    )


def new_buyers_by_delivery_day(
    orders: DataFrame, as_of: date, start: date = BOOKING_START, out: str = "new_d2c"
) -> DataFrame:
    return _new_buyers(
        orders, "delivery_day", "delivery_week", "daily_new_users_flag", start, as_of, out
    )


def ltv(cohorts: DataFrame, as_of: date, last_week: int = 6) -> DataFrame:
    """Lifetime value per device, language and region from cohorts at least 7 weeks old."""
    oldest_start = shift_date(floor_date(as_of, "week"), "week", -7)
    share = F.when(F.col("region") == "Local", F.lit(dim.LTV_SHARE_LOCAL)).otherwise(
        F.lit(dim.LTV_SHARE_OTHER)
    )
    weekly = (
        cohorts.filter((F.col("start_week") <= F.lit(oldest_start)) & (F.col("wd") <= last_week))
        .groupBy(*SEGMENT, "wd")
        .agg(safe_div(F.sum("revenue"), F.sum("cohort_buyers")).alias("_per_buyer"))
        .withColumn("avg_ltv", share * F.col("_per_buyer"))
    )
    value = lifetime_value(weekly, SEGMENT, "wd", "avg_ltv", last_week, dim.LTV_TAIL_WEEKS)
    named = F.when(F.col("region") == "Local", F.lit("Grocery")).otherwise(F.col("region"))
    return value.withColumn("region", named)


def booking_vs_revenue(
    orders: DataFrame, cohorts: DataFrame, as_of: date, start: date = BOOKING_START
) -> DataFrame:
    """New buyers per day by order date and by delivery date, with their value."""
    counts = full_outer_zero(
        new_buyers_by_order_day(orders, as_of, start, "booked"),
        new_buyers_by_delivery_day(orders, as_of, start, "earned"),
        [*DAY, *SEGMENT],
        ["booked", "earned"],
    )
    valued = counts.join(ltv(cohorts, as_of), SEGMENT, "left")
    return valued.groupBy(*DAY).agg(
        F.sum("booked").alias("booking_new_user"),
        F.sum("earned").alias("revenue_new_user"),
        F.sum(as_money(F.col("booked") * F.col("ltv"))).alias("total_booking_ltv"),
        F.sum(as_money(F.col("earned") * F.col("ltv"))).alias("total_revenue_ltv"),
    )


def _is_brand() -> Column:
    return F.col("channel").startswith("Branding")


def marketing_spend(spend: DataFrame) -> DataFrame:
    return (
        spend.filter(~_is_brand())
        .groupBy(F.col("date").alias(DAY[0]), week_start("date").alias(DAY[1]))
        .agg(F.sum("cost").alias("marketing_spend"))
    )


def coupon_spend(
    orders: DataFrame,
    coupon_use: DataFrame,
    coupon_code: DataFrame,
    discounts: DataFrame,
    start: date = BOOKING_START,
    corrected: bool = False,
    window: PeriodWindow | None = None,
) -> DataFrame:
    """New-user coupon amounts by order day and by delivery day.

    An order's amount counts once per use of a coupon code on it (``corrected``: once).
    The uses are counted per order first, so nothing fans out; amounts and uses of other
    orders are dropped by a semi-join before they are grouped (see ``session.SETTINGS``: on
    large tables Spark then filters them by a Bloom filter before they are shuffled).  Both day views come
    from one pass: each order yields an entry for either day.  ``window`` limits the
    days of the result and lets older orders go unread.
    """
    if window is not None:
        orders = orders.filter(window.holds_day("order_day") | window.holds_day("delivery_day"))
    rows = orders.filter(
        (F.col("payment_mode") == "F")
        & (F.col("discount") > 0)
        & F.col("coupon").isin(*dim.SIGN_UP_COUPONS)
    ).select("order_id", "order_day", "order_week", "delivery_day", "delivery_week")
    ids = rows.select("order_id")
    amounts = (
        discounts.filter(F.col("type") == "coupon")
        .join(ids, "order_id", "left_semi")
        .groupBy("order_id")
        .agg(F.sum("amount").alias("amount"))
    )
    rows = rows.join(amounts, "order_id")
    amount = F.col("amount")
    if not corrected:
        codes = coupon_code.groupBy("code").agg(F.count("*").alias("_codes"))
        uses = (
            coupon_use.join(ids, "order_id", "left_semi")
            .join(codes, "code", "left")
            .groupBy("order_id")
            .agg(F.sum(F.coalesce("_codes", F.lit(1))).alias("_uses"))
        )
        rows = rows.join(uses, "order_id", "left")
        amount = F.col("amount") * F.coalesce("_uses", F.lit(1))

    none = F.lit(None).cast(MONEY_SUM)
    entries = F.array(
        F.struct(
            F.col("order_day").alias(DAY[0]),
            F.col("order_week").alias(DAY[1]),
            amount.cast(MONEY_SUM).alias("_booked"),
            none.alias("_earned"),
        ),
        F.struct(
            F.col("delivery_day").alias(DAY[0]),
            F.col("delivery_week").alias(DAY[1]),
            none.alias("_booked"),
            amount.cast(MONEY_SUM).alias("_earned"),
        ),
    )
    by_day = rows.select(F.inline(entries)).filter(F.col(DAY[0]) >= F.lit(start))
    if window is not None:
        by_day = by_day.filter(window.holds_day(DAY[0]))
    return (
        by_day.groupBy(*DAY)
        .agg(
            F.sum("_booked").alias("new_user_book_coupon_amount"),
            F.sum("_earned").alias("new_user_rev_coupon_amount"),
        )
    )


def referral_spend(
    points: DataFrame, start: date = BOOKING_START, window: PeriodWindow | None = None
) -> DataFrame:
    """Referral points per local day in dollars; each row is cut to whole dollars.

    A local day is within a day of the UTC date, so ``window`` also gives a loose bound
    on the stored time that scans can use.
    """
    if window is not None:
        stored = F.col("rec_create_time")
        points = points.filter(
            (stored >= F.lit(window.spans[0][0] - timedelta(days=1)).cast("timestamp_ntz"))
            & (stored < F.lit(window.spans[-1][1] + timedelta(days=2)).cast("timestamp_ntz"))
        )
    local_day = utc_to_local("rec_create_time", dim.LOCAL_ZONE).cast("date")
    daily = (
        points.filter(F.col("type") == dim.REFERRAL_POINTS)
        .select(local_day.alias(DAY[0]), whole_div("points", 100).alias("_dollars"))
        .filter(F.col(DAY[0]) >= F.lit(start))
    )
    if window is not None:
        daily = daily.filter(window.holds_day(DAY[0]))
    return daily.groupBy(DAY[0], week_start(DAY[0]).alias(DAY[1])).agg(
        F.sum("_dollars").alias("referral_cost")
    )


def other_spend(
    orders: DataFrame,
    overheads: DataFrame,
    spend: DataFrame,
    start: date = OVERHEAD_START,
    corrected: bool = False,
) -> DataFrame:
    """Monthly overheads and daily brand cost per order day.

    The month's overheads are repeated on each of its order days; ``corrected``
    divides them by the number of those days.
    """
    days = (
        orders.filter(
            (F.col("payment_mode") == "F")
            & (F.col("order_month") >= F.lit(start))
            & (F.col("order_day") >= F.lit(start))
        )
        .select("order_month", "order_day", "order_week")
        .distinct()
    )
    monthly = overheads.filter(F.col("month") >= F.lit(start)).withColumnRenamed(
        "month", "order_month"
    )
    if corrected:
        n = days.groupBy("order_month").agg(F.count("*").alias("_days"))
        monthly = monthly.join(n, "order_month").select(
            "order_month",
            *(as_money(safe_div(c, "_days")).alias(c) for c in (*OVERHEADS, *ETHNIC)),
        )
    brand = (
        spend.filter(_is_brand())
        .groupBy(F.col("date").alias("order_day"))
        .agg(F.sum("cost").alias("brand_cost"))
    )
    rows = days.join(monthly, "order_month").join(brand, "order_day", "left")

    def filled(c: str) -> Column:
        v = F.coalesce(c, F.lit(0))
        return F.round(v, 2) if c == "content_marketing_spend" else v

    ethnic = sum((filled(c) for c in ETHNIC[1:]), filled(ETHNIC[0]))
    everything = sum((filled(c) for c in (*OVERHEADS[1:], "brand_cost")), filled(OVERHEADS[0]))
    return rows.groupBy(F.col("order_day").alias(DAY[0]), F.col("order_week").alias(DAY[1])).agg(
        *(F.sum(filled(c)).alias(c) for c in OVERHEADS),
        F.sum(filled("brand_cost")).alias("branding_cost"),
        F.sum(ethnic).alias("ethnic_cost"),
        F.sum(everything + ethnic).alias("total_other_spend"),
    )


SPENDS = {
    "marketing_spend": "marketing_spend",
    "new_user_rev_coupon_amount": "new_user_rev_coupon_amount",
    "referral_spend": "referral_cost",
    "content_marketing_spend": "content_marketing_spend",
    "salary_spend": "salary_cost",
    "agency_spend": "agency_fee",
    "contractor_spend": "contractor_fee",
    "tool_spend": "tools_cost",
}


def acquisition_cost(
    t: Tables,
    as_of: date,
    unit: Unit,
    start: date = BOOKING_START,
    overhead_start: date = OVERHEAD_START,
    period: str = "delivery_unit",
    corrected: bool = False,
) -> DataFrame:
    """New users and spend per period.

    Days come from the new-buyer counts; spend joins them on day and week.  The
    lifetime value is not part of the result, so it is not joined here.
    """
    orders = t["orders"]
    window: PeriodWindow = scorecard_window(as_of, unit)
    in_window = window.holds_day(DAY[0])
    # the day range goes on both inputs: no filter passes a full outer join by itself
    buyers = full_outer_zero(
        new_buyers_by_order_day(orders, as_of, start, "booked").filter(in_window),
        new_buyers_by_delivery_day(orders, as_of, start, "earned").filter(in_window),
        [*DAY, *SEGMENT],
        ["booked", "earned"],
    )
    daily = buyers.groupBy(*DAY).agg(F.sum("earned").alias("revenue_new_user"))
    spends = (
        coupon_spend(
            orders, t["coupon_use"], t["coupon_code"], t["order_discount"], start, corrected, window
        ),
        marketing_spend(t["marketing_spend"]).filter(in_window),
        referral_spend(t["user_points"], start, window),
        other_spend(
            orders, t["mkt_other_spend"], t["marketing_spend"], overhead_start, corrected
        ).filter(in_window),
    )
    for spend in spends:
        daily = daily.join(spend, DAY, "left")
    periods = daily.withColumn(period, period_key(DAY[0], unit)).filter(window.holds(period))
    sums = periods.groupBy(period).agg(
        F.sum("revenue_new_user").alias("revenue_new_user"),
        *(sum_or_zero(c).alias(out) for out, c in SPENDS.items()),
    )
    names = list(SPENDS)
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return sums.withColumn("total_spend", total)
