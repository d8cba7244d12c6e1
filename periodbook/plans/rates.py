"""Reported cost rates and the costs allocated with them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import PeriodWindow, floor_date, month_start, shift_date, trailing
from periodbook.functions.scalars import as_money, exact_avg, lookup, safe_div
from periodbook.operators.windows import latest_period, rank_newest
from periodbook.sources.sheets import SheetSpec, parse_sheet, union_sheets

RATES = {
    "inbound_pct": "inbound_pct",
    "wh_labor": "wh_labor_pct",
    "packaging_pct": "packaging_pct",
    "processing_fee_pct": "processing_pct",
    "wh_pct": "wh_pct",
    "ops_pct": "ops_pct",
    "misc_pct": "misc_pct",
}

AVERAGED_RATES = ("inbound_pct", "packaging_pct")
DOLLAR_RATES = ("wh_pct", "ops_pct", "misc_pct")


def reported_rates_latest(sheet: DataFrame, as_of: date) -> DataFrame:
    """Newest reported month of the last two, typed, with region ids."""
    window = trailing(as_of, "month", 2)
    typed = parse_sheet(
        sheet,
        SheetSpec(
            period=("report_month", "delivery_month"),
            numbers=RATES,
            keep=[lookup(F.lower("sales_region_title"), dim.SHEET_REGIONS).alias("region_id")],
            required=["gross_rev"],
            absolute=True,
        ),
    )
    recent = typed.filter(F.col("region_id").isNotNull() & window.holds("report_month"))
    return latest_period(recent, "report_month").withColumn("css", F.lit(dim.SERVICE_RATE))


def monthly_rate_costs(sales: DataFrame, rates: DataFrame) -> DataFrame:
    """Rate x net revenue for every cost line; the company row meets the company rates."""
    per_region = rates.select(F.col("region_id").alias("sales_region_id"), *_rate_names())
    net = F.col("net_rev").cast("double")
    joined = sales.join(per_region, "sales_region_id", "left")
    return joined.select(
        *sales.columns,
        (F.col("inbound_pct") * net).alias("inbound_rev"),
        (F.col("processing_fee_pct") * net).alias("processing_rev"),
        (F.col("packaging_pct") * net).alias("packaging_rev"),
        (F.lit(dim.SERVICE_RATE) * net).alias("cs_rev"),
        (F.col("wh_pct") * net).alias("warehouse_rev"),
        (F.col("misc_pct") * net).alias("misc_rev"),
        (F.col("ops_pct") * net).alias("ops_rev"),
    )


def _rate_names() -> list[str]:
    return [n for n in RATES if n != "wh_labor"]


def reported_rates_ranked(sheets: Iterable[DataFrame]) -> DataFrame:
    """Rows of the regional sheets that carry a month label, months ranked per region."""
    typed = parse_sheet(
        union_sheets(sheets),
        SheetSpec(
            period=("report_month", "delivery_month"),
            numbers=RATES,
            keep=["region_id", "sales_region_title"],
            month_labels=True,
        ),
    )
    return rank_newest(typed, "region_id", "report_month").withColumn(
        "css", F.lit(dim.SERVICE_RATE)
    )


def rate_card(rates: DataFrame, weekly_sales: DataFrame, as_of: date) -> DataFrame:
    """Rates to cost the weeks of the current month with, one row per region.

    The report averages over a cross product of (latest month's rates) x (last four
    months) x (last four months) x (weeks).  The branches meet on the region alone, so
    the two four-month branches need not be multiplied: one pass over (last four months)
    x (weeks) has every value the averages are taken over, each equally often.
    """
    last_week = shift_date(floor_date(as_of, "week"), "week", -1)
    month_before = shift_date(floor_date(last_week, "month"), "month", -1)

    weeks = weekly_sales.filter(month_start("delivery_week") == F.lit(month_before)).select(
        F.col("sales_region_id").alias("region_id"), F.col("net_rev").cast("double").alias("_net")
    )
    newest = F.col("rn") == 1

    def latest(c: str) -> Column:
        return F.max(F.when(newest, F.col(c)))

    def weekly_dollars(rate: str) -> Column:
        return exact_avg(F.when(newest, F.col(rate) * F.col("_net")))

    # each of a region's rates meets each of its weeks, which leaves averages as they are
    card = (
        rates.filter(F.col("rn") <= 4)
        .join(weeks, "region_id", "left")
        .groupBy("region_id")
        .agg(
            latest("report_month").alias("report_month"),
            exact_avg("inbound_pct").alias("avg_inbound_pct"),
            latest("inbound_pct").alias("inbound_pct"),
            latest("packaging_pct").alias("packaging_pct"),
            exact_avg("packaging_pct").alias("avg_packaging_pct"),
            latest("processing_fee_pct").alias("processing_fee_pct"),
            latest("wh_pct").alias("wh_pct"),
            weekly_dollars("wh_pct").alias("avg_wh_dollar_value"),
            latest("ops_pct").alias("ops_pct"),
            weekly_dollars("ops_pct").alias("avg_ops_dollar_value"),
            latest("misc_pct").alias("misc_pct"),
            weekly_dollars("misc_pct").alias("avg_misc_dollar_value"),
        )
    )
    return card.select("report_month", *(c for c in card.columns if c != "report_month"))


def newest_rates(rates: DataFrame) -> DataFrame:
    """Per region: the newest month's rates, sums and numbers for four-month averages, and the newest rows' dollar rates as arrays."""
    newest = F.col("rn") == 1

    def latest(c: str) -> Column:
        return F.max(F.when(newest, F.col(c)))

    return (
        rates.filter(F.col("rn") <= 4)
        .groupBy("region_id")
        .agg(
            *(latest(c).alias(c) for c in ("inbound_pct", "processing_fee_pct", *DOLLAR_RATES)),
            latest("packaging_pct").alias("reported_packaging_pct"),
            *(F.sum(as_money(c)).alias(f"_sum_{c}") for c in AVERAGED_RATES),
            *(F.count(c).alias(f"_n_{c}") for c in AVERAGED_RATES),
            *(F.collect_list(F.when(newest, F.col(c))).alias(f"_{c}") for c in DOLLAR_RATES),
        )
    )


def windowed_rate_costs(
    sales: DataFrame, rates: DataFrame, as_of: date, window: PeriodWindow
) -> DataFrame:
    """As :func:`weekly_rate_costs` with the :func:`rate_card` of the same sales, which are only computed once.

    ``sales`` is aggregated (weeks x regions), so each row sees its region's weeks of the month
    before through a small window instead of a second aggregate of the orders and a join.
    """
    last_week = shift_date(floor_date(as_of, "week"), "week", -1)
    month_before = shift_date(floor_date(last_week, "month"), "month", -1)
    net = F.col("net_rev").cast("double")
    earlier = F.when(month_start("delivery_week") == F.lit(month_before), net)
    seen = sales.withColumn(
        "_weeks", F.collect_list(earlier).over(Window.partitionBy("sales_region_id"))
    )

    def mean_dollars(c: str) -> Column:
        """Mean of (newest rate x week's revenue) over all pairs, added up as decimals."""
        dollars = F.flatten(
            F.transform(f"_{c}", lambda rate: F.transform("_weeks", lambda week: as_money(rate * week)))
        )
        zero = F.lit(0).cast("decimal(38,6)")
        total = F.aggregate(dollars, zero, lambda a, x: (a + x).cast("decimal(38,6)"))
        return safe_div(total, F.nullif(F.size(dollars), F.lit(0)))

    # the card's averages count each rate once per week: so do these, to the last digit
    times = F.greatest(F.size("_weeks"), F.lit(1))
    per_region = newest_rates(rates).withColumnRenamed("region_id", "sales_region_id")
    joined = seen.join(per_region, "sales_region_id", "left").withColumns(
        {f"avg_{c.removesuffix('_pct')}_dollar_value": mean_dollars(c) for c in DOLLAR_RATES}
        | {f"avg_{c}": safe_div(F.col(f"_sum_{c}") * times, F.col(f"_n_{c}") * times) for c in AVERAGED_RATES}
    )
    return _costs(joined, sales.columns, last_week, window)


def weekly_rate_costs(
    sales: DataFrame, card: DataFrame, as_of: date, window: PeriodWindow
) -> DataFrame:
    """Costs of the shown weeks: averages for the current month, reported rates before."""
    last_week = shift_date(floor_date(as_of, "week"), "week", -1)
    rates = card.drop("report_month").withColumnsRenamed(
        {"region_id": "sales_region_id", "packaging_pct": "reported_packaging_pct"}
    )

    shown = sales.filter(window.holds("delivery_week"))
    return _costs(shown.join(rates, "sales_region_id", "left"), sales.columns, last_week, window)


def _costs(
    joined: DataFrame, columns: list[str], last_week: date, window: PeriodWindow
) -> DataFrame:
    """Costs of the shown weeks, from sales with their region's rates."""
    this_month = month_start("delivery_week") == F.lit(floor_date(last_week, "month"))
    net = F.col("net_rev").cast("double")

    def rate(average: str, reported: str) -> Column:
        return F.when(this_month, F.col(average) * net).otherwise(F.col(reported) * net)

    def dollars(average: str, reported: str) -> Column:
        return F.when(this_month, F.col(average)).otherwise(F.col(reported) * net)

    return (
        joined.filter(window.holds("delivery_week"))
        .select(
            *columns,
            rate("avg_inbound_pct", "inbound_pct").alias("inbound_rev"),
            (F.col("processing_fee_pct") * net).alias("processing_rev"),
            rate("avg_packaging_pct", "reported_packaging_pct").alias("packaging_rev"),
            (F.lit(dim.SERVICE_RATE) * net).alias("cs_rev"),
            dollars("avg_wh_dollar_value", "wh_pct").alias("warehouse_rev"),
            dollars("avg_misc_dollar_value", "misc_pct").alias("misc_rev"),
            dollars("avg_ops_dollar_value", "ops_pct").alias("ops_rev"),
        )
        .withColumns(
            {
                "packaging_pct": safe_div("packaging_rev", "net_rev"),
                "processing_pct": safe_div("processing_rev", "net_rev"),
            }
        )
    )

