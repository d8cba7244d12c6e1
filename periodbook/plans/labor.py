"""Warehouse labour: cost per region and its allocation between regions.

One warehouse works for several regions.  Its cost is split by the revenue that
left it, so each allocation is "cost x share" per day (monthly report) or per week
(weekly report, with one cutover week held by day).  Facts are aggregated to a few
rows per day first; everything after that is small.  Amounts are fixed to six
decimals after each product, so sums do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import (
    PeriodWindow,
    floor_date,
    month_start,
    reroll_cutover,
    shift_date,
    split_cutover,
    trailing,
    week_start,
)
from periodbook.functions.scalars import as_money, lookup, safe_div
from periodbook.operators.aggregates import add_company_row, sum_only, sum_when
from periodbook.operators.joins import value_of_member
from periodbook.operators.windows import with_lag
from periodbook.plans.revenue import pnl_lines
from periodbook.sources.sheets import SheetSpec, parse_sheet, union_sheets
from periodbook.sources.tables import pruned_scan

OWN_COST_ONLY = (dim.LOS_ANGELES, dim.BAY_AREA, dim.CHICAGO, dim.NEW_YORK)


@dataclass(frozen=True)
class Cutover:
    """First day of the rule that allocates non-dry labour, and the week it fell in."""

    week: date
    day: date


CUTOVER = Cutover(week=date(2022, 10, 9), day=date(2022, 10, 15))

MONTHLY_MEASURES = (
    "total_cost",
    "la_greater_labor_cost",
    "allo_dry_cost",
    "allo_nondry_cost",
    "mo_outbound",
    "mo_labor",
    "final_labor_cost",
)
WEEKLY_MEASURES = (
    "total_cost",
    "la_greater_labor_cost",
    "allo_cost",
    "mo_outbound",
    "mo_labor",
    "final_labor_cost",
)


def _region() -> Column:
    return F.col("sales_region_id")


def _is(*regions: int) -> Column:
    return _region().isin(*regions)


def _mail_order_line() -> Column:
    """Lines shipped by mail; here the pantry test is case-sensitive."""
    return (
        F.col("biz_type").contains("pantry")
        | (_region() == dim.MAIL_ORDER)
        | F.lower("sales_region_title").contains("mof")
    )


# --- inputs ------------------------------------------------------------------


def inbound_labor_pct(sheets: Iterable[DataFrame], before: date) -> DataFrame:
    """Inbound share of labour per week and region, weeks before ``before``."""
    typed = parse_sheet(
        union_sheets(sheets),
        SheetSpec(
            period=("delivery_week", "delivery_week"),
            numbers={"inbound_pct": "inbound_pct"},
            keep=["sales_region_id"],
        ),
    )
    return typed.filter(F.col("delivery_week") < F.lit(before))


def inbound_labor_pct_monthly(sheets: Iterable[DataFrame], as_of: date) -> DataFrame:
    """With the previous week's share next to it; weeks before the current ISO week."""
    monday = as_of - timedelta(days=as_of.weekday())
    pct = inbound_labor_pct(sheets, monday)
    return with_lag(pct, "inbound_pct", "sales_region_id", "delivery_week", "lag_inbound_pct")


def inbound_labor_pct_weekly(sheets: Iterable[DataFrame], as_of: date) -> DataFrame:
    return inbound_labor_pct(sheets, shift_date(floor_date(as_of, "week"), "week", -1))


def _warehouse_rows(labor: DataFrame) -> DataFrame:
    """Countable rows with their region; a warehouse that is not listed has none."""
    kept = labor.filter(
        ~F.col("warehouse").isin(dim.CHECK_WAREHOUSE, dim.LA_GREATER_WAREHOUSE)
        & (F.col("filter_flag") == "N")
    )
    region = lookup("warehouse", dim.WAREHOUSE_REGIONS).cast("bigint")
    return kept.withColumn("sales_region_id", region)


def _dry_cost() -> Column:
    dry = _is(dim.LOS_ANGELES) & F.lower("department_name").contains("dry")
    return sum_when(dry, "labor_cost").alias("dry_cost")


def _mail_outbound_cost() -> Column:
    outbound = _is(dim.CHICAGO, dim.NEW_YORK) & F.lower("department_name").contains(
        "mail order - outbound"
    )
    return sum_when(outbound, "labor_cost").alias("mo_outbound")


def labor_by_warehouse(labor: DataFrame, as_of: date) -> DataFrame:
    """Last month's labour per day and region."""
    rows = pruned_scan(
        _warehouse_rows(labor), month_start("entry_date"), trailing(as_of, "month", 1),
        day="entry_date",
    )
    sums = rows.groupBy("entry_date", "entry_week", "sales_region_id").agg(
        F.sum("labor_cost").alias("total_cost"), _dry_cost(), _mail_outbound_cost()
    )
    nondry = F.when(_is(dim.LOS_ANGELES), F.col("total_cost") - F.col("dry_cost"))
    return sums.withColumn("nondry_cost", nondry.otherwise(F.lit(0)))


def weekly_labor_by_warehouse(
    labor: DataFrame, as_of: date, cutover: Cutover = CUTOVER
) -> DataFrame:
    """Labour of the last four weeks per week and region; cutover week by day."""
    rows = pruned_scan(
        _warehouse_rows(labor), F.col("entry_week"), trailing(as_of, "week", 4), day="entry_date"
    )
    key = split_cutover("entry_week", "entry_date", cutover.week)
    not_dc = _is(dim.LOS_ANGELES) & ~F.col("department_name").contains("OP - DC")
    return (
        rows.withColumn("_key", key)
        .groupBy(F.col("_key").alias("entry_week"), "sales_region_id")
        .agg(
            F.sum("labor_cost").alias("total_cost"),
            sum_when(not_dc, "labor_cost").alias("total_cost_ex_dc"),
            _dry_cost(),
            _mail_outbound_cost(),
        )
    )


def la_greater_cost(
    labor: DataFrame, key: Column, out: str, window: PeriodWindow | None = None
) -> DataFrame:
    """Labour of the second Los Angeles site per key.

    The join to the other sites decides which periods count; ``window`` names their
    days so that older labour is not read at all.
    """
    rows = labor.filter(
        (F.col("filter_flag") == "N") & (F.col("warehouse") == dim.LA_GREATER_WAREHOUSE)
    )
    if window is not None:
        rows = rows.filter(window.holds_day("entry_date"))
    return rows.groupBy(key.alias(out)).agg(F.sum("labor_cost").alias("_la_greater"))


# --- revenue shares -------------------------------------------------------------
#
# One aggregate per report, a row per period with a column per part: the allocation
# looks its shares up there, the share tables below are the same row unfolded.


def _inventory(title: str) -> Column:
    return F.col("inventory_title") == title


def _other_regions() -> Column:
    """Regions booked under mail order in La Mirada's split, an unknown region included."""
    return ~F.coalesce(_is(dim.BAY_AREA, dim.LOS_ANGELES), F.lit(False))


# who La Mirada works for, by the name its part has in the columns below
SPLIT = {
    "bay": (dim.BAY_AREA, lambda: _is(dim.BAY_AREA)),
    "la": (dim.LOS_ANGELES, lambda: _is(dim.LOS_ANGELES)),
    "mo": (dim.MAIL_ORDER, _other_regions),
}
MAIL_WAREHOUSES = {
    "chi": (dim.CHICAGO, dim.CHICAGO_INVENTORY),
    "ny": (dim.NEW_YORK, dim.NEW_YORK_INVENTORY),
}


def _split_sums(kind: str, cond: Column, parts: Iterable[str] = SPLIT) -> list[Column]:
    """Revenue and number of lines of each part: ``_<kind>_<part>`` and ``_<kind>_<part>_n``."""
    out = []
    for part in parts:
        here = cond & SPLIT[part][1]()
        out += [sum_only(here, "sub_total").alias(f"_{kind}_{part}"), F.count_if(here).alias(f"_{kind}_{part}_n")]
    return out


def _mail_sums() -> list[Column]:
    out = []
    for name, (_, title) in MAIL_WAREHOUSES.items():
        out.append(sum_when(_inventory(title) & _mail_order_line(), "sub_total").alias(f"_{name}_mo"))
        out.append(sum_only(_inventory(title), "sub_total").alias(f"_{name}_all"))
        out.append(F.count_if(_inventory(title)).alias(f"_{name}_n"))
    return out


def _mail_pct() -> Column:
    """Mail-order share of the row's own warehouse."""
    return F.when(_is(dim.CHICAGO), safe_div("_chi_mo", "_chi_all")).when(
        _is(dim.NEW_YORK), safe_div("_ny_mo", "_ny_all")
    )


def _shared_inventories(rows: DataFrame) -> DataFrame:
    return rows.filter(
        F.col("inventory_title").isin(
            dim.LA_MIRADA, dim.CHICAGO_INVENTORY, dim.NEW_YORK_INVENTORY
        )
    )


def _unfold(sums: DataFrame, period: str, rows: Iterable[tuple[int, str, dict[str, Column]]]) -> DataFrame:
    """A row per period and region, where the region's count column says that it has lines."""
    entries = (
        F.struct(
            F.lit(region).cast("bigint").alias("sales_region_id"),
            F.col(count).alias("_lines"),
            *(value.alias(name) for name, value in values.items()),
        )
        for region, count, values in rows
    )
    return sums.select(period, F.inline(F.array(*entries))).filter("_lines > 0").drop("_lines")


def daily_revenue_parts(lines: DataFrame, as_of: date) -> DataFrame:
    """Revenue of last month per day, by the parts that labour is split on."""
    rows = pnl_lines(lines, "delivery_month", trailing(as_of, "month", 1))
    dry = _inventory(dim.LA_MIRADA) & (F.col("division") == dim.DRY_DIVISION)
    nondry = _inventory(dim.LA_MIRADA) & (F.col("division") != dim.DRY_DIVISION)
    return (
        _shared_inventories(rows)
        .groupBy("delivery_day")
        .agg(
            *_split_sums("dry", dry),
            sum_only(dry, "sub_total").alias("_dry_all"),
            *_split_sums("nondry", nondry, ("bay", "la")),
            sum_only(nondry & _is(dim.BAY_AREA, dim.LOS_ANGELES), "sub_total").alias("_nondry_all"),
            *_mail_sums(),
        )
    )


def _nondry_pct(part: str, cutover: Cutover) -> Column:
    """Share of non-dry labour; before the cutover Los Angeles keeps all of it."""
    before = F.col("delivery_day") < F.lit(cutover.day)
    kept = F.lit(1.0 if part == "la" else 0.0)
    if part == "mo":
        return F.lit(0.0)
    return F.when(before, kept).otherwise(
        F.coalesce(safe_div(f"_nondry_{part}", "_nondry_all"), F.lit(0.0))
    )


def dry_revenue_share(lines: DataFrame, as_of: date) -> DataFrame:
    """Split of La Mirada's dry revenue per day: Bay Area, Los Angeles, the rest as 3."""
    rows = [
        (region, f"_dry_{part}_n", {"dry_rev_pct": safe_div(f"_dry_{part}", "_dry_all")})
        for part, (region, _) in SPLIT.items()
    ]
    return _unfold(daily_revenue_parts(lines, as_of), "delivery_day", rows)


def nondry_revenue_share(lines: DataFrame, as_of: date) -> DataFrame:
    """Split of La Mirada's other revenue per day between Bay Area and Los Angeles."""
    rows = [
        (SPLIT[part][0], f"_nondry_{part}_n", {"nondry_rev_pct": safe_div(f"_nondry_{part}", "_nondry_all")})
        for part in ("bay", "la")
    ]
    return _unfold(daily_revenue_parts(lines, as_of), "delivery_day", rows)


def cutover_share(lines: DataFrame, as_of: date, cutover: Cutover = CUTOVER) -> DataFrame:
    """Dry and non-dry shares; before the cutover Los Angeles keeps all non-dry labour."""
    rows = [
        (
            region,
            f"_dry_{part}_n",
            {
                "dry_rev_pct": safe_div(f"_dry_{part}", "_dry_all"),
                "nondry_rev_pct": _nondry_pct(part, cutover),
            },
        )
        for part, (region, _) in SPLIT.items()
    ]
    return _unfold(daily_revenue_parts(lines, as_of), "delivery_day", rows)


def _mail_order_share(sums: DataFrame, period: str) -> DataFrame:
    rows = [
        (region, f"_{name}_n", {"mo_pct": safe_div(f"_{name}_mo", f"_{name}_all")})
        for name, (region, _) in MAIL_WAREHOUSES.items()
    ]
    return _unfold(sums, period, rows)


def mail_order_share(lines: DataFrame, as_of: date) -> DataFrame:
    """Mail-order part of Chicago's and New York's revenue per day."""
    return _mail_order_share(daily_revenue_parts(lines, as_of), "delivery_day")


def daily_share_row(lines: DataFrame, as_of: date, cutover: Cutover) -> DataFrame:
    """One row per day with the shares of :func:`cutover_share` and
    :func:`mail_order_share` that the allocation looks up."""
    return (
        daily_revenue_parts(lines, as_of)
        .withColumns(
            {
                "_mo_pct": safe_div("_dry_mo", "_dry_all"),
                "_bay_pct": safe_div("_dry_bay", "_dry_all"),
                # the share table has a Bay row only on days with dry lines for the Bay
                "_bay_nondry_pct": F.when(F.col("_dry_bay_n") > 0, _nondry_pct("bay", cutover)),
            }
        )
        .withColumnRenamed("delivery_day", "entry_date")
    )


def weekly_revenue_parts(lines: DataFrame, as_of: date, cutover: Cutover) -> DataFrame:
    """Revenue of four weeks per week (cutover week: per day), by the parts that labour is split on."""
    rows = pnl_lines(lines, "delivery_week", trailing(as_of, "week", 4))
    here = _inventory(dim.LA_MIRADA) & (F.col("payment_mode") == "F")
    dry = here & (F.col("storage_type") == "N")
    dry_parts = [
        sum_when(dry & SPLIT[part][1](), "sub_total").alias(f"_dry_{part}") for part in ("bay", "mo")
    ]
    return (
        _shared_inventories(rows)
        .withColumn("delivery_week", split_cutover("delivery_week", "delivery_day", cutover.week))
        .groupBy("delivery_week")
        .agg(
            *dry_parts,
            sum_when(dry, "sub_total").alias("_dry_all"),
            *_split_sums("gross", here),
            sum_only(here, "sub_total").alias("_gross_all"),
            *_mail_sums(),
        )
    )


def _weekly_bay_pct(cutover: Cutover) -> Column:
    """The Bay's share: by dry revenue before the cutover, by gross revenue from then on."""
    before = F.col("delivery_week") < F.lit(cutover.day)
    return F.when(before, safe_div("_dry_bay", "_dry_all")).otherwise(safe_div("_gross_bay", "_gross_all"))


def weekly_la_share(lines: DataFrame, as_of: date, cutover: Cutover = CUTOVER) -> DataFrame:
    """La Mirada's revenue split: Bay by dry revenue up to the cutover and by gross
    revenue from then on, mail order by dry revenue, Los Angeles itself 0."""
    pct = {
        "bay": _weekly_bay_pct(cutover),
        "la": F.lit(0.0),
        "mo": safe_div("_dry_mo", "_dry_all"),
    }
    rows = [(region, f"_gross_{part}_n", {"rev_pct": pct[part]}) for part, (region, _) in SPLIT.items()]
    return _unfold(weekly_revenue_parts(lines, as_of, cutover), "delivery_week", rows)


def weekly_mail_order_share(
    lines: DataFrame, as_of: date, cutover: Cutover = CUTOVER
) -> DataFrame:
    return _mail_order_share(weekly_revenue_parts(lines, as_of, cutover), "delivery_week")


def weekly_share_row(lines: DataFrame, as_of: date, cutover: Cutover) -> DataFrame:
    """One row per week (cutover week: per day) with the shares of
    :func:`weekly_la_share` and :func:`weekly_mail_order_share` for the allocation."""
    return (
        weekly_revenue_parts(lines, as_of, cutover)
        .withColumns(
            {
                "_mo_pct": F.when(F.col("_gross_mo_n") > 0, safe_div("_dry_mo", "_dry_all")),
                "_bay_pct": F.when(F.col("_gross_bay_n") > 0, _weekly_bay_pct(cutover)),
            }
        )
        .withColumnRenamed("delivery_week", "entry_week")
    )


# --- allocation, monthly ------------------------------------------------------


def _times(cost: str, *factors: Column) -> Column:
    out = F.col(cost).cast("double")
    for f in factors:
        out = out * f
    return as_money(out)


def labor_allocation_base(
    labor: DataFrame, lines: DataFrame, sheets: Iterable[DataFrame], as_of: date,
    cutover: Cutover = CUTOVER,
) -> DataFrame:
    """Per day and region: cost, mail-order parts, and what Los Angeles did for the Bay."""
    pct = inbound_labor_pct_monthly(sheets, as_of).withColumnRenamed(
        "delivery_week", "entry_week"
    )
    joined = (
        labor_by_warehouse(labor, as_of)
        .join(daily_share_row(lines, as_of, cutover), "entry_date", "left")
        .join(pct, ["entry_week", "sales_region_id"], "left")
    )
    inbound = F.coalesce("inbound_pct", "lag_inbound_pct")
    in_la = _is(dim.LOS_ANGELES)
    return joined.select(
        "entry_date",
        "entry_week",
        "sales_region_id",
        as_money("total_cost").alias("total_cost"),
        as_money("dry_cost").alias("dry_cost"),
        as_money("nondry_cost").alias("nondry_cost"),
        F.when(in_la, _times("dry_cost", F.col("_mo_pct")))
        .otherwise(as_money("mo_outbound"))
        .alias("mo_outbound"),
        F.when(
            _is(dim.CHICAGO, dim.NEW_YORK), _times("total_cost", inbound, _mail_pct())
        )
        .otherwise(as_money(F.lit(0)))
        .alias("mo_labor"),
        F.when(in_la, _times("dry_cost", F.col("_bay_pct")))
        .otherwise(as_money(F.lit(0)))
        .alias("allo_dry_cost"),
        F.when(in_la, _times("nondry_cost", F.col("_bay_nondry_pct")))
        .otherwise(as_money(F.lit(0)))
        .alias("allo_nondry_cost"),
    )


def labor_final_by_region(
    base: DataFrame, labor: DataFrame, window: PeriodWindow | None = None
) -> DataFrame:
    """Move the allocated labour: out of Los Angeles, into the Bay Area, out to mail order.

    A missing share leaves the amount unknown (NULL), never zero.
    """
    la = _is(dim.LOS_ANGELES)
    extra = la_greater_cost(labor, F.col("entry_date"), "_date", window)
    rows = base.withColumns(
        {
            "_la_dry": value_of_member("allo_dry_cost", la, "entry_date"),
            "_la_nondry": value_of_member("allo_nondry_cost", la, "entry_date"),
        }
    )
    rows = rows.join(extra, la & (F.col("entry_date") == F.col("_date")), "left")
    greater = F.coalesce(as_money("_la_greater"), as_money(F.lit(0)))
    final = (
        F.when(~_is(*OWN_COST_ONLY), F.col("total_cost"))
        .when(
            la,
            F.col("dry_cost") + F.col("nondry_cost") - F.col("mo_outbound")
            - F.col("allo_dry_cost") - F.col("allo_nondry_cost") + greater,
        )
        .when(
            _is(dim.BAY_AREA), F.col("total_cost") + F.col("_la_dry") + F.col("_la_nondry")
        )
        .when(
            _is(dim.CHICAGO, dim.NEW_YORK),
            F.col("total_cost") - F.col("mo_outbound") - F.col("mo_labor"),
        )
    )
    bay = _is(dim.BAY_AREA)
    return rows.select(
        "entry_date",
        "sales_region_id",
        "total_cost",
        greater.alias("la_greater_labor_cost"),
        F.when(bay, F.col("_la_dry")).otherwise(F.col("allo_dry_cost")).alias("allo_dry_cost"),
        F.when(bay, F.col("_la_nondry"))
        .otherwise(F.col("allo_nondry_cost"))
        .alias("allo_nondry_cost"),
        "mo_outbound",
        "mo_labor",
        as_money(final).alias("final_labor_cost"),
    )


def _with_mail_order(final: DataFrame, period: str, measures: Sequence[str]) -> DataFrame:
    """Regional rows and, as region 3, the labour the regions passed on to mail order.

    One pass: each regional row yields its own entry and one for mail order, which
    are summed per period.  An amount all regions lack stays NULL.
    """
    own = F.struct(
        F.lit(False).alias("_mail"),
        _region().alias("sales_region_id"),
        *(F.col(m).alias(m) for m in measures),
    )
    passed = ("mo_outbound", "mo_labor")
    mail = F.struct(
        F.lit(True).alias("_mail"),
        F.lit(dim.MAIL_ORDER).cast("bigint").alias("sales_region_id"),
        *(
            (F.col(m) if m in passed else as_money(F.lit(None))).alias(m)
            for m in measures
        ),
    )
    sums = (
        final.select(period, F.inline(F.array(own, mail)))
        .groupBy(period, "_mail", "sales_region_id")
        .agg(*(F.sum(m).alias(m) for m in measures))
    )
    both = F.col("mo_outbound") + F.col("mo_labor")
    of_mail = {m: as_money(F.lit(0)) for m in measures if m not in passed}
    of_mail |= {"total_cost": both, "final_labor_cost": both}
    return sums.select(
        period,
        "_mail",
        "sales_region_id",
        *(
            (F.when(F.col("_mail"), of_mail[m]).otherwise(F.col(m)) if m in of_mail else F.col(m))
            .alias(m)
            for m in measures
        ),
    )


def _mail_order_rows(final: DataFrame, period: str, measures: Sequence[str]) -> DataFrame:
    return _with_mail_order(final, period, measures).filter("_mail").drop("_mail")


def labor_mail_order(final: DataFrame) -> DataFrame:
    return _mail_order_rows(final, "entry_date", MONTHLY_MEASURES)


def labor_period_rollup(final: DataFrame) -> DataFrame:
    """Month totals per region with mail order, and the company."""
    daily = _with_mail_order(final, "entry_date", MONTHLY_MEASURES)
    monthly = daily.withColumn("delivery_month", month_start("entry_date"))
    return add_company_row(monthly, "delivery_month", "sales_region_id", MONTHLY_MEASURES)


# --- weekly -------------------------------------------------------------------


def weekly_labor_allocation_base(
    labor: DataFrame, lines: DataFrame, sheets: Iterable[DataFrame], as_of: date,
    cutover: Cutover = CUTOVER,
) -> DataFrame:
    # the sheet is by week; cutover days look up the week they belong to
    pct = inbound_labor_pct_weekly(sheets, as_of).withColumnRenamed("delivery_week", "_week")
    joined = (
        weekly_labor_by_warehouse(labor, as_of, cutover)
        .join(weekly_share_row(lines, as_of, cutover), "entry_week", "left")
        .withColumn("_week", week_start("entry_week"))
        .join(pct, ["_week", "sales_region_id"], "left")
    )
    in_la = _is(dim.LOS_ANGELES)
    before = F.col("entry_week") < F.lit(cutover.day)
    return joined.select(
        "entry_week",
        "sales_region_id",
        as_money("total_cost").alias("total_cost"),
        as_money("total_cost_ex_dc").alias("total_cost_ex_dc"),
        as_money("dry_cost").alias("dry_cost"),
        as_money("mo_outbound").alias("mo_outbound"),
        F.when(
            _is(dim.CHICAGO, dim.NEW_YORK),
            _times("total_cost", F.col("inbound_pct"), _mail_pct()),
        )
        .when(in_la, _times("dry_cost", F.col("_mo_pct")))
        .otherwise(as_money(F.lit(0)))
        .alias("mo_labor"),
        F.when(in_la & before, _times("dry_cost", F.col("_bay_pct")))
        .otherwise(_times("total_cost_ex_dc", F.col("_bay_pct")))
        .alias("allo_cost"),
    )


def weekly_labor_final(
    base: DataFrame,
    labor: DataFrame,
    cutover: Cutover = CUTOVER,
    window: PeriodWindow | None = None,
) -> DataFrame:
    la = _is(dim.LOS_ANGELES)
    key = split_cutover("entry_week", "entry_date", cutover.week)
    extra = la_greater_cost(labor, key, "_key", window)
    rows = base.withColumn("_la_allo", value_of_member("allo_cost", la, "entry_week"))
    rows = rows.join(extra, la & (F.col("entry_week") == F.col("_key")), "left")
    greater = F.coalesce(as_money("_la_greater"), as_money(F.lit(0)))
    final = (
        F.when(~_is(*OWN_COST_ONLY), F.col("total_cost"))
        .when(la, F.col("total_cost") - F.col("mo_labor") - F.col("allo_cost") + greater)
        .when(_is(dim.BAY_AREA), F.col("total_cost") + F.col("_la_allo"))
        .when(
            _is(dim.CHICAGO, dim.NEW_YORK),
            F.col("total_cost") - F.col("mo_outbound") - F.col("mo_labor"),
        )
    )
    return rows.select(
        "entry_week",
        "sales_region_id",
        "total_cost",
        greater.alias("la_greater_labor_cost"),
        F.when(_is(dim.BAY_AREA), F.col("_la_allo"))
        .otherwise(F.col("allo_cost"))
        .alias("allo_cost"),
        "mo_outbound",
        "mo_labor",
        as_money(final).alias("final_labor_cost"),
    )


def weekly_labor_mail_order(final: DataFrame) -> DataFrame:
    return _mail_order_rows(final, "entry_week", WEEKLY_MEASURES)


def weekly_labor_rollup(final: DataFrame, cutover: Cutover = CUTOVER) -> DataFrame:
    """Fold cutover days back to their week; regions, mail order and company."""
    rows = _with_mail_order(final, "entry_week", WEEKLY_MEASURES)
    weekly = rows.withColumn("delivery_week", reroll_cutover("entry_week", cutover.week))
    return add_company_row(weekly, "delivery_week", "sales_region_id", WEEKLY_MEASURES)
