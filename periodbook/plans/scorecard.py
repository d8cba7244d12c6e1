"""Week / month / quarter scorecard: independent metrics per period, attached to the
commerce rows of each buyer segment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions.periods import (
    PeriodWindow,
    Unit,
    coarse_day_bound,
    comparison_period,
    floor_date,
    is_immature,
    month_start,
    monday_rule_start,
    period_key,
    scorecard_window,
    shift_date,
)
from periodbook.functions.predicates import any_of, in_buckets, region_bucket
from periodbook.functions.scalars import as_money, epoch_to_local, lookup, part_of, safe_div, strict_cast
from periodbook.operators.aggregates import (
    avg_when,
    blend_by_days,
    net_promoter_scores,
    one_minus_ratio,
    sum_only,
    sum_when,
)
from periodbook.operators.distincts import distinct_counts, distinct_pivot
from periodbook.operators.joins import attach_to_segment, covering, interval_map
from periodbook.operators.sets import append_comparison
from periodbook.plans import acquisition
from periodbook.sources.tables import Tables, pruned_scan

UNIT = "delivery_unit"
SEGMENT = "ethnicity_user"
LOOKBACK = {"month": 13, "quarter": 5}


@dataclass(frozen=True)
class OrderTypes:
    """Restaurant order types of each group; the labels are the business's own, so there is no default.

    ``on_demand_base`` is the group behind the margin ratio's denominator.  The
    report leaves one on-demand type out of it; ``corrected`` uses the same group.
    """

    scheduled: Sequence[str]
    on_demand: Sequence[str]
    on_demand_base: Sequence[str]


@dataclass(frozen=True)
class Review:
    """What a scorecard run is about."""

    as_of: date
    unit: Unit
    gate: str = dim.GATE_SEGMENT
    order_types: OrderTypes | None = None
    booking_start: date = acquisition.BOOKING_START
    overhead_start: date = acquisition.OVERHEAD_START
    lookback: int | None = None
    corrected: bool = False

    @property
    def window(self) -> PeriodWindow:
        return scorecard_window(self.as_of, self.unit)

    @property
    def coarse(self) -> date:
        return coarse_day_bound(self.as_of, self.unit)

    def scan(self, df: DataFrame, day: str, raw_date: str | None = None) -> DataFrame:
        """Rows of the window with their period; ``raw_date`` gets the loose bound."""
        keyed = df.withColumn(UNIT, period_key(day, self.unit))
        return pruned_scan(keyed, F.col(UNIT), self.window, raw_date, self.coarse, day)


# --- commerce by segment ------------------------------------------------------


def price_special_windows(
    prices: DataFrame, specials: DataFrame, ends_after: date | None = None
) -> DataFrame:
    """Distinct reasons per product and price region with their padded local hours."""
    s = specials.select(
        "product_price_id",
        "reason",
        epoch_to_local("start_time", dim.LOCAL_ZONE).alias("start_time_new"),
        epoch_to_local("end_time", dim.LOCAL_ZONE).alias("end_time_new"),
    )
    rows = prices.join(s, prices["id"] == s["product_price_id"]).select(
        "product_id",
        "sales_org_id",
        "reason",
        "start_time_new",
        "end_time_new",
        (F.col("start_time_new") - F.expr(f"INTERVAL {dim.WINDOW_PAD_BEFORE} SECONDS")).alias(
            "start_time_extended"
        ),
        (F.col("end_time_new") + F.expr(f"INTERVAL {dim.WINDOW_PAD_AFTER} SECONDS")).alias(
            "end_time_extended"
        ),
    )
    if ends_after is None:  # a special that never ends is no special: it has no end time
        rows = rows.filter(F.col("end_time_extended").isNotNull())
    else:
        rows = rows.filter(F.col("end_time_extended").cast("date") >= F.lit(ends_after))
    return rows.distinct()


def price_interval_map(
    windows: DataFrame, price_regions: DataFrame, by: str = "day"
) -> DataFrame:
    """Specials per product and day (or month), of all price regions: the orgs a special holds for come with it.

    An org counts once for a price region, however often it is listed.
    """
    served = price_regions.groupBy("price_region_id").agg(F.collect_set("sales_org_id").alias("orgs"))
    spans = windows.withColumnRenamed("sales_org_id", "price_region_id").join(
        served, "price_region_id", "left"
    )
    return interval_map(
        spans, "product_id", "start_time_extended", "end_time_extended",
        ["price_region_id", "orgs", "reason"], by=by,
    )


def with_price_reason(
    lines: DataFrame, price_regions: DataFrame, windows: DataFrame
) -> DataFrame:
    """Lines with the reason of their discount.

    A line's own reason counts first, then a special of its price region at order
    time, then (pantry lines) one of the region its org is served from.  Overlapping
    specials repeat a line, as a plain left join does.

    Both are looked up in one array of the product's specials of that month, so the lines
    meet the specials in one join (on product and month: a hot product is spread over its
    months, a special of weeks is not listed under each of its days), and the price regions
    only meet the specials.
    """
    specials = price_interval_map(windows, price_regions, by="month")
    no_reason = F.col("discount_reason").isNull()
    at = F.col("order_create_time")
    met = (
        no_reason
        & (F.col("product_id") == F.col("_key"))
        & (month_start(at) == F.col("_day"))
    )
    found = lines.join(specials, met, "left").withColumn("_spans", covering(F.col("_spans"), at))
    pantry = lookup("sales_org_id", dim.PANTRY_PRICE_REGIONS).cast("bigint")
    none = F.array(F.lit(None).cast("string"))

    def reasons(hits: Column) -> Column:
        """The reasons of the specials met, or one missing reason."""
        return F.when(F.size(hits) > 0, F.transform(hits, lambda s: s["reason"])).otherwise(none)

    direct = reasons(F.filter("_spans", lambda s: F.array_contains(s["orgs"], F.col("sales_org_id"))))
    served = reasons(
        F.filter("_spans", lambda s: (s["price_region_id"] == pantry) & (F.col("mail_type") == "pantry"))
    )
    every = F.flatten(F.transform(direct, lambda d: F.transform(served, lambda p: F.coalesce(d, p))))
    return found.select(
        *lines.columns, F.explode(every).alias("_found")
    ).withColumn("promo_reason", F.coalesce("discount_reason", "_found")).drop("_found")


def promo_measures(corrected: bool = False) -> list[Column]:
    """Discount dollars by who funds them; NULL when no line qualifies.

    The boost measure also takes every line without a reason, whatever its price
    type; ``corrected`` asks for a promotional price there too.
    """
    reason = F.col("promo_reason")
    promo = F.col("price_type").isin(*dim.PROMO_PRICE_TYPES)
    dollars = (F.col("product_base_price") - F.col("product_price")) * F.col("quantity")
    none = reason.isNull() | (reason == "")
    conditions = {
        "vendor_funded_promo": promo & reason.isin(*dim.VENDOR_REASONS),
        "boost_rev_promo": (
            promo & ((reason == "Boost Revenue") | none)
            if corrected
            else (promo & (reason == "Boost Revenue")) | none
        ),
        "clearance_promo": promo & (reason == "Clearance"),
        "expiring_control_promo": promo & (reason == "Expiring Control"),
        "freeup_space_promo": promo & reason.contains("Freeup space"),
        "vendor_sponsored_promo": promo & reason.contains("Vendor Sponsored Promotion"),
    }
    return [sum_only(cond, dollars).alias(name) for name, cond in conditions.items()]


def _returned() -> Column:
    return F.col("product_refund_amount") * F.col("is_gm")


def commerce_measures() -> list[Column]:
    return [
        F.sum("sub_total").alias("gross_rev"),
        safe_div(F.sum("gm_margin"), F.sum("gm_base")).alias("prod_gm"),
        F.sum("gm_margin").alias("gm_margin"),
        F.sum("gm_base").alias("gm_base"),
    ]


def division_measures(value: Column, pattern: str) -> list[Column]:
    return [
        sum_when(F.col("division") == title, value).alias(pattern.format(d))
        for d, title in dim.DIVISIONS.items()
    ]


def return_measures() -> list[Column]:
    out = []
    for b, inside in in_buckets().items():
        out.append(sum_only(inside, _returned()).alias(f"refund_amount_{b}"))
        out.append(sum_only(inside, F.col("sub_total")).alias(f"gross_rev_{b}"))
    return out


def user_counts() -> dict[str, Column | None]:
    return {"active_users": None}


def new_user_counts() -> dict[str, Column | None]:
    new = F.col("daily_new_users_flag") == 1
    return {"new_users": new} | {
        f"new_users_{b}": inside & new for b, inside in in_buckets().items()
    }


def active_user_counts() -> dict[str, Column | None]:
    return {f"users_{b}": inside for b, inside in in_buckets().items()}


def order_counts() -> dict[str, Column | None]:
    oos = F.col("is_gm") == 0
    out: dict[str, Column | None] = {"total_orders": None, "oos_orders": oos}
    for b, inside in in_buckets().items():
        out[f"total_orders_{b}"] = inside
        out[f"oos_orders_{b}"] = inside & oos
    return out


def return_order_counts() -> dict[str, Column | None]:
    returned = _returned() > 0
    return {
        f"return_orders_{b}": inside & returned for b, inside in in_buckets().items()
    }


def commerce_lines(t: Tables, r: Review) -> DataFrame:
    lines = r.scan(t["order_product"], "delivery_day", "order_day")
    kept = lines.filter(F.col("order_biz_type") != dim.RESTAURANT_BIZ_TYPE)
    return kept.withColumn("bucket", region_bucket())


def priced_commerce_lines(t: Tables, r: Review) -> DataFrame:
    windows = price_special_windows(
        t["product_price"], t["product_price_special"], r.coarse
    )
    return with_price_reason(commerce_lines(t, r), t["sales_org_price_region"], windows)


def segment_sums(lines: DataFrame, measures: Sequence[Column]) -> DataFrame:
    return lines.groupBy(UNIT, SEGMENT).agg(*measures)


def segment_counts(lines: DataFrame, spec: dict[str, dict[str, Column | None]]) -> DataFrame:
    return distinct_counts(lines, [UNIT, SEGMENT], spec)


def join_segments(sums: DataFrame, counts: DataFrame) -> DataFrame:
    """Both frames hold the same (period, segment) groups; a NULL segment is a group too."""
    c = counts.withColumnsRenamed({UNIT: "_u", SEGMENT: "_s"})
    cond = (sums[UNIT] == c["_u"]) & sums[SEGMENT].eqNullSafe(c["_s"])
    return sums.join(c, cond).drop("_u", "_s")


def commerce_by_segment(t: Tables, r: Review) -> DataFrame:
    """Revenue, margin, users, orders and deliveries per segment."""
    return join_segments(
        segment_sums(priced_commerce_lines(t, r), commerce_measures()),
        segment_counts(
            commerce_lines(t, r),
            {
                "buyer_id": user_counts(),
                "group_invoice_id": {"delivery_cnt": None},
                "order_id": {"total_orders": None},
            },
        ),
    )


def division_revenue(t: Tables, r: Review) -> DataFrame:
    return segment_sums(
        priced_commerce_lines(t, r), division_measures(F.col("sub_total"), "eth_{}_rev")
    )


def division_returns(t: Tables, r: Review) -> DataFrame:
    return segment_sums(
        priced_commerce_lines(t, r), division_measures(_returned(), "eth_return_{}_rev")
    )


def new_users_by_region(t: Tables, r: Review) -> DataFrame:
    return segment_counts(commerce_lines(t, r), {"buyer_id": new_user_counts()})


def active_users_by_region(t: Tables, r: Review) -> DataFrame:
    return segment_counts(commerce_lines(t, r), {"buyer_id": active_user_counts()})


def orders_oos_by_region(t: Tables, r: Review) -> DataFrame:
    return segment_counts(commerce_lines(t, r), {"order_id": order_counts()})


def returns_by_region(t: Tables, r: Review) -> DataFrame:
    return join_segments(
        segment_sums(priced_commerce_lines(t, r), return_measures()),
        segment_counts(commerce_lines(t, r), {"order_id": return_order_counts()}),
    )


def promo_funding(t: Tables, r: Review) -> DataFrame:
    return segment_sums(priced_commerce_lines(t, r), promo_measures(r.corrected))


def commerce_block(t: Tables, r: Review) -> DataFrame:
    """All commerce metrics per segment: one pass for sums, one for distinct counts.

    With ``corrected``, overlapping specials no longer inflate the other sums: only
    the promotion measures are taken over the lines they repeat.
    """
    plain = commerce_lines(t, r)
    priced = priced_commerce_lines(t, r)
    sums = [
        *commerce_measures(),
        *division_measures(F.col("sub_total"), "eth_{}_rev"),
        *return_measures(),
        *division_measures(_returned(), "eth_return_{}_rev"),
    ]
    promo = promo_measures(r.corrected)
    if r.corrected:
        block = join_segments(segment_sums(plain, sums), segment_sums(priced, promo))
    else:
        block = segment_sums(priced, [*sums, *promo])
    counts = segment_counts(
        plain,
        {
            "buyer_id": user_counts() | new_user_counts() | active_user_counts(),
            "group_invoice_id": {"delivery_cnt": None},
            "order_id": order_counts() | return_order_counts(),
        },
    )
    return join_segments(block, counts)


# --- company-wide metrics -----------------------------------------------------


def net_revenue_period(t: Tables, r: Review) -> DataFrame:
    """Discounts, points, net revenue, coupons and refunds; young refunds grossed up."""
    rows = r.scan(t["revenue_main"], "delivery_day")
    refund = as_money("shipped_and_refunded")
    if r.unit == "week" and is_immature(r.as_of, (8, 9)):
        last_week = shift_date(floor_date(r.as_of, "week"), "week", -1)
        grown = F.col("shipped_and_refunded").cast("double") / F.lit(dim.REFUND_SHARE_SCORECARD)
        refund = F.when(F.col(UNIT) == F.lit(last_week), as_money(grown)).otherwise(refund)
    points = F.col("expense_pct").cast("double") / F.lit(100.0) * F.col("revenue").cast("double")
    return rows.groupBy(UNIT).agg(
        F.sum("discount").alias("discount"),
        F.sum(as_money(points)).alias("points_expense"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("new_user_coupon").alias("new_user_coupon"),
        F.sum("oos").alias("oos"),
        F.sum(refund).alias("shipped_and_refunded"),
        F.sum("total_discount").alias("total_discount"),
    )


def sessions(t: Tables, r: Review) -> DataFrame:
    rows = r.scan(t["sessions_details"], "sess_date", "sess_date")
    return rows.groupBy(UNIT).agg(
        F.sum("orders").alias("orders"), F.count_distinct("session_id").alias("total_sessions")
    )


def nps_by_region(t: Tables, r: Review) -> DataFrame:
    rows = r.scan(t["survey_response"], "response_date", "response_date").filter(
        F.col("question_id") == dim.FIRST_QUESTION
    )
    region = F.col("response_region")
    titles = dim.BUCKET_TITLES | {"mo": dim.SURVEY_MAIL_ORDER_TITLE}
    members: dict[str, Column | None] = {"nps": None}
    members |= {f"nps_{b}": region == title for b, title in titles.items()}
    return net_promoter_scores(rows, [UNIT], members)


def perfect_order_rate(t: Tables, r: Review) -> DataFrame:
    rows = r.scan(t["perfect_order"], "delivery_day").filter(F.col("delivery_type") == "grocery")
    bad, total = F.col("not_perfect_orders"), F.col("total_orders")
    rates = [one_minus_ratio(F.sum(bad), F.sum(total)).alias("perfect_order_rate")]
    for b, label in dim.BUCKET_LABELS.items():
        here = F.col("region") == label
        rates.append(
            one_minus_ratio(sum_when(here, bad), sum_when(here, total)).alias(
                f"perfect_order_rate_{b}"
            )
        )
    return rows.groupBy(UNIT).agg(*rates)


def acquisition_cost(t: Tables, r: Review) -> DataFrame:
    return acquisition.acquisition_cost(
        t, r.as_of, r.unit, r.booking_start, r.overhead_start, UNIT, r.corrected
    )


def restaurant_margin(t: Tables, r: Review) -> DataFrame:
    if r.order_types is None:
        raise ValueError("restaurant margin needs Review.order_types")
    rows = r.scan(t["restaurant_order"], "delivery_day", "order_day")
    kind = F.col("order_type")
    scheduled = kind.isin(*r.order_types.scheduled)
    demand = kind.isin(*r.order_types.on_demand)
    demand_base = demand if r.corrected else kind.isin(*r.order_types.on_demand_base)
    return rows.groupBy(UNIT).agg(
        sum_when(scheduled, "order_total").alias("sc_booking"),
        safe_div(sum_when(scheduled, "cm_margin"), sum_when(scheduled, "cm_base")).alias("sc_cm"),
        sum_when(demand, "order_total").alias("od_booking"),
        safe_div(sum_when(demand, "cm_margin"), sum_when(demand_base, "cm_base")).alias("od_cm"),
        F.sum("order_total").alias("sc_od_booking"),
        safe_div(F.sum("cm_margin"), F.sum("cm_base")).alias("sc_od_cm"),
    )


def division_scorecard(t: Tables, r: Review) -> DataFrame:
    """Revenue, users and margin of each division, in one pass; restaurants are not left out here."""
    rows = r.scan(t["order_product"], "delivery_day", "order_day")
    inside = {d: F.col("division") == title for d, title in dim.DIVISIONS.items()}
    sums = {}
    for d, cond in inside.items():
        sums[f"{d}_rev"] = F.when(cond, F.col("sub_total")).otherwise(F.lit(0))
        sums[f"_{d}_margin"] = F.when(cond, F.col("gm_margin"))
        sums[f"_{d}_base"] = F.when(cond, F.col("gm_base"))
    users = {"buyer_id": {f"{d}_user": cond for d, cond in inside.items()}}
    both = distinct_counts(rows, [UNIT], users, sums)
    margins = [safe_div(f"_{d}_margin", f"_{d}_base").alias(f"{d}_gm") for d in inside]
    return both.select(
        UNIT, *(f"{d}_rev" for d in inside), *margins, *(f"{d}_user" for d in inside)
    )


PLAN_COLUMNS = {
    "gross_rev_plan": "gross_rev_plan",
    "net_rev_plan": "net_rev_plan",
    "gm_plan": "prod_gm_plan",
    "new_users": "new_user_plan",
    "active_users": "active_user_plan",
    "arpu_plan": "arpu_plan",
}


def plan_targets(t: Tables, r: Review) -> DataFrame:
    """Plan rows of the run's unit."""
    rows = t["plan_data"].withColumn(UNIT, strict_cast("delivery_unit", "date"))
    kept = rows.filter(r.window.holds(UNIT) & (F.col("unit_type") == r.unit))
    return kept.select(UNIT, "unit_type", *(F.col(c).alias(out) for c, out in PLAN_COLUMNS.items()))


def on_time_delivery(t: Tables, r: Review) -> DataFrame:
    rows = r.scan(t["dispatch_performance"], "delivery_date", "delivery_date")
    regions = {b: F.col("sales_region") == label for b, label in dim.BUCKET_LABELS.items()}
    flags = {
        "on_time_deliveries": F.col("tms_on_time_flag") == "Y",
        "total_deliveries": None,
    }
    return distinct_pivot(rows, [UNIT], "invoice_id", regions, flags, overall=False)


def week_days_in_month(t: Tables, r: Review) -> DataFrame:
    """Per period: days of a week that share its first day's month, and whether the
    week straddles a month.  The window is on the week start for every unit."""
    begin = {
        "week": "week_begin_date", "month": "month_begin_date", "quarter": "quarter_begin_date",
    }[r.unit]
    days = t["calendar"].filter(r.window.holds("week_begin_date"))
    if r.unit != "week":
        return days.groupBy(F.col(begin).alias(UNIT)).agg(
            F.lit(0).cast("bigint").alias("same_month"), F.lit(0).alias("flag")
        )
    same = month_start("cal_date") == month_start("week_begin_date")
    return days.groupBy(F.col(begin).alias(UNIT)).agg(
        F.count_distinct(F.when(same, F.col("cal_date"))).alias("same_month"),
        F.max(F.when(same, F.lit(0)).otherwise(F.lit(1))).alias("flag"),
    )


DIVISION_PLANS = ("dairy_deli", "protein", "frozen", "produce", "dry_grocery", "gm_hbc")


def split_week_plan(t: Tables, r: Review) -> DataFrame:
    """Division margin plan per period; a week that straddles months blends two plans.

    The days after the month's end take the plan of the month *before* the week's;
    ``corrected`` takes the month after.  One conditional replaces the report's union
    of straddling and whole periods.
    """
    plan = t["division_plan"].withColumn("_month", strict_cast("delivery_month", "date"))
    other = F.add_months("_month", -1 if r.corrected else 1)
    here = plan.select(
        F.col("_month").alias("_m"), *(F.col(c).alias(f"_now_{c}") for c in DIVISION_PLANS)
    )
    # several plan rows for one month count once in a blend (the greatest value)
    merged = plan.groupBy(other.alias("_o")).agg(
        *(F.max(c).alias(f"_other_{c}") for c in DIVISION_PLANS)
    )
    best = here.groupBy("_m").agg(
        *(F.max(f"_now_{c}").alias(f"_best_{c}") for c in DIVISION_PLANS)
    )
    periods = week_days_in_month(t, r).withColumn("_month", month_start(UNIT))
    split = (
        periods.filter(F.col("flag") == 1)
        .join(best, F.col("_month") == F.col("_m"), "left")
        .join(merged, F.col("_month") == F.col("_o"), "left")
        .select(
            UNIT,
            *(
                blend_by_days(
                    F.col(f"_best_{c}"), F.col(f"_other_{c}"), F.col("same_month")
                ).alias(f"{c}_plan")
                for c in DIVISION_PLANS
            ),
        )
    )
    whole = (
        periods.filter(F.col("flag") == 0)
        .join(here, F.col("_month") == F.col("_m"), "left")
        .select(UNIT, *(F.col(f"_now_{c}").cast("double").alias(f"{c}_plan") for c in DIVISION_PLANS))
    )
    return split.unionByName(whole)


def case_rate(t: Tables, r: Review) -> DataFrame:
    """Deliveries, and deliveries with a support case, per inventory."""
    rows = r.scan(t["order_case_details"], "delivery_day", "order_day")
    prefix = part_of("inventory_title", "-", 1)
    inside = {b: prefix == p for b, p in dim.INVENTORY_PREFIXES.items()}
    has_case = any_of(
        F.col("order_case_id_np").isNotNull(), F.col("order_case_id_p").isNotNull()
    )
    flags = {"delivery_cnt": None, "delivery_case": has_case}
    return distinct_pivot(rows, [UNIT], "group_invoice_id", inside, flags, overall=False)


def sku_capacity(t: Tables, r: Review) -> DataFrame:
    rows = r.scan(t["sku_params_snapshot"], "date", "date")
    for c in ("is_food", "is_protein", "is_produce", "ethnicity"):
        rows = rows.filter(F.col(c) == "-")
    whole_site = part_of("title", "_", 3) == ""
    averages = []
    for city, word in dim.CITY_WORDS.items():
        for kind, code in dim.STORAGE_PREFIXES.items():
            cond = (
                (F.col("storage_type") == code) & whole_site & F.lower("title").contains(word)
            )
            averages.append(avg_when(cond, "max_sku_count").alias(f"{kind}_cap_{city}"))
    return rows.groupBy(UNIT).agg(*averages)


def sku_in_stock(t: Tables, r: Review) -> DataFrame:
    rows = r.scan(t["in_stock_rate"], "order_day", "order_day").filter(
        (F.col("sku_region_status") == "A") & (F.col("sku_availability") == 1)
    )
    department = part_of("department", "-", 1)
    conds: dict[str, Column | None] = {}
    for city, word in dim.CITY_WORDS.items():
        for kind, code in dim.STORAGE_PREFIXES.items():
            conds[f"{kind}_instock_{city}"] = (
                (F.col("storage_type") == code)
                & F.lower("sales_region_title").contains(word)
                & department.isin(*dim.STORAGE_DEPARTMENTS[kind])
            )
    return distinct_counts(rows, [UNIT], {"product_id": conds})


# --- assembly -----------------------------------------------------------------

COMPANY_METRICS = (
    net_revenue_period,
    sessions,
    nps_by_region,
    perfect_order_rate,
    acquisition_cost,
    restaurant_margin,
    division_scorecard,
    plan_targets,
    on_time_delivery,
    split_week_plan,
    case_rate,
    sku_capacity,
    sku_in_stock,
)


def scorecard(t: Tables, r: Review) -> DataFrame:
    """Commerce rows of every segment; company-wide metrics sit on the gate segment's row.

    A period without a gate row shows no company metrics.
    """
    sets: dict[bool, list[tuple[DataFrame, str]]] = {True: [], False: []}
    for metric in COMPANY_METRICS:
        key = f"_{metric.__name__}"
        from_sheet = metric in (plan_targets, split_week_plan)
        sets[from_sheet].append((metric(t, r).withColumnRenamed(UNIT, key), key))
    return attach_to_segment(
        commerce_block(t, r), UNIT, SEGMENT, r.gate, sets[False], unbounded=sets[True]
    )


def scorecard_report(t: Tables, r: Review) -> DataFrame:
    """Labelled and ordered; months and quarters repeat a year-ago period under the
    label of the period just before the window."""
    base = scorecard(t, r)
    here = monday_rule_start(r.as_of, r.unit)
    if r.unit == "week":
        shown = base.select(F.col(UNIT).alias("delivery_week"), *base.columns)
    else:
        lookback = r.lookback or LOOKBACK[r.unit]
        shown = append_comparison(
            base, UNIT, "delivery_week",
            source=comparison_period(r.as_of, r.unit, lookback),
            shown_as=shift_date(here, r.unit, -15),
        )
    return shown.orderBy("delivery_week", UNIT, SEGMENT)

