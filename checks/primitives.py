"""One query per relational building block, over whole tables, with its oracle."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checks import standins as st
from checks.registry import Registry
from checks.scorecard import BUCKETS, bucket, review, windows_cte
from checks.views import out, query, sunday
from checks.weekly import CARD_OUT, card
from periodbook import dimensions as dim
from periodbook.functions import periods as pd
from periodbook.functions.predicates import fold_region, in_buckets, is_pantry, region_bucket
from periodbook.functions.scalars import (
    as_money,
    epoch_to_local,
    lookup,
    month_from_label,
    part_of,
    safe_div,
    utc_to_local,
    whole_div,
    zero_if_null,
)
from periodbook.operators import aggregates as ag
from periodbook.operators import joins as jn
from periodbook.operators import windows as wn
from periodbook.operators.distincts import distinct_counts, distinct_pivot
from periodbook.operators.sets import append_comparison, stack
from periodbook.plans import rates, scorecard, weekly
from periodbook.sources.sheets import SheetSpec, parse_sheet, union_sheets
from periodbook.sources.sinks import report_result
from periodbook.sources.tables import Tables, pruned_scan

reg = Registry()
AS_OF = st.AS_OF


def rows() -> Column:
    return F.count("*").alias("n")


def op(t: Tables) -> DataFrame:
    return t["order_product"]


def q(spec: str, body: str, **ctes: str) -> str:
    """Oracle whose last step is ``body``, output columns typed by ``spec``."""
    return query(f"SELECT {out(spec)} FROM res", **ctes, res=body)


# --- sources and sinks ------------------------------------------------------------

reg.add(
    "scan_fact",
    lambda t: op(t).groupBy("delivery_month", "inventory_title").agg(rows(), F.sum("quantity").alias("qty")),
    q("d: delivery_month; s: inventory_title; l: n qty",
      "SELECT delivery_month, inventory_title, count(*) AS n, sum(quantity) AS qty FROM v_op GROUP BY 1, 2"),
)


def _pruned(t: Tables) -> DataFrame:
    window = pd.scorecard_window(AS_OF, "week")
    kept = pruned_scan(
        op(t), F.col("delivery_week"), window, "order_day", pd.coarse_day_bound(AS_OF, "week"), "delivery_day"
    )
    return kept.groupBy("delivery_week").agg(rows(), F.sum("sub_total").alias("rev"))


WEEKS15 = "(delivery_week BETWEEN DATE '2000-01-02' AND DATE '2000-04-02' OR delivery_week = DATE '1999-04-04')"
reg.add(
    "period_pruned_scan", _pruned,
    q("d: delivery_week; l: n; f: rev",
      f"""SELECT delivery_week, count(*) AS n, sum(sub_total) AS rev FROM v_op WHERE {WEEKS15}
          AND (order_day >= DATE '1999-12-13' OR order_day >= DATE '1999-03-21') GROUP BY 1"""),
)
reg.add(
    "multi_sheet_union", lambda t: union_sheets(t[s] for s in weekly.SHEETS),
    q("l: region_id; s: sales_region_title delivery_month inbound_pct wh_labor_pct packaging_pct "
      "processing_pct wh_pct ops_pct misc_pct", "SELECT * FROM v_regional_pl WHERE region_id <> 24"),
)
reg.add(
    "calendar_spine",
    lambda t: t["calendar"].join(
        op(t).groupBy(F.col("delivery_day").alias("cal_date")).agg(rows()), "cal_date", "left"
    ).withColumn("n", zero_if_null("n")),
    q("d: cal_date week_begin_date month_begin_date quarter_begin_date; l: n",
      """SELECT c.*, count(v.order_id) AS n FROM v_calendar c LEFT JOIN v_op v ON v.delivery_day = c.cal_date
         GROUP BY ALL"""),
)
reg.add(
    "inline_lookup",
    lambda t: t["labor_cost_detail"].groupBy(
        "warehouse", lookup("warehouse", dim.WAREHOUSE_REGIONS).alias("region_id")
    ).agg(rows()),
    q("s: warehouse; l: region_id n",
      """SELECT w.warehouse, m.r AS region_id, count(*) AS n FROM v_labor w LEFT JOIN (VALUES
           ('SF - Union City', 1), ('LA - La Mirada', 2), ('WA - Seattle', 4), ('NJ - Edison', 7),
           ('TX - Houston', 10), ('IL - Chicago', 15), ('FL - Tampa', 23)) m(k, r) ON m.k = w.warehouse GROUP BY 1, 2"""),
)
reg.add(
    "report_result",
    lambda t: report_result(
        op(t).groupBy("sales_region_title", "delivery_month").agg(F.sum("sub_total").alias("rev"), rows()),
        ["delivery_month", "sales_region_title", "rev"], ["sales_region_title", "delivery_month"],
    ),
    q("d: delivery_month; s: sales_region_title; f: rev",
      "SELECT delivery_month, sales_region_title, sum(sub_total) AS rev FROM v_op GROUP BY 1, 2 ORDER BY 2, 1"),
)
reg.add(
    "sheet_parse",
    lambda t: parse_sheet(
        t["monthly_actual_pl"],
        SheetSpec(("report_month", "delivery_month"), {"inbound": "inbound_pct", "gross": "gross_rev"},
                  keep=["sales_region_title"], required=["gross_rev"], absolute=True),
    ),
    q("s: sales_region_title; d: report_month; f: inbound gross",
      """SELECT sales_region_title, TRY_CAST(delivery_month AS DATE) AS report_month,
           abs(TRY_CAST(inbound_pct AS DOUBLE)) AS inbound, abs(TRY_CAST(gross_rev AS DOUBLE)) AS gross
         FROM v_actual_pl WHERE length(gross_rev) > 0"""),
)

# --- periods -----------------------------------------------------------------------

reg.add(
    "week_start_sunday",
    lambda t: op(t).groupBy("delivery_day").agg(rows()).select(
        "delivery_day", "n", pd.week_start("delivery_day").alias("by_step"),
        pd.week_start_by_trunc("delivery_day").alias("by_trunc"),
    ),
    q("d: delivery_day by_step by_trunc; l: n",
      f"""SELECT delivery_day, count(*) AS n, {sunday('delivery_day')} AS by_step,
            date_trunc('week', delivery_day + 1) - INTERVAL 1 DAY AS by_trunc FROM v_op GROUP BY 1"""),
)
for _unit in ("month", "quarter"):
    reg.add(
        f"{_unit}_start",
        lambda t, f=getattr(pd, f"{_unit}_start"): op(t).groupBy(f("delivery_day").alias("period")).agg(rows()),
        q("d: period; l: n", f"SELECT date_trunc('{_unit}', delivery_day) AS period, count(*) AS n FROM v_op GROUP BY 1"),
    )
_PERIOD = {
    "week": sunday("delivery_day"),
    "month": "date_trunc('month', delivery_day)",
    "quarter": "date_trunc('quarter', delivery_day)",
}
# the last 14 complete periods before 2000-04-10
_TRAIL = {
    "week": ("2000-01-02", "2000-04-02"),
    "month": ("1999-02-01", "2000-03-01"),
    "quarter": ("1996-10-01", "2000-01-01"),
}
for _unit, _expr in _PERIOD.items():
    reg.add(
        f"period_key_{_unit}",
        lambda t, u=_unit: op(t).groupBy(pd.period_key("delivery_day", u).alias("period")).agg(
            rows(), F.count_distinct("order_id").alias("orders")
        ),
        q("d: period; l: n orders",
          f"SELECT {_expr} AS period, count(*) AS n, count(DISTINCT order_id) AS orders FROM v_op GROUP BY 1"),
    )
    reg.add(
        "trailing_window" if _unit == "week" else f"trailing_window_{_unit}",
        lambda t, u=_unit: pruned_scan(
            op(t), pd.period_key("delivery_day", u), pd.trailing(AS_OF, u, 14), day="delivery_day"
        ).groupBy(pd.period_key("delivery_day", u).alias("period")).agg(rows()),
        q("d: period; l: n",
          f"""SELECT {_expr} AS period, count(*) AS n FROM v_op
              WHERE {_expr} >= DATE '{_TRAIL[_unit][0]}' AND {_expr} <= DATE '{_TRAIL[_unit][1]}' GROUP BY 1"""),
    )
reg.add(
    "trailing_window_sunday",
    # on a Sunday the two reports disagree about the last complete week
    lambda t: stack(*(
        pruned_scan(op(t), F.col("delivery_week"), w, day="delivery_day")
        .groupBy("delivery_week").agg(rows()).withColumn("rule", F.lit(rule))
        for rule, w in (("pnl", pd.trailing(st.AS_OF_SUNDAY, "week", 4)),
                        ("scorecard", pd.scorecard_window(st.AS_OF_SUNDAY, "week", 4)))
    )),
    q("s: rule; d: delivery_week; l: n",
      """SELECT 'pnl' AS rule, delivery_week, count(*) AS n FROM v_op
           WHERE delivery_week IN ('2000-03-12', '2000-03-19', '2000-03-26', '2000-04-02') GROUP BY 2
         UNION ALL SELECT 'scorecard', delivery_week, count(*) FROM v_op
           WHERE delivery_week IN ('2000-03-05', '2000-03-12', '2000-03-19', '2000-03-26', '1999-03-28') GROUP BY 2"""),
)
reg.add(
    "same_period_last_year",
    lambda t: op(t).filter(pd.scorecard_window(AS_OF, "week").holds("delivery_week"))
    .groupBy("delivery_week").agg(rows(), F.sum("sub_total").alias("rev")),
    q("d: delivery_week; l: n; f: rev",
      f"SELECT delivery_week, count(*) AS n, sum(sub_total) AS rev FROM v_op WHERE {WEEKS15} GROUP BY 1"),
)
reg.add(
    "latest_available_period",
    lambda t: wn.latest_period(
        t["monthly_actual_pl"].withColumn("m", F.col("delivery_month").cast("date"))
        .filter(pd.trailing(AS_OF, "month", 2).holds("m")), "m",
    ).select("m", "sales_region_title", "inbound_pct"),
    q("d: m; s: sales_region_title inbound_pct",
      """SELECT CAST(delivery_month AS DATE) AS m, sales_region_title, inbound_pct FROM v_actual_pl
         WHERE delivery_month IN ('2000-02-01', '2000-03-01')
         QUALIFY dense_rank() OVER (ORDER BY delivery_month DESC) = 1"""),
)
reg.add(
    "cutover_grain",
    lambda t: op(t).groupBy(
        pd.split_cutover("delivery_week", "delivery_day", st.CUTOVER.week).alias("key")
    ).agg(rows()).withColumn("week", pd.reroll_cutover("key", st.CUTOVER.week)),
    q("d: key week; l: n",
      """SELECT CASE WHEN delivery_week = DATE '2000-03-19' THEN delivery_day ELSE delivery_week END AS key,
           delivery_week AS week, count(*) AS n FROM v_op GROUP BY 1, 2"""),
)
reg.add(
    "split_week_days", lambda t: scorecard.week_days_in_month(t, review("week")),
    q("d: delivery_unit; l: same_month flag",
      f"""SELECT week_begin_date AS delivery_unit,
            least(7, date_diff('day', week_begin_date, last_day(week_begin_date)) + 1) AS same_month,
            CASE WHEN last_day(week_begin_date) < week_begin_date + 6 THEN 1 ELSE 0 END AS flag
          FROM v_calendar WHERE {WEEKS15.replace('delivery_week', 'week_begin_date')} GROUP BY 1"""),
)


def _lag_guard(t: Tables) -> DataFrame:
    parts = []
    for as_of in (st.AS_OF, st.AS_OF_SUNDAY, st.AS_OF_WED, date(2000, 4, 11)):
        last = pd.trailing(as_of, "week", 1)
        share = 0.9 if pd.is_immature(as_of) else 1.0
        share_b = 0.88 if pd.is_immature(as_of, (8, 9)) else 1.0
        parts.append(
            op(t).filter(last.holds("delivery_week"))
            .agg(F.sum("product_refund_amount").cast("double").alias("refund"))
            .select(F.lit(as_of).alias("as_of"), (F.col("refund") / share).alias("pnl"),
                    (F.col("refund") / share_b).alias("card"))
        )
    return stack(*parts)


reg.add(
    "data_lag_guard", _lag_guard,
    q("d: as_of; f: pnl card",
      """SELECT a AS as_of, CAST(sum(product_refund_amount) AS DOUBLE) / CASE WHEN a - w = 8 THEN 0.9::DOUBLE ELSE 1 END AS pnl,
           CAST(sum(product_refund_amount) AS DOUBLE) / CASE WHEN a - w IN (8, 9) THEN 0.88::DOUBLE ELSE 1 END AS card
         FROM (VALUES (DATE '2000-04-09', DATE '2000-04-02'), (DATE '2000-04-10', DATE '2000-04-02'),
                      (DATE '2000-04-11', DATE '2000-04-02'), (DATE '2000-04-12', DATE '2000-04-02')) x(a, w)
         JOIN v_op ON delivery_week = w GROUP BY a, w"""),
)

# --- projections and predicates -------------------------------------------------------

LINE = "l: order_id product_id; d: delivery_day; "
reg.add(
    "alias_chain",
    lambda t: op(t).groupBy("delivery_month").agg(
        F.sum("sub_total").alias("gross"), F.sum("product_refund_amount").alias("refund")
    ).withColumn("net", F.col("gross") - F.col("refund"))
    .withColumn("net_share", safe_div("net", "gross")),
    q("d: delivery_month; f: gross refund net net_share",
      """SELECT delivery_month, sum(sub_total) AS gross, sum(product_refund_amount) AS refund,
           sum(sub_total - product_refund_amount) AS net,
           CAST(sum(sub_total - product_refund_amount) AS DOUBLE) / CAST(sum(sub_total) AS DOUBLE) AS net_share
         FROM v_op GROUP BY 1"""),
)
reg.add(
    "alias_filter",
    lambda t: op(t).withColumn("quarter", pd.quarter_start("delivery_day"))
    .filter(F.col("quarter").between(F.lit(date(1999, 1, 1)), F.lit(date(2000, 1, 1))))
    .groupBy("quarter").agg(rows()),
    q("d: quarter; l: n",
      """SELECT date_trunc('quarter', delivery_day) AS quarter, count(*) AS n FROM v_op
         WHERE year(delivery_day) = 1999 OR (year(delivery_day) = 2000 AND month(delivery_day) <= 3) GROUP BY 1"""),
)
reg.add(
    "alias_in_window_or_agg",
    lambda t: t["labor_cost_detail"].withColumn("rid", lookup("warehouse", dim.WAREHOUSE_REGIONS))
    .groupBy("entry_week", "rid").agg(
        ag.sum_when((F.col("rid") == 2) & F.lower("department_name").contains("dry"), "labor_cost").alias("dry"),
        F.sum("labor_cost").alias("cost"),
    ).withColumn("rank_in_week", F.dense_rank().over(Window.partitionBy("entry_week").orderBy(F.desc("cost")))),
    q("d: entry_week; l: rid rank_in_week; f: dry cost",
      """SELECT *, dense_rank() OVER (PARTITION BY entry_week ORDER BY cost DESC) AS rank_in_week FROM (
           SELECT entry_week, rid, coalesce(sum(labor_cost) FILTER (WHERE rid = 2 AND department_name = 'OP - Dry'), 0) AS dry,
             sum(labor_cost) AS cost
           FROM (SELECT *, CASE warehouse WHEN 'SF - Union City' THEN 1 WHEN 'LA - La Mirada' THEN 2 WHEN 'WA - Seattle' THEN 4
               WHEN 'NJ - Edison' THEN 7 WHEN 'TX - Houston' THEN 10 WHEN 'IL - Chicago' THEN 15 WHEN 'FL - Tampa' THEN 23 END AS rid
             FROM v_labor) w GROUP BY 1, 2) g"""),
)
reg.add(
    "case_project",
    lambda t: op(t).groupBy(
        F.when(F.col("is_gm") == 0, F.lit("missing"))
        .otherwise(F.when(F.col("product_refund_amount") > 0, F.lit("refunded")).otherwise(F.lit("kept")))
        .alias("state"),
        "delivery_month",
    ).agg(rows()),
    q("s: state; d: delivery_month; l: n",
      """SELECT CASE WHEN is_gm = 0 THEN 'missing' WHEN product_refund_amount > 0 THEN 'refunded' ELSE 'kept' END AS state,
           delivery_month, count(*) AS n FROM v_op GROUP BY 1, 2"""),
)
reg.add(
    "region_fold",
    lambda t: fold_region(op(t)).groupBy("sales_region_id", "sales_region_title").agg(
        rows(), F.sum("sub_total").alias("rev")
    ),
    q("l: sales_region_id n; s: sales_region_title; f: rev",
      """SELECT CASE WHEN m THEN 3 ELSE sales_region_id END AS sales_region_id,
           CASE WHEN m THEN 'MAIL ORDER' ELSE sales_region_title END AS sales_region_title, count(*) AS n, sum(sub_total) AS rev
         FROM (SELECT *, sales_region_id = 24 OR biz_type ILIKE '%pantry%' AS m FROM v_op) x GROUP BY 1, 2"""),
)
_BUCKET_SQL = "CASE " + " ".join(f"WHEN {bucket(b)} THEN '{b}'" for b in ("mo", *BUCKETS)) + " END"
reg.add(
    "region_bucket",
    lambda t: op(t).groupBy(region_bucket().alias("bucket")).agg(rows(), F.count_distinct("buyer_id").alias("users")),
    q("s: bucket; l: n users",
      f"SELECT {_BUCKET_SQL} AS bucket, count(*) AS n, count(DISTINCT buyer_id) AS users FROM v_op GROUP BY 1"),
)

_PREDICATES: dict[str, tuple[Callable[[], Column], str]] = {
    "in_list": (
        lambda: F.col("sales_region_id").isin(15, 7) & F.col("order_biz_type").isin("grocery", "alcohol"),
        "sales_region_id IN (7, 15) AND order_biz_type IN ('alcohol', 'grocery')",
    ),
    "between": (
        lambda: F.col("delivery_day").between(F.lit(date(1999, 4, 1)), F.lit(date(2000, 3, 31))),
        "delivery_day >= DATE '1999-04-01' AND delivery_day <= DATE '2000-03-31'",
    ),
    "like": (
        lambda: F.lower("sales_region_title").contains("mail") | F.col("inventory_title").startswith("LA")
        | F.lower("division").like("d%y") | ~F.col("order_biz_type").contains("rest"),
        "sales_region_title ILIKE '%mail%' OR inventory_title LIKE 'LA%' OR lower(division) LIKE 'd%y' "
        "OR order_biz_type NOT LIKE '%rest%'",
    ),
    "neq_filter": (
        lambda: (F.col("order_biz_type") != "restaurant") & (F.col("discount_reason") != "Clearance"),
        "order_biz_type <> 'restaurant' AND discount_reason <> 'Clearance'",
    ),
    "null_predicate": (
        lambda: F.col("discount_reason").isNull() & F.col("coupon").isNotNull(),
        "discount_reason IS NULL AND coupon IS NOT NULL",
    ),
    "mixed_and_or": (
        lambda: (F.col("price_type").isin("sale", "lightening") & (F.col("discount_reason") == "Vendor funded"))
        | F.col("discount_reason").isNull() | (F.col("coupon") == ""),
        "price_type IN ('sale', 'lightening') AND discount_reason = 'Vendor funded' OR discount_reason IS NULL OR coupon = ''",
    ),
}
for _name, (_cond, _sql) in _PREDICATES.items():
    reg.add(
        _name,
        lambda t, c=_cond: op(t).filter(c()).groupBy("delivery_month").agg(rows(), F.sum("sub_total").alias("rev")),
        q("d: delivery_month; l: n; f: rev",
          f"SELECT delivery_month, count(*) AS n, sum(sub_total) AS rev FROM v_op WHERE {_sql} GROUP BY 1"),
    )
reg.add(
    "const_column",
    lambda t: op(t).groupBy("delivery_month").agg(rows()).select(
        "delivery_month", "n", F.lit(dim.COMPANY).alias("region"), F.lit(dim.REBATE_RATE).alias("rebate"),
        F.lit("").alias("blank"), F.lit(dim.SERVICE_RATE).alias("css"),
    ),
    q("d: delivery_month; l: n region; f: rebate css; s: blank",
      "SELECT delivery_month, count(*) AS n, 999 AS region, 0.023 AS rebate, '' AS blank, 0.001 AS css FROM v_op GROUP BY 1"),
)
reg.add(
    "select_distinct",
    lambda t: t["orders"].filter("payment_mode = 'F'").select("order_month", "order_day", "order_week").distinct(),
    q("d: order_month order_day order_week",
      "SELECT order_month, order_day, order_week FROM v_ord WHERE payment_mode = 'F' GROUP BY 1, 2, 3"),
)

# --- joins ------------------------------------------------------------------------------

_ORDER_DAYS = "SELECT order_day AS d, order_week AS w, count(*) AS booked FROM v_ord GROUP BY 1, 2"
_SHIP_DAYS = "SELECT delivery_day AS d, delivery_week AS w, count(*) AS shipped FROM v_op GROUP BY 1, 2"


def _order_days(t: Tables) -> DataFrame:
    return t["orders"].groupBy(F.col("order_day").alias("d"), F.col("order_week").alias("w")).agg(
        F.count("*").alias("booked")
    )


def _ship_days(t: Tables) -> DataFrame:
    return op(t).groupBy(F.col("delivery_day").alias("d"), F.col("delivery_week").alias("w")).agg(
        F.count("*").alias("shipped")
    )


reg.add(
    "inner_equi", lambda t: _order_days(t).join(_ship_days(t), ["d", "w"]),
    q("d: d w; l: booked shipped", "SELECT a.*, shipped FROM a JOIN b USING (d, w)", a=_ORDER_DAYS, b=_SHIP_DAYS),
)
reg.add(
    "left_equi", lambda t: _order_days(t).join(_ship_days(t), ["d", "w"], "left"),
    q("d: d w; l: booked shipped", "SELECT a.*, shipped FROM a LEFT JOIN b ON a.d = b.d AND a.w = b.w", a=_ORDER_DAYS, b=_SHIP_DAYS),
)
reg.add(
    "full_outer_coalesce",
    lambda t: jn.full_outer_zero(_order_days(t), _ship_days(t), ["d", "w"], ["booked", "shipped"]),
    q("d: d w; l: booked shipped",
      "SELECT coalesce(a.d, b.d) AS d, coalesce(a.w, b.w) AS w, coalesce(booked, 0) AS booked, coalesce(shipped, 0) AS shipped "
      "FROM a FULL JOIN b ON a.d = b.d AND a.w = b.w", a=_ORDER_DAYS, b=_SHIP_DAYS),
)


def _left_with_left(t: Tables) -> DataFrame:
    daily = op(t).groupBy("delivery_day", "sales_region_id").agg(F.sum("sub_total").alias("rev"))
    extra = t["labor_cost_detail"].filter("warehouse = 'LA - Greater'").groupBy("entry_date").agg(
        F.sum("labor_cost").alias("cost")
    )
    cond = (F.col("sales_region_id") == 2) & (F.col("delivery_day") == F.col("entry_date"))
    return jn.left_filtered(daily, extra, cond).drop("entry_date")


reg.add(
    "left_with_left_predicate", _left_with_left,
    q("d: delivery_day; l: sales_region_id; f: rev cost",
      """SELECT delivery_day, sales_region_id, rev, cost FROM (SELECT delivery_day, sales_region_id, sum(sub_total) AS rev FROM v_op GROUP BY 1, 2) a
         LEFT JOIN (SELECT entry_date, sum(labor_cost) AS cost FROM v_labor WHERE warehouse = 'LA - Greater' GROUP BY 1) b
           ON a.sales_region_id = 2 AND a.delivery_day = b.entry_date"""),
)


def _gated(t: Tables) -> DataFrame:
    base = op(t).groupBy("delivery_week", "ethnicity_user").agg(F.sum("sub_total").alias("rev"))
    a = op(t).groupBy(F.col("delivery_week").alias("_a")).agg(F.count_distinct("order_id").alias("orders"))
    b = t["dispatch_performance"].groupBy(F.col("delivery_week").alias("_b")).agg(F.count("*").alias("stops"))
    return jn.attach_to_segment(base, "delivery_week", "ethnicity_user", st.GATE, [(a, "_a"), (b, "_b")])


reg.add(
    "gated_attach", _gated,
    q("d: delivery_week; s: ethnicity_user; f: rev; l: orders stops",
      """SELECT x.*, orders, stops FROM (SELECT delivery_week, ethnicity_user, sum(sub_total) AS rev FROM v_op GROUP BY 1, 2) x
         LEFT JOIN (SELECT delivery_week AS w, count(DISTINCT order_id) AS orders FROM v_op GROUP BY 1) a ON a.w = delivery_week AND ethnicity_user = 'ASIA'
         LEFT JOIN (SELECT delivery_week AS w, count(*) AS stops FROM v_dispatch GROUP BY 1) b ON b.w = delivery_week AND ethnicity_user = 'ASIA'"""),
)


def _region_days(t: Tables) -> DataFrame:
    return op(t).groupBy("delivery_day", "sales_region_id").agg(F.sum("sub_total").alias("rev"))


_REGION_DAYS = "SELECT delivery_day, sales_region_id, sum(sub_total) AS rev FROM v_op GROUP BY 1, 2"
_MAIL_REV_OUT = "d: delivery_day; l: sales_region_id; f: rev mail_rev"


def _left_with_right(t: Tables) -> DataFrame:
    days = _region_days(t)
    mail = days.filter("sales_region_id = 3").select("delivery_day", F.col("rev").alias("mail_rev"))
    return days.join(mail, "delivery_day", "left")


_ROLE_SQL = """SELECT a.*, b.rev AS mail_rev FROM g a LEFT JOIN g b ON b.delivery_day = a.delivery_day AND b.sales_region_id = 3"""
reg.add("left_with_right_predicate", _left_with_right, q(_MAIL_REV_OUT, _ROLE_SQL, g=_REGION_DAYS))
reg.add(
    "role_self_join",
    lambda t: _region_days(t).withColumn(
        "mail_rev", jn.value_of_member("rev", F.col("sales_region_id") == 3, "delivery_day")
    ),
    q(_MAIL_REV_OUT, _ROLE_SQL, g=_REGION_DAYS),
)


def _interval(t: Tables) -> DataFrame:
    windows = scorecard.price_special_windows(t["product_price"], t["product_price_special"])
    lines = op(t).join(t["sales_org_price_region"], "sales_org_id", "left").select(
        "order_id", "product_id", "price_region_id", "order_create_time", "quantity", "discount_reason"
    )
    joined = jn.interval_join(
        lines, windows, {"product_id": "product_id", "price_region_id": "sales_org_id"},
        "order_create_time", "start_time_extended", "end_time_extended", ["reason"],
        when=F.col("discount_reason").isNull(),
    )
    return joined.groupBy("product_id", "reason").agg(rows(), F.sum("quantity").alias("qty"))


_INTERVAL_SQL = """SELECT o.product_id, w.reason, count(*) AS n, sum(quantity) AS qty FROM v_op o
  JOIN v_price_region p ON p.sales_org_id = o.sales_org_id
  LEFT JOIN win w ON w.product_id = o.product_id AND w.sales_org_id = p.price_region_id AND o.discount_reason IS NULL
    AND o.order_create_time >= w.start_time_extended AND o.order_create_time < w.end_time_extended GROUP BY 1, 2"""


def _interval_map(t: Tables) -> DataFrame:
    """The same result by one lookup per line in the sorted specials of its product and day."""
    windows = scorecard.price_special_windows(t["product_price"], t["product_price_special"])
    specials = scorecard.price_interval_map(windows, t["sales_org_price_region"])
    at, none = F.col("order_create_time"), F.array(F.lit(None).cast("string"))
    met = F.col("discount_reason").isNull() & (F.col("product_id") == F.col("_key")) & (at.cast("date") == F.col("_day"))
    hits = F.filter(jn.covering(F.col("_spans"), at), lambda s: F.array_contains(s["orgs"], F.col("sales_org_id")))
    reasons = F.when(F.size(hits) > 0, F.transform(hits, lambda s: s["reason"])).otherwise(none)
    found = op(t).join(specials, met, "left").select("product_id", "quantity", F.explode(reasons).alias("reason"))
    return found.groupBy("product_id", "reason").agg(rows(), F.sum("quantity").alias("qty"))


for _name, _build in (("interval_join", _interval), ("interval_join_by_day", _interval_map)):
    reg.add(
        _name, _build,
        q("l: product_id n qty; s: reason", _INTERVAL_SQL, win=windows_cte(None)),
    )
reg.add(
    "case_key_join",
    lambda t: op(t).withColumn("k", lookup("sales_org_id", dim.PANTRY_PRICE_REGIONS))
    .join(t["sales_org_price_region"].select(F.col("sales_org_id").alias("k"), "price_region_id"), "k", "left")
    .groupBy("sales_org_id", "k", "price_region_id").agg(rows()),
    q("l: sales_org_id k price_region_id n",
      """SELECT o.sales_org_id, k, p.price_region_id, count(*) AS n
         FROM (SELECT *, CASE WHEN sales_org_id IN (15, 17, 18, 20, 21, 23, 27, 28) THEN 16
                 WHEN sales_org_id IN (4, 8, 10, 13, 14, 19) THEN 3 END AS k FROM v_op) o
         LEFT JOIN v_price_region p ON p.sales_org_id = k GROUP BY 1, 2, 3"""),
)
reg.add(
    "fanout_average",
    lambda t: rates.rate_card(
        rates.reported_rates_ranked([t["regional_pl"]]), weekly.net_revenue(t, AS_OF), AS_OF
    ),
    q(CARD_OUT, "SELECT * FROM card", **card),
)
reg.add(
    "outer_made_inner",
    lambda t: t["orders"].join(t["order_discount"], "order_id").filter("type = 'coupon'")
    .groupBy("order_week").agg(F.sum("amount").alias("amount"), rows()),
    q("d: order_week; f: amount; l: n",
      """SELECT order_week, sum(amount) AS amount, count(*) AS n FROM v_ord o LEFT JOIN v_discount d ON d.order_id = o.order_id
         WHERE d.type = 'coupon' GROUP BY 1"""),
)


def _month_shift(t: Tables) -> DataFrame:
    plan = t["division_plan"].withColumn("m", F.col("delivery_month").cast("date"))
    now = plan.select("m", F.col("protein").alias("now"))
    before = plan.select(F.add_months("m", 1).alias("m"), F.col("protein").alias("before"))
    months = op(t).groupBy(F.col("delivery_month").alias("m")).agg(rows())
    return months.join(now, "m", "left").join(before, "m", "left")


reg.add(
    "month_shift_join", _month_shift,
    q("d: m; l: n; f: now before",
      """SELECT m, n, a.protein AS now, b.protein AS before FROM (SELECT delivery_month AS m, count(*) AS n FROM v_op GROUP BY 1) x
         LEFT JOIN v_division_plan a ON CAST(a.delivery_month AS DATE) = m
         LEFT JOIN v_division_plan b ON CAST(b.delivery_month AS DATE) = m - INTERVAL 1 MONTH"""),
)
reg.add(
    "key_drift_join",
    lambda t: t["orders"].groupBy("delivery_day", F.col("order_week").alias("delivery_week")).agg(rows())
    .join(op(t).groupBy("delivery_day", "delivery_week").agg(F.count("*").alias("lines")),
          ["delivery_day", "delivery_week"], "left"),
    q("d: delivery_day delivery_week; l: n lines",
      """SELECT a.*, lines FROM (SELECT delivery_day, order_week AS delivery_week, count(*) AS n FROM v_ord GROUP BY 1, 2) a
         LEFT JOIN (SELECT delivery_day AS d, delivery_week AS w, count(*) AS lines FROM v_op GROUP BY 1, 2) b
           ON d = delivery_day AND w = delivery_week"""),
)
reg.add(
    "week_normalised_join",
    lambda t: t["labor_cost_detail"].groupBy(pd.week_start("entry_date").alias("w")).agg(
        F.sum("labor_cost").alias("cost")
    ).join(t["nj_labor"].select(F.col("delivery_week").cast("date").alias("w"), "inbound_pct"), "w", "left"),
    q("d: w; f: cost; s: inbound_pct",
      f"""SELECT w, cost, inbound_pct FROM (SELECT {sunday('entry_date')} AS w, sum(labor_cost) AS cost FROM v_labor GROUP BY 1) a
          LEFT JOIN v_nj_labor ON CAST(delivery_week AS DATE) = w"""),
)

# --- aggregates ---------------------------------------------------------------------------

reg.add(
    "group_by_ordinal",
    lambda t: op(t).groupBy("delivery_month", "sales_region_id", is_pantry().alias("pantry")).agg(rows())
    .withColumn("pantry", F.col("pantry").cast("int")).withColumn("rate", F.lit(dim.REBATE_RATE)),
    q("d: delivery_month; l: sales_region_id pantry n; f: rate",
      "SELECT delivery_month, sales_region_id, CAST(biz_type = 'pantry' AS INTEGER) AS pantry, 0.023 AS rate, count(*) AS n FROM v_op GROUP BY 1, 2, 3, 4"),
)
_SIMPLE: dict[str, tuple[Callable[[], Column], str, str]] = {
    "sum": (lambda: F.sum("sub_total"), "sum(sub_total)", "f"),
    "count_distinct": (lambda: F.count_distinct("buyer_id"), "count(DISTINCT buyer_id)", "l"),
    "conditional_sum": (
        lambda: ag.sum_when(F.col("is_gm") == 0, "sub_total"), "coalesce(sum(sub_total) FILTER (WHERE is_gm = 0), 0)", "f",
    ),
    "conditional_sum_no_else": (
        lambda: ag.sum_only((F.col("sales_region_id") == 23) & (F.col("line_number") == 7), "sub_total"),
        "sum(sub_total) FILTER (WHERE sales_region_id = 23 AND line_number = 7)", "f",
    ),
    "avg": (lambda: F.avg("quantity"), "avg(quantity)", "f"),
    "avg_conditional": (
        lambda: ag.avg_when(F.col("storage_type") == "F", "sub_total"),
        "CAST(sum(sub_total) FILTER (WHERE storage_type = 'F') AS DOUBLE) / count(*) FILTER (WHERE storage_type = 'F')", "f",
    ),
    "safe_ratio": (
        lambda: ag.ratio_of_sums("gm_margin", F.when(F.col("is_gm") == 0, F.lit(0)).otherwise(F.col("gm_base"))),
        "CAST(sum(gm_margin) AS DOUBLE) / nullif(CAST(sum(gm_base * is_gm) AS DOUBLE), 0)", "f",
    ),
    "null_zero_sum": (
        lambda: ag.sum_or_zero(F.when(F.col("discount_reason").isNull(), F.col("gm_cost")), places=2),
        "sum(round(CASE WHEN discount_reason IS NULL THEN gm_cost ELSE 0 END, 2))", "f",
    ),
    "one_minus_ratio": (
        lambda: ag.one_minus_ratio(ag.sum_when(F.col("is_gm") == 0, F.lit(1)), F.count("*")),
        "1 - CAST(count(*) FILTER (WHERE is_gm = 0) AS DOUBLE) / count(*)", "f",
    ),
    "max": (lambda: F.max("discount"), "max(discount)", "f"),
}
for _name, (_col, _sql, _kind) in _SIMPLE.items():
    reg.add(
        _name,
        lambda t, c=_col: op(t).groupBy("delivery_week").agg(c().alias("v")),
        q(f"d: delivery_week; {_kind}: v", f"SELECT delivery_week, {_sql} AS v FROM v_op GROUP BY 1"),
    )
reg.add(
    "max_dedupe",
    lambda t: op(t).groupBy("order_id", "group_invoice_id").agg(
        F.max("daily_new_users_flag").alias("flag"), F.max("discount").alias("coupon")
    ),
    q("l: order_id group_invoice_id flag; f: coupon",
      """SELECT DISTINCT order_id, group_invoice_id, daily_new_users_flag AS flag, discount AS coupon FROM v_op"""),
)


def _distinct_spec() -> dict[str, dict[str, Column | None]]:
    new = F.col("daily_new_users_flag") == 1
    returned = F.col("is_gm") * F.col("product_refund_amount") > 0
    orders: dict[str, Column | None] = {"orders": None, "oos_orders": F.col("is_gm") == 0}
    buyers: dict[str, Column | None] = {"buyers": None}
    for b, inside in in_buckets().items():
        buyers |= {f"buyers_{b}": inside, f"new_{b}": inside & new}
        orders |= {f"orders_{b}": inside, f"returned_{b}": inside & returned}
    return {"buyer_id": buyers, "order_id": orders, "group_invoice_id": {"invoices": None}}


def _cd(col: str, name: str, cond: str) -> str:
    return f"count(DISTINCT CASE WHEN {cond} THEN {col} END) AS {name}"


_CD_ITEMS = [_cd("buyer_id", "buyers", "true"), _cd("order_id", "orders", "true"),
             _cd("order_id", "oos_orders", "is_gm = 0"), _cd("group_invoice_id", "invoices", "true")]
for _b in (*BUCKETS, "mo"):
    _CD_ITEMS += [
        _cd("buyer_id", f"buyers_{_b}", bucket(_b)),
        _cd("buyer_id", f"new_{_b}", f"{bucket(_b)} AND daily_new_users_flag = 1"),
        _cd("order_id", f"orders_{_b}", bucket(_b)),
        _cd("order_id", f"returned_{_b}", f"{bucket(_b)} AND is_gm * product_refund_amount > 0"),
    ]
_CD_OUT = "d: delivery_month; s: ethnicity_user; l: buyers orders oos_orders invoices " + " ".join(
    f"buyers_{b} new_{b} orders_{b} returned_{b}" for b in (*BUCKETS, "mo")
)
reg.add(
    "conditional_count_distinct",
    lambda t: distinct_counts(
        op(t).withColumn("bucket", region_bucket()), ["delivery_month", "ethnicity_user"], _distinct_spec()
    ),
    q(_CD_OUT, f"SELECT delivery_month, ethnicity_user, {', '.join(_CD_ITEMS)} FROM v_op GROUP BY 1, 2"),
)
reg.add(
    "two_level_distinct_pivot",
    lambda t: distinct_pivot(
        op(t).withColumn("bucket", region_bucket()), ["delivery_week"], "buyer_id", in_buckets(),
        {"users": None, "new_users": F.col("daily_new_users_flag") == 1},
    ),
    q("d: delivery_week; l: users new_users " + " ".join(f"users_{b} new_users_{b}" for b in (*BUCKETS, "mo")),
      "SELECT delivery_week, count(DISTINCT buyer_id) AS users, " + _cd("buyer_id", "new_users", "daily_new_users_flag = 1") + ", "
      + ", ".join(_cd("buyer_id", f"users_{b}", bucket(b)) + ", " + _cd("buyer_id", f"new_users_{b}", f"{bucket(b)} AND daily_new_users_flag = 1")
                  for b in (*BUCKETS, "mo")) + " FROM v_op GROUP BY 1"),
)
reg.add(
    "ratio_pivot",
    lambda t: ag.ratio_pivot(
        op(t), ["delivery_week"], {d: F.col("division") == title for d, title in dim.DIVISIONS.items()},
        "gm_margin", "gm_base", "_gm",
    ),
    q("d: delivery_week; f: " + " ".join(f"{d}_gm" for d in dim.DIVISIONS),
      "PIVOT (SELECT delivery_week, d || '_gm' AS d, CAST(sum(gm_margin) AS DOUBLE) / nullif(CAST(sum(gm_base) AS DOUBLE), 0) AS r FROM "
      "(SELECT *, CASE division WHEN 'Produce' THEN 'produce' WHEN 'Protein' THEN 'protein' WHEN 'Frozen' THEN 'frozen' "
      "WHEN 'Dairy/Deli' THEN 'dairy' WHEN 'Dry Grocery' THEN 'dry' ELSE 'gm' END AS d FROM v_op) x GROUP BY 1, 2) "
      "ON d IN ('produce_gm', 'protein_gm', 'frozen_gm', 'dairy_gm', 'dry_gm', 'gm_gm') USING first(r) GROUP BY delivery_week"),
)
reg.add(
    "post_agg_expr",
    lambda t: op(t).groupBy("delivery_week").agg(
        F.sum("sub_total").alias("gross"), F.sum("discount").alias("d"), F.sum("daily_new_users_flag").alias("u")
    ).select("delivery_week", (F.col("d") - 10 * F.col("u")).alias("coupon"),
             (F.col("gross") - F.col("d")).alias("after")),
    q("d: delivery_week; f: coupon after",
      "SELECT delivery_week, sum(discount) - 10 * sum(daily_new_users_flag) AS coupon, sum(sub_total) - sum(discount) AS after FROM v_op GROUP BY 1"),
)
reg.add(
    "two_stage_dedupe_sum",
    lambda t: ag.max_then_sum(op(t), ["delivery_month"], "order_id", "discount", "coupon"),
    q("d: delivery_month; f: coupon",
      """SELECT delivery_month, sum(discount) AS coupon FROM (SELECT DISTINCT delivery_month, order_id, discount FROM v_op) x GROUP BY 1"""),
)
reg.add(
    "share_of_total",
    lambda t: ag.share_of_total(
        op(t).groupBy("delivery_day", "sales_region_id").agg(F.sum("sub_total").alias("rev")), "delivery_day", "rev", "share"
    ),
    q("d: delivery_day; l: sales_region_id; f: rev share",
      """SELECT g.*, CAST(rev AS DOUBLE) / CAST(t AS DOUBLE) AS share FROM g
         LEFT JOIN (SELECT delivery_day AS d, sum(sub_total) AS t FROM v_op GROUP BY 1) s ON s.d = delivery_day""", g=_REGION_DAYS),
)
reg.add(
    "ratio_in_group",
    lambda t: op(t).groupBy("delivery_day", "inventory_title").agg(
        safe_div(ag.sum_when(F.col("biz_type") == "pantry", "sub_total"), F.sum("sub_total")).alias("mo_pct")
    ),
    q("d: delivery_day; s: inventory_title; f: mo_pct",
      """SELECT delivery_day, inventory_title, CAST(sum(CASE WHEN biz_type = 'pantry' THEN sub_total ELSE 0 END) AS DOUBLE)
           / CAST(sum(sub_total) AS DOUBLE) AS mo_pct FROM v_op GROUP BY 1, 2"""),
)
reg.add(
    "manual_rollup",
    lambda t: ag.with_company_total(
        op(t), {"sales_region_id": 999, "sales_region_title": "Company"},
        ["delivery_month", "sales_region_id", "sales_region_title"],
        [F.count_distinct("buyer_id").alias("users"), F.sum("sub_total").alias("rev")],
    ),
    q("d: delivery_month; l: sales_region_id users; s: sales_region_title; f: rev",
      """SELECT delivery_month, sales_region_id, sales_region_title, count(DISTINCT buyer_id) AS users, sum(sub_total) AS rev
         FROM v_op GROUP BY 1, 2, 3 UNION ALL
         SELECT delivery_month, 999, 'Company', count(DISTINCT buyer_id), sum(sub_total) FROM v_op GROUP BY 1"""),
)
reg.add(
    "manual_rollup_additive",
    lambda t: ag.add_company_row(
        op(t).groupBy("delivery_month", "sales_region_id").agg(F.sum("sub_total").alias("rev")),
        "delivery_month", "sales_region_id", ["rev"],
    ),
    q("d: delivery_month; l: sales_region_id; f: rev",
      """SELECT delivery_month, coalesce(sales_region_id, 999) AS sales_region_id, sum(sub_total) AS rev FROM v_op
         GROUP BY ROLLUP (delivery_month, sales_region_id) HAVING delivery_month IS NOT NULL"""),
)
reg.add(
    "nps",
    lambda t: ag.net_promoter_scores(
        t["survey_response"], ["response_date"], {"nps": None, "nps_sf": F.col("response_region") == "SF Bay Area"}
    ),
    q("d: response_date; f: nps nps_sf",
      """SELECT response_date, round(sum(promoter_flag - detractor_flag) * 100::DOUBLE / count(DISTINCT response_id), 0) AS nps,
           round(sum(promoter_flag - detractor_flag) FILTER (WHERE response_region = 'SF Bay Area') * 100::DOUBLE
             / nullif(count(DISTINCT response_id) FILTER (WHERE response_region = 'SF Bay Area'), 0), 0) AS nps_sf
         FROM v_survey GROUP BY 1"""),
)
reg.add(
    "weighted_blend",
    lambda t: op(t).groupBy("delivery_week").agg(
        ag.sum_when(pd.month_start("delivery_day") == pd.month_start("delivery_week"), "sub_total").alias("a"),
        ag.sum_when(pd.month_start("delivery_day") != pd.month_start("delivery_week"), "sub_total").alias("b"),
    ).withColumn("k", F.least(F.lit(7), F.datediff(F.last_day("delivery_week"), "delivery_week") + 1))
    .withColumn("blend", ag.blend_by_days(F.col("a"), F.col("b"), F.col("k"))),
    q("d: delivery_week; f: a b blend; l: k",
      """SELECT *, CAST(a * k + (7 - k) * b AS DOUBLE) / 7 AS blend FROM (
           SELECT delivery_week, coalesce(sum(sub_total) FILTER (WHERE month(delivery_day) = month(delivery_week)), 0) AS a,
             coalesce(sum(sub_total) FILTER (WHERE month(delivery_day) <> month(delivery_week)), 0) AS b,
             least(7, last_day(delivery_week) - delivery_week + 1) AS k FROM v_op GROUP BY 1) x"""),
)
reg.add(
    "sum_of_avgs_ltv",
    lambda t: ag.lifetime_value(
        t["mkt_ltv"].groupBy("device", "wd").agg(safe_div(F.sum("revenue"), F.sum("cohort_buyers")).alias("v")),
        ["device"], "wd", "v", 6, 45,
    ),
    q("s: device; f: ltv",
      """SELECT device, sum(v) + 45 * max(v) FILTER (WHERE wd = 6) AS ltv FROM (
           SELECT device, wd, CAST(CAST(sum(revenue) AS DOUBLE) / sum(cohort_buyers) AS DECIMAL(24,6)) AS v FROM v_ltv GROUP BY 1, 2) x
         GROUP BY 1 HAVING bool_or(wd = 6)"""),
)

# --- windows, order, sets --------------------------------------------------------------------

reg.add(
    "dense_rank_global",
    lambda t: wn.latest_period(op(t), "delivery_month").groupBy("delivery_month", "sales_region_id").agg(rows()),
    q("d: delivery_month; l: sales_region_id n",
      """SELECT delivery_month, sales_region_id, count(*) AS n FROM (
           SELECT *, dense_rank() OVER (ORDER BY delivery_month DESC) AS rn FROM v_op) x WHERE rn = 1 GROUP BY 1, 2"""),
)
reg.add(
    "dense_rank_partitioned",
    lambda t: wn.rank_newest(
        op(t).groupBy("sales_region_id", "delivery_week").agg(rows()), "sales_region_id", "delivery_week"
    ),
    q("l: sales_region_id rn n; d: delivery_week",
      """SELECT sales_region_id, delivery_week, rn, count(*) AS n FROM (
           SELECT *, dense_rank() OVER (PARTITION BY sales_region_id ORDER BY delivery_week DESC) AS rn FROM v_op) x GROUP BY 1, 2, 3"""),
)
reg.add(
    "rank_after_group",
    lambda t: wn.week_rank_in_month(
        op(t).groupBy("delivery_week", "order_biz_type").agg(F.sum("sub_total").alias("rev")), "delivery_week"
    ),
    q("d: delivery_week; s: order_biz_type; l: rk; f: rev",
      """SELECT delivery_week, order_biz_type, sum(sub_total) AS rev,
           dense_rank() OVER (PARTITION BY date_trunc('month', delivery_week) ORDER BY delivery_week DESC) AS rk
         FROM v_op GROUP BY 1, 2"""),
)
reg.add(
    "lag_default",
    lambda t: wn.with_lag(
        op(t).groupBy("sales_region_id", "delivery_week").agg(F.sum("sub_total").alias("rev")),
        "rev", "sales_region_id", "delivery_week", "prior",
    ),
    q("d: delivery_week; l: sales_region_id; f: rev prior",
      """SELECT sales_region_id, delivery_week, rev, lag(rev) OVER (PARTITION BY sales_region_id ORDER BY delivery_week) AS prior
         FROM (SELECT sales_region_id, delivery_week, sum(sub_total) AS rev FROM v_op GROUP BY 1, 2) x"""),
)
reg.add(
    "carry_prior_for_latest",
    lambda t: wn.carry_all(
        op(t).groupBy("sales_region_id", "delivery_week").agg(
            F.sum("sub_total").alias("rev"), F.sum("gm_cost").alias("cost")
        ), {"rev": "rev", "cost": "rev"}, "sales_region_id", "delivery_week", date(2000, 4, 2),
    ),
    q("d: delivery_week; l: sales_region_id; f: rev cost",
      """SELECT sales_region_id, delivery_week,
           CASE WHEN delivery_week = DATE '2000-04-02' THEN lag(r) OVER w ELSE r END AS rev,
           CASE WHEN delivery_week = DATE '2000-04-02' THEN lag(c) OVER w ELSE r END AS cost
         FROM (SELECT sales_region_id, delivery_week, sum(sub_total) AS r, sum(gm_cost) AS c FROM v_op GROUP BY 1, 2) x
         WINDOW w AS (PARTITION BY sales_region_id ORDER BY delivery_week)"""),
)
reg.add(
    "order_final",
    lambda t: op(t).groupBy("sales_region_id", "delivery_week").agg(rows()).orderBy("sales_region_id", "delivery_week"),
    q("l: sales_region_id n; d: delivery_week",
      "SELECT sales_region_id, delivery_week, count(*) AS n FROM v_op GROUP BY 1, 2 ORDER BY 1, 2"),
)
reg.add(
    "top_n_periods",
    lambda t: wn.rank_newest(
        op(t).groupBy("sales_region_id", "delivery_month").agg(F.sum("sub_total").alias("rev")),
        "sales_region_id", "delivery_month",
    ).filter("rn <= 4"),
    q("l: sales_region_id rn; d: delivery_month; f: rev",
      """SELECT * FROM (SELECT sales_region_id, delivery_month, sum(sub_total) AS rev,
           row_number() OVER (PARTITION BY sales_region_id ORDER BY delivery_month DESC) AS rn FROM v_op GROUP BY 1, 2) x WHERE rn <= 4"""),
)
reg.add(
    "union_all",
    lambda t: stack(
        t["dispatch_performance"].groupBy("delivery_week").agg(F.sum("total_delivery_cost").alias("cost")),
        t["mail_order_shipment"].groupBy(pd.week_start("deal_delivery_date").alias("delivery_week")).agg(F.sum("rate").alias("cost")),
    ),
    q("d: delivery_week; f: cost",
      f"""SELECT delivery_week, sum(total_delivery_cost) AS cost FROM v_dispatch GROUP BY 1 UNION ALL
          SELECT {sunday('CAST(deal_delivery_date AS DATE)')}, sum(rate) FROM v_shipment GROUP BY 1"""),
)
reg.add(
    "union_all_nway",
    lambda t: union_sheets(op(t).filter(F.col("sales_region_id") == r) for r in st.REGION_IDS)
    .groupBy("sales_region_id", "delivery_month").agg(rows()),
    q("l: sales_region_id n; d: delivery_month",
      "SELECT sales_region_id, delivery_month, count(*) AS n FROM v_op GROUP BY 1, 2"),
)
reg.add(
    "split_union",
    lambda t: op(t).groupBy("delivery_week").agg(F.sum("sub_total").alias("rev"), F.sum("gm_cost").alias("cost"))
    .select("delivery_week", F.when(F.month(F.date_add("delivery_week", 6)) != F.month("delivery_week"),
                                    safe_div("cost", "rev")).otherwise(safe_div("rev", F.lit(7))).alias("v")),
    q("d: delivery_week; f: v",
      """SELECT delivery_week, CAST(sum(gm_cost) AS DOUBLE) / CAST(sum(sub_total) AS DOUBLE) AS v FROM v_op
           WHERE month(delivery_week + 6) <> month(delivery_week) GROUP BY 1
         UNION ALL SELECT delivery_week, CAST(sum(sub_total) AS DOUBLE) / 7 FROM v_op
           WHERE month(delivery_week + 6) = month(delivery_week) GROUP BY 1"""),
)
for _unit, _back, _from, _shown in (("month", 13, "1999-03-01", "1999-01-01"), ("quarter", 5, "1999-01-01", "1996-07-01")):
    reg.add(
        "relabel_append" if _unit == "month" else "relabel_append_quarter",
        lambda t, u=_unit, back=_back: append_comparison(
            op(t).groupBy(pd.period_key("delivery_day", u).alias("period")).agg(F.sum("sub_total").alias("rev")),
            "period", "label", pd.comparison_period(AS_OF, u, back),
            pd.shift_date(pd.floor_date(AS_OF, u), u, -15),
        ),
        q("d: label period; f: rev",
          f"SELECT period AS label, * FROM g UNION ALL SELECT DATE '{_shown}', * FROM g WHERE period = DATE '{_from}'",
          g=f"SELECT CAST(date_trunc('{_unit}', delivery_day) AS DATE) AS period, sum(sub_total) AS rev FROM v_op GROUP BY 1"),
    )

# --- scalar functions ----------------------------------------------------------------------------



def _label() -> Column:
    return F.concat(F.date_format("delivery_day", "MMM"), F.lit("'"), F.date_format("delivery_day", "yy"))


# name: expression, its SQL, output type; grouped over every order line
FUNCTIONS: dict[str, tuple[Callable[[], Column], str, str]] = {
    "lower": (lambda: F.lower("sales_region_title"), "lower(sales_region_title)", "s"),
    "split_part": (lambda: part_of("inventory_title", "-", 1), "rtrim(string_split(inventory_title, '-')[1])", "s"),
    "split_part_absent": (lambda: part_of("inventory_title", "_", 3), "''", "s"),
    "dateadd_week": (lambda: F.date_add("delivery_day", -7), "delivery_day - INTERVAL 1 WEEK", "d"),
    "dateadd_month": (lambda: F.add_months("delivery_day", -1), "delivery_day - INTERVAL 1 MONTH", "d"),
    "date_minus_int": (lambda: F.date_sub("delivery_day", 20), "delivery_day - 20", "d"),
    "date_plus_int": (lambda: F.date_add("delivery_day", 1), "delivery_day + 1", "d"),
    "date_trunc_week": (lambda: F.trunc("delivery_day", "week"), "delivery_day - (isodow(delivery_day) - 1)::INTEGER", "d"),
    "date_trunc_month": (lambda: F.trunc("delivery_day", "month"), "make_date(year(delivery_day), month(delivery_day), 1)", "d"),
    "date_trunc_quarter": (lambda: F.trunc("delivery_day", "quarter"), "make_date(year(delivery_day), 3 * quarter(delivery_day) - 2, 1)", "d"),
    "datepart_dow": (lambda: pd.day_of_week("delivery_day"), "isodow(delivery_day) % 7", "l"),
    "date_diff": (lambda: F.datediff("delivery_day", "order_day"), "delivery_day - order_day", "l"),
    "to_date_label": (lambda: month_from_label(_label()), "date_trunc('month', delivery_day)", "d"),
    "cast_date": (lambda: F.col("order_create_time").cast("date"), "order_create_time::DATE", "d"),
    "cast_text": (lambda: F.col("delivery_day").cast("string").try_cast("date"), "delivery_day::VARCHAR::DATE", "d"),
    "cast_blank": (lambda: F.col("coupon").try_cast("double"), "TRY_CAST(coupon AS DOUBLE)", "f"),
    "cast_int": (lambda: F.date_format("delivery_day", "d").try_cast("int"), "day(delivery_day)", "l"),
    "abs": (lambda: F.abs(F.col("discount") - 3), "abs(discount - 3)", "f"),
    "round": (lambda: F.round(F.col("product_base_price") / 10, 0), "round(product_base_price * 0.1, 0)", "f"),
    "coalesce": (lambda: F.coalesce("discount_reason", "coupon"), "ifnull(discount_reason, coupon)", "s"),
    "nvl_zero": (lambda: zero_if_null(F.when(F.col("is_gm") == 1, F.col("discount"))), "CASE WHEN is_gm = 1 THEN discount ELSE 0 END", "f"),
    "nullif": (lambda: safe_div(F.lit(12), F.nullif("discount", F.lit(0))), "12 / nullif(CAST(discount AS DOUBLE), 0)", "f"),
    "convert_timezone": (
        lambda: utc_to_local("order_create_time", dim.LOCAL_ZONE),
        "timezone('America/Los_Angeles', timezone('UTC', order_create_time))", "t",
    ),
    "interval_arithmetic": (
        lambda: F.col("order_create_time") + F.expr("INTERVAL 900 SECONDS"), "order_create_time + INTERVAL 15 MINUTE", "t",
    ),
    "integer_division": (lambda: whole_div(F.col("discount").cast("bigint") * 100 - 350, 100), "trunc((discount * 100 - 350) / 100)", "l"),
    "scaling": (
        lambda: F.col("discount").cast("double") * F.lit(100.0) / F.lit(0.88) * F.lit(1.01),
        "CAST(discount AS DOUBLE) * 100::DOUBLE / 0.88::DOUBLE * 1.01::DOUBLE", "f",
    ),
    "as_of_date": (lambda: F.datediff(F.lit(AS_OF), "delivery_day"), "DATE '2000-04-10' - delivery_day", "l"),
    "money": (lambda: as_money(F.col("product_price").cast("double") * F.lit(0.023)), "CAST(CAST(product_price AS DOUBLE) * 0.023::DOUBLE AS DECIMAL(24,6))", "f"),
}
# costly functions of the day alone, taken once per day
PER_DAY = ("to_date_label",)


def by_value(lines: DataFrame, value: Column) -> DataFrame:
    """Lines per value of an expression."""
    return lines.groupBy(value.alias("v")).agg(rows())


def by_value_of_day(lines: DataFrame, value: Column) -> DataFrame:
    """Lines per value of an expression of ``delivery_day``: lines are counted per day first."""
    days = lines.groupBy("delivery_day").agg(rows())
    return days.groupBy(value.alias("v")).agg(F.sum("n").alias("n"))


for _name, (_col, _sql, _kind) in FUNCTIONS.items():
    reg.add(
        f"fn_{_name}",
        lambda t, c=_col, by=by_value_of_day if _name in PER_DAY else by_value: by(op(t), c()),
        q(f"{_kind}: v; l: n", f"SELECT {_sql} AS v, count(*) AS n FROM v_op GROUP BY 1"),
    )
reg.add(
    "fn_epoch_to_local",
    lambda t: t["product_price_special"].groupBy(epoch_to_local("start_time", dim.LOCAL_ZONE).alias("v")).agg(rows()),
    q("t: v; l: n", "SELECT timezone('America/Los_Angeles', to_timestamp(start_time)) AS v, count(*) AS n FROM v_special GROUP BY 1"),
)
