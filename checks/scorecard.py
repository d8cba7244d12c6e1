"""Scorecard queries and their oracles (distinct counts spelled out one by one)."""

from __future__ import annotations

from datetime import date, timedelta
from functools import partial

from checks import standins as st
from checks.registry import Registry
from checks.views import out, query, start_of, sunday
from periodbook.plans import acquisition as acq
from periodbook.plans import scorecard as sc
from periodbook.sources.tables import Tables

reg = Registry()
M6 = "DECIMAL(24,6)"

# first and last period, year-ago week, loose lower bound; as of 2000-04-10 where no day is named
BOUNDS = {
    "week": ("2000-01-02", "2000-04-02", "1999-04-04", ("1999-12-13", "1999-03-21")),
    "month": ("1999-02-01", "2000-03-01", "1999-04-04", ("1999-01-12", "1999-03-21")),
    "quarter": ("1996-10-01", "2000-01-01", "1999-04-04", ("1996-09-11", "1999-03-21")),
    # on a Sunday the scorecard is still one week behind; Monday and Tuesday see the same weeks
    "week@sunday": ("1999-12-26", "2000-03-26", "1999-03-28", ("1999-12-06", "1999-03-14")),
    "month@sunday": ("1999-02-01", "2000-03-01", "1999-03-28", ("1999-01-12", "1999-03-14")),
    "week@tuesday": ("2000-01-02", "2000-04-02", "1999-04-04", ("1999-12-13", "1999-03-21")),
}
DAYS = {"": st.AS_OF, "sunday": st.AS_OF_SUNDAY, "tuesday": st.AS_OF_TUESDAY}
BUCKETS = {
    "sf": "SF Bay Area", "la": "LA - Greater", "ny": "New York", "sea": "Seattle",
    "tx": "Houston", "chi": "Chicago", "fl": "Tampa",
}
LABELS = {
    "sf": "1 - SF Bay Area", "la": "2 - LA - Greater", "sea": "4 - Seattle", "ny": "7 - New York",
    "tx": "10 - Houston", "chi": "15 - Chicago", "fl": "23 - Tampa",
}
DIVISIONS = {
    "produce": "Produce", "protein": "Protein", "frozen": "Frozen", "dairy": "Dairy/Deli",
    "dry": "Dry Grocery", "gm": "GM & HBC",
}


def base(unit: str) -> str:
    return unit.partition("@")[0]


def as_of(unit: str) -> date:
    return DAYS[unit.partition("@")[2]]


def review(unit: str, corrected: bool = False) -> sc.Review:
    return sc.Review(
        as_of(unit), base(unit), st.GATE, sc.OrderTypes(("RTG",), ("OD", "Partner", "Partner_vip"), ("OD", "Partner")),
        booking_start=st.BOOKING_START, overhead_start=st.OVERHEAD_START, corrected=corrected,
    )


def window(period: str, unit: str) -> str:
    lo, hi, anchor, _ = BOUNDS[unit]
    return f"({period} BETWEEN DATE '{lo}' AND DATE '{hi}' OR {period} = DATE '{anchor}')"


def loose(day: str, unit: str) -> str:
    a, b = BOUNDS[unit][3]
    return f"({day} >= DATE '{a}' OR {day} >= DATE '{b}')"


def rows(view: str, day: str, unit: str, raw: str | None = None, more: str = "true") -> str:
    u = start_of(day, base(unit))
    also = loose(raw, unit) if raw else "true"
    return f"(SELECT *, {u} AS delivery_unit FROM {view} WHERE {window(u, unit)} AND {also} AND {more}) r"


def bucket(b: str) -> str:
    if b == "mo":
        return "(sales_region_title IN ('MAIL ORDER', 'MOF') OR contains(lower(biz_type), 'pantry'))"
    return f"(sales_region_title = '{BUCKETS[b]}' AND NOT contains(lower(biz_type), 'pantry'))"


ALL_BUCKETS = (*BUCKETS, "mo")


def nd(col: str, name: str, cond: str | None = None) -> str:
    flt = f" FILTER (WHERE {cond})" if cond else ""
    return f"count(DISTINCT {col}){flt} AS {name}"


def total(value: str, name: str, cond: str, zero: bool = True) -> str:
    s = f"sum({value}) FILTER (WHERE {cond})"
    return f"{f'coalesce({s}, 0)' if zero else s} AS {name}"


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


# --- commerce by segment --------------------------------------------------------

LOCAL = "timezone('America/Los_Angeles', to_timestamp({c}))"


def windows_cte(unit: str | None) -> str:
    keep = loose("CAST(end_time_extended AS DATE)", unit) if unit else "true"
    return f"""
      SELECT DISTINCT * FROM (
        SELECT product_id, sales_org_id, reason, {LOCAL.format(c='start_time')} AS start_time_new,
          {LOCAL.format(c='end_time')} AS end_time_new,
          {LOCAL.format(c='start_time')} - INTERVAL 300 SECOND AS start_time_extended,
          {LOCAL.format(c='end_time')} + INTERVAL 900 SECOND AS end_time_extended
        FROM v_special JOIN v_price ON id = product_price_id) s
      WHERE {keep}"""


def priced_cte(lines: str) -> str:
    pantry = "CASE WHEN o.sales_org_id IN (15, 17, 18, 20, 21, 23, 27, 28) THEN 16 WHEN o.sales_org_id IN (4, 8, 10, 13, 14, 19) THEN 3 END"
    hit = "o.order_create_time >= {p}.start_time_extended AND o.order_create_time < {p}.end_time_extended AND o.product_id = {p}.product_id AND o.discount_reason IS NULL"
    return f"""
      SELECT o.*, coalesce(o.discount_reason, a.reason, b.reason) AS promo_reason
      FROM {lines} o LEFT JOIN v_price_region pr ON pr.sales_org_id = o.sales_org_id
      LEFT JOIN win a ON {hit.format(p='a')} AND a.sales_org_id = pr.price_region_id
      LEFT JOIN win b ON {hit.format(p='b')} AND o.mail_type = 'pantry' AND b.sales_org_id = {pantry}"""


def commerce_ctes(unit: str) -> dict[str, str]:
    return {
        "lines": "SELECT * FROM "
        + rows("v_op", "delivery_day", unit, "order_day", "order_biz_type <> 'restaurant'"),
        "win": windows_cte(unit),
        "priced": priced_cte("lines"),
    }


RETURNED = "product_refund_amount * is_gm"
PROMO_DOLLARS = "(product_base_price - product_price) * quantity"


def promo_items(corrected: bool = False) -> list[str]:
    offer = "price_type IN ('lightening', 'sale')"
    none = "(promo_reason IS NULL OR promo_reason = '')"
    boost = (
        f"{offer} AND (promo_reason = 'Boost Revenue' OR {none})"
        if corrected
        else f"({offer} AND promo_reason = 'Boost Revenue') OR {none}"
    )
    conds = {
        "vendor_funded_promo": f"{offer} AND promo_reason IN ('Vendor funded', 'Boost Revenue - Vendor fund')",
        "boost_rev_promo": boost,
        "clearance_promo": f"{offer} AND promo_reason = 'Clearance'",
        "expiring_control_promo": f"{offer} AND promo_reason = 'Expiring Control'",
        "freeup_space_promo": f"{offer} AND contains(promo_reason, 'Freeup space')",
        "vendor_sponsored_promo": f"{offer} AND contains(promo_reason, 'Vendor Sponsored Promotion')",
    }
    return [total(PROMO_DOLLARS, n, c, zero=False) for n, c in conds.items()]


PROMO_NAMES = (
    "vendor_funded_promo boost_rev_promo clearance_promo expiring_control_promo "
    "freeup_space_promo vendor_sponsored_promo"
)
commerce_sums = [
    "sum(sub_total) AS gross_rev", f"{ratio('sum(gm_margin)', 'sum(gm_base)')} AS prod_gm",
    "sum(gm_margin) AS gm_margin", "sum(gm_base) AS gm_base",
]
division_rev = [total("sub_total", f"eth_{d}_rev", f"division = '{t}'") for d, t in DIVISIONS.items()]
division_ret = [total(RETURNED, f"eth_return_{d}_rev", f"division = '{t}'") for d, t in DIVISIONS.items()]
return_sums = [
    item
    for b in ALL_BUCKETS
    for item in (
        total(RETURNED, f"refund_amount_{b}", bucket(b), zero=False),
        total("sub_total", f"gross_rev_{b}", bucket(b), zero=False),
    )
]
new_users = [nd("buyer_id", "new_users", "daily_new_users_flag = 1")] + [
    nd("buyer_id", f"new_users_{b}", f"daily_new_users_flag = 1 AND {bucket(b)}") for b in ALL_BUCKETS
]
users = [nd("buyer_id", f"users_{b}", bucket(b)) for b in ALL_BUCKETS]
order_items = [nd("order_id", "total_orders"), nd("order_id", "oos_orders", "is_gm = 0")]
for _b in ALL_BUCKETS:
    order_items += [
        nd("order_id", f"total_orders_{_b}", bucket(_b)),
        nd("order_id", f"oos_orders_{_b}", f"is_gm = 0 AND {bucket(_b)}"),
    ]
return_orders = [nd("order_id", f"return_orders_{b}", f"{RETURNED} > 0 AND {bucket(b)}") for b in ALL_BUCKETS]
SEG = "d: delivery_unit; s: ethnicity_user; "


def by_segment(items: list[str], source: str = "priced") -> str:
    return f"SELECT delivery_unit, ethnicity_user, {', '.join(items)} FROM {source} GROUP BY 1, 2"


def names(prefix: str, members: tuple | dict = ALL_BUCKETS) -> str:
    return " ".join(f"{prefix}_{m}" for m in members)


COMMERCE = {
    "commerce_by_segment": (
        sc.commerce_by_segment,
        [*commerce_sums, nd("buyer_id", "active_users"), nd("group_invoice_id", "delivery_cnt"), nd("order_id", "total_orders")],
        "f: gross_rev prod_gm gm_margin gm_base; l: active_users delivery_cnt total_orders",
    ),
    "division_revenue": (
        sc.division_revenue, division_rev, "f: " + " ".join(f"eth_{d}_rev" for d in DIVISIONS),
    ),
    "division_returns": (
        sc.division_returns, division_ret, "f: " + " ".join(f"eth_return_{d}_rev" for d in DIVISIONS),
    ),
    "new_users_by_region": (sc.new_users_by_region, new_users, "l: new_users " + names("new_users")),
    "active_users_by_region": (sc.active_users_by_region, users, "l: " + names("users")),
    "orders_oos_by_region": (
        sc.orders_oos_by_region, order_items,
        "l: total_orders oos_orders " + names("total_orders") + " " + names("oos_orders"),
    ),
    "returns_by_region": (
        sc.returns_by_region, [*return_sums, *return_orders],
        "f: " + names("refund_amount") + " " + names("gross_rev") + "; l: " + names("return_orders"),
    ),
    "promo_funding": (sc.promo_funding, promo_items(), "f: " + PROMO_NAMES),
}
for _name, (_fn, _items, _spec) in COMMERCE.items():
    for _unit in ("week", "month"):
        reg.add(
            _name if _unit == "week" else f"{_name}_month",
            partial(lambda t, fn, u: fn(t, review(u)), fn=_fn, u=_unit),
            query(f"SELECT {out(SEG + _spec)} FROM seg", **commerce_ctes(_unit), seg=by_segment(_items)),
        )
reg.add(
    "promo_funding_corrected",
    lambda t: sc.promo_funding(t, review("month", corrected=True)),
    query(
        f"SELECT {out(SEG + 'f: ' + PROMO_NAMES)} FROM seg",
        **commerce_ctes("month"), seg=by_segment(promo_items(True)),
    ),
)


def price_reason_all_dates(t: Tables):
    """Every order line of every date with its promotion reason, per segment."""
    windows = sc.price_special_windows(t["product_price"], t["product_price_special"])
    lines = t["order_product"].withColumnRenamed("delivery_month", "delivery_unit")
    return sc.segment_sums(
        sc.with_price_reason(lines, t["sales_org_price_region"], windows), sc.promo_measures()
    )


reg.add(
    "promo_funding_all_dates",
    price_reason_all_dates,
    query(
        f"SELECT {out(SEG + 'f: ' + PROMO_NAMES)} FROM seg",
        lines="SELECT *, delivery_month AS delivery_unit FROM v_op",
        win=windows_cte(None), priced=priced_cte("lines"), seg=by_segment(promo_items()),
    ),
)
WIN_OUT = "l: product_id sales_org_id; s: reason; t: start_time_new end_time_new start_time_extended end_time_extended"
reg.add(
    "price_special_windows",
    lambda t: sc.price_special_windows(
        t["product_price"], t["product_price_special"], review("week").coarse
    ),
    query(f"SELECT {out(WIN_OUT)} FROM win", win=windows_cte("week")),
)

# --- company-wide metrics ---------------------------------------------------------


def by_unit(items: list[str], source: str) -> str:
    return f"SELECT delivery_unit, {', '.join(items)} FROM {source} GROUP BY 1"


def net_revenue_sql(unit: str) -> str:
    refund = "shipped_and_refunded"
    if base(unit) == "week":
        refund = f"CASE WHEN DATE '{as_of(unit)}' - delivery_unit IN (8, 9) THEN CAST(CAST({refund} AS DOUBLE) / 0.88::DOUBLE AS {M6}) ELSE {refund} END"
    return by_unit(
        [
            "sum(discount) AS discount",
            f"sum(CAST(CAST(expense_pct AS DOUBLE) / 100::DOUBLE * CAST(revenue AS DOUBLE) AS {M6})) AS points_expense",
            "sum(net_revenue) AS net_revenue", "sum(new_user_coupon) AS new_user_coupon", "sum(oos) AS oos",
            f"sum(CAST({refund} AS {M6})) AS shipped_and_refunded", "sum(total_discount) AS total_discount",
        ],
        rows("v_revenue", "delivery_day", unit),
    )


def nps_sql(unit: str) -> str:
    def item(name: str, cond: str) -> str:
        net = f"(count(*) FILTER (WHERE promoter_flag = 1 AND {cond}) - count(*) FILTER (WHERE detractor_flag = 1 AND {cond}))"
        return f"round({net} * 100::DOUBLE / nullif(count(DISTINCT response_id) FILTER (WHERE {cond}), 0), 0) AS {name}"

    titles = BUCKETS | {"mo": "MAIL ORDER - WEST"}
    items = [item("nps", "true")] + [item(f"nps_{b}", f"response_region = '{t}'") for b, t in titles.items()]
    return by_unit(items, rows("v_survey", "response_date", unit, "response_date", "question_id = 1"))


def perfect_sql(unit: str) -> str:
    def item(name: str, cond: str) -> str:
        a = f"sum(not_perfect_orders) FILTER (WHERE {cond})"
        b = f"sum(total_orders) FILTER (WHERE {cond})"
        return f"1 - {ratio(a, b)} AS {name}"

    items = [item("perfect_order_rate", "true")]
    items += [item(f"perfect_order_rate_{b}", f"region = '{t}'") for b, t in LABELS.items()]
    return by_unit(items, rows("v_perfect", "delivery_day", unit, None, "delivery_type = 'grocery'"))


def restaurant_sql(unit: str, base: str = "('OD', 'Partner')") -> str:
    demand = "order_type IN ('OD', 'Partner', 'Partner_vip')"
    f = "sum({v}) FILTER (WHERE {c})"
    rtg = "order_type = 'RTG'"
    return by_unit(
        [
            total("order_total", "sc_booking", rtg),
            ratio(f.format(v="cm_margin", c=rtg), f.format(v="cm_base", c=rtg)) + " AS sc_cm",
            total("order_total", "od_booking", demand),
            ratio(f"coalesce({f.format(v='cm_margin', c=demand)}, 0)", f.format(v="cm_base", c=f"order_type IN {base}")) + " AS od_cm",
            "sum(order_total) AS sc_od_booking", ratio("sum(cm_margin)", "sum(cm_base)") + " AS sc_od_cm",
        ],
        rows("v_restaurant", "delivery_day", unit, "order_day"),
    )


def division_sql(unit: str) -> str:
    items = []
    for d, t in DIVISIONS.items():
        c = f"division = '{t}'"
        items += [
            total("sub_total", f"{d}_rev", c), nd("buyer_id", f"{d}_user", c),
            ratio(f"sum(gm_margin) FILTER (WHERE {c})", f"sum(gm_base) FILTER (WHERE {c})") + f" AS {d}_gm",
        ]
    return by_unit(items, rows("v_op", "delivery_day", unit, "order_day"))


def plan_sql(unit: str) -> str:
    return f"""SELECT CAST(delivery_unit AS DATE) AS delivery_unit, unit_type, gross_rev_plan, net_rev_plan,
        gm_plan AS prod_gm_plan, new_users AS new_user_plan, active_users AS active_user_plan, arpu_plan
      FROM v_plan WHERE unit_type = '{base(unit)}' AND {window('CAST(delivery_unit AS DATE)', unit)}"""


def on_time_sql(unit: str) -> str:
    items = []
    for b, t in LABELS.items():
        items += [
            nd("invoice_id", f"on_time_deliveries_{b}", f"sales_region = '{t}' AND tms_on_time_flag = 'Y'"),
            nd("invoice_id", f"total_deliveries_{b}", f"sales_region = '{t}'"),
        ]
    return by_unit(items, rows("v_dispatch", "delivery_date", unit, "delivery_date"))


DIV_PLANS = ("dairy_deli", "protein", "frozen", "produce", "dry_grocery", "gm_hbc")


def split_days_sql(unit: str) -> str:
    begin = f"{base(unit)}_begin_date"
    same = "date_trunc('month', cal_date) = date_trunc('month', week_begin_date)"
    if base(unit) == "week":
        items = f"count(DISTINCT cal_date) FILTER (WHERE {same}) AS same_month, CAST(NOT bool_and({same}) AS INTEGER) AS flag"
    else:
        items = "0 AS same_month, 0 AS flag"
    return f"SELECT {begin} AS delivery_unit, {items} FROM v_calendar WHERE {window('week_begin_date', unit)} GROUP BY 1"


def split_plan_sql(unit: str, shift: int = 1) -> str:
    items = ", ".join(
        f"""CASE WHEN flag = 1 THEN CAST(a.{p} * same_month + (7 - same_month) * b.{p} AS DOUBLE) / 7
            ELSE CAST(a.{p} AS DOUBLE) END AS {p}_plan"""
        for p in DIV_PLANS
    )
    return f"""SELECT delivery_unit, {items} FROM ({split_days_sql(unit)}) c
      LEFT JOIN v_division_plan a ON CAST(a.delivery_month AS DATE) = CAST(date_trunc('month', delivery_unit) AS DATE)
      LEFT JOIN v_division_plan b
        ON CAST(CAST(b.delivery_month AS DATE) + INTERVAL ({shift}) MONTH AS DATE) = CAST(date_trunc('month', delivery_unit) AS DATE)"""


def cases_sql(unit: str) -> str:
    items = []
    for b, p in {"fl": "FL", "chi": "IL", "la": "LA", "nj": "NJ", "sf": "SF", "tx": "TX", "sea": "WA"}.items():
        c = f"starts_with(inventory_title, '{p} -')"
        items += [
            nd("group_invoice_id", f"delivery_cnt_{b}", c),
            nd("group_invoice_id", f"delivery_case_{b}", f"{c} AND coalesce(order_case_id_np, order_case_id_p) IS NOT NULL"),
        ]
    return by_unit(items, rows("v_cases", "delivery_day", unit, "order_day"))


STORAGE = {"dry": "N", "frozen": "F", "ref": "R"}
CITIES = {"tx": "houston", "chi": "chicago", "fl": "tampa"}
DEPARTMENTS = {
    "dry": "('05', '06', '07', '09', '10', '11', '12', '14', '15', '16', '17', '20')",
    "frozen": "('03', '04', '08')", "ref": "('13')",
}


def capacity_sql(unit: str) -> str:
    items = [
        f"avg(max_sku_count) FILTER (WHERE storage_type = '{s}' AND len(string_split(title, '_')) < 3 "
        f"AND title ILIKE '%{c}%') AS {k}_cap_{b}"
        for b, c in CITIES.items()
        for k, s in STORAGE.items()
    ]
    plain = "is_food = '-' AND is_protein = '-' AND is_produce = '-' AND ethnicity = '-'"
    return by_unit(items, rows("v_sku", "date", unit, "date", plain))


def stock_sql(unit: str) -> str:
    items = [
        nd("product_id", f"{k}_instock_{b}",
           f"storage_type = '{s}' AND sales_region_title ILIKE '%{c}%' AND split_part(department, '-', 1) IN {DEPARTMENTS[k]}")
        for b, c in CITIES.items()
        for k, s in STORAGE.items()
    ]
    return by_unit(items, rows("v_stock", "order_day", unit, "order_day", "sku_region_status = 'A' AND sku_availability = 1"))


# --- acquisition --------------------------------------------------------------------

SEGMENT = """CASE device_type WHEN 'APP iOS' THEN 'iOS' WHEN 'APP Android' THEN 'Android' ELSE 'Web' END AS device,
  CASE WHEN language IN ('zh', 'zh-Hant') THEN 'Chinese' WHEN language = 'en' THEN 'English' ELSE 'OTHER' END AS language,
  CASE WHEN sales_org_id IN (3, 16) THEN 'Mail' ELSE 'Grocery' END AS region"""


def buyers_sql(day: str, week: str, flag: str, until: str = "2000-04-09") -> str:
    return f"""SELECT {day} AS time_day_unit, {week} AS time_week_unit, {SEGMENT}, count(DISTINCT buyer_id) AS new_d2c
      FROM v_ord WHERE payment_mode = 'F' AND {flag} = 1 AND {day} BETWEEN DATE '1995-01-01' AND DATE '{until}'
      GROUP BY ALL"""


booking_sql = buyers_sql("order_day", "order_week", "daily_new_users_flag_order")
earning_sql = buyers_sql("delivery_day", "delivery_week", "daily_new_users_flag")
ltv_ctes = {
    "per_week": f"""SELECT device, language, region, wd,
        CAST((CASE region WHEN 'Local' THEN 0.1::DOUBLE ELSE 0.05::DOUBLE END) * ({ratio('sum(revenue)', 'sum(cohort_buyers)')}) AS {M6}) AS v
      FROM v_ltv WHERE start_week <= DATE '2000-02-20' AND wd <= 6 GROUP BY 1, 2, 3, 4""",
    "value": f"""SELECT a.device, a.language, CASE a.region WHEN 'Local' THEN 'Grocery' ELSE a.region END AS region,
        CAST(a.s + 45 * b.v AS {M6}) AS ltv
      FROM (SELECT device, language, region, sum(v) AS s FROM per_week GROUP BY 1, 2, 3) a
      JOIN (SELECT * FROM per_week WHERE wd = 6) b
        ON a.device = b.device AND a.language = b.language AND a.region = b.region""",
}
both_ctes = {
    "booked": booking_sql,
    "earned": earning_sql,
    "both_days": """SELECT time_day_unit, time_week_unit, device, language, region,
        coalesce(b.new_d2c, 0) AS booked, coalesce(e.new_d2c, 0) AS earned
      FROM booked b FULL JOIN earned e USING (time_day_unit, time_week_unit, device, language, region)""",
}
DAY_OUT = "d: time_day_unit time_week_unit; "
BUYERS_OUT = DAY_OUT + "s: device language region; l: new_d2c"
reg.add(
    "new_buyers_by_order_day",
    lambda t: acq.new_buyers_by_order_day(t["orders"], st.AS_OF, st.BOOKING_START),
    query(f"SELECT {out(BUYERS_OUT)} FROM booked", booked=booking_sql),
)
reg.add(
    "new_buyers_by_delivery_day",
    lambda t: acq.new_buyers_by_delivery_day(t["orders"], st.AS_OF, st.BOOKING_START),
    query(f"SELECT {out(BUYERS_OUT)} FROM earned", earned=earning_sql),
)
reg.add(
    "ltv",
    lambda t: acq.ltv(t["mkt_ltv"], st.AS_OF),
    query(f"SELECT {out('s: device language region; f: ltv')} FROM value", **ltv_ctes),
)
reg.add(
    "booking_vs_revenue",
    lambda t: acq.booking_vs_revenue(t["orders"], t["mkt_ltv"], st.AS_OF, st.BOOKING_START),
    query(
        f"SELECT {out(DAY_OUT + 'l: booking_new_user revenue_new_user; f: total_booking_ltv total_revenue_ltv')} FROM days",
        **ltv_ctes, **both_ctes,
        days="""SELECT time_day_unit, time_week_unit, sum(booked) AS booking_new_user, sum(earned) AS revenue_new_user,
            sum(booked * ltv) AS total_booking_ltv, sum(earned * ltv) AS total_revenue_ltv
          FROM both_days LEFT JOIN value USING (device, language, region) GROUP BY 1, 2""",
    ),
)
spend_sql = f"""SELECT date AS time_day_unit, {sunday('date')} AS time_week_unit, sum(cost) AS marketing_spend
  FROM v_spend WHERE NOT starts_with(channel, 'Branding') GROUP BY 1, 2"""
reg.add(
    "marketing_spend",
    lambda t: acq.marketing_spend(t["marketing_spend"]),
    query(f"SELECT {out(DAY_OUT + 'f: marketing_spend')} FROM spend", spend=spend_sql),
)


def coupon_ctes(fan_out: bool = True) -> dict[str, str]:
    uses = (
        "LEFT JOIN v_coupon_use u ON u.order_id = o.order_id LEFT JOIN v_coupon_code c ON c.code = u.code"
        if fan_out
        else ""
    )
    base = f"""FROM v_ord o JOIN v_discount x ON x.order_id = o.order_id {uses}
      WHERE x.type = 'coupon' AND payment_mode = 'F' AND o.discount > 0
        AND coupon IN ('sign_up_coupon', 'order_share_sign_up_coupon')"""
    return {
        "c_order": f"SELECT order_day AS d, order_week AS w, sum(amount) AS a {base} AND order_day >= DATE '1995-01-01' GROUP BY 1, 2",
        "c_delivery": f"SELECT delivery_day AS d, delivery_week AS w, sum(amount) AS a {base} AND delivery_day >= DATE '1995-01-01' GROUP BY 1, 2",
        "coupons": """SELECT coalesce(a.d, b.d) AS time_day_unit, coalesce(a.w, b.w) AS time_week_unit,
            a.a AS new_user_book_coupon_amount, b.a AS new_user_rev_coupon_amount
          FROM c_order a FULL JOIN c_delivery b ON a.d = b.d AND a.w = b.w""",
    }


def _coupons(t: Tables, corrected: bool = False):
    return acq.coupon_spend(
        t["orders"], t["coupon_use"], t["coupon_code"], t["order_discount"], st.BOOKING_START, corrected
    )


COUPON_OUT = DAY_OUT + "f: new_user_book_coupon_amount new_user_rev_coupon_amount"
reg.add("coupon_spend", _coupons, query(f"SELECT {out(COUPON_OUT)} FROM coupons", **coupon_ctes()))
reg.add(
    "coupon_spend_corrected",
    lambda t: _coupons(t, corrected=True),
    query(f"SELECT {out(COUPON_OUT)} FROM coupons", **coupon_ctes(fan_out=False)),
)
_LOCAL_DAY = "CAST(timezone('America/Los_Angeles', timezone('UTC', rec_create_time)) AS DATE)"
referral_sql = f"""SELECT d AS time_day_unit, {sunday('d')} AS time_week_unit, sum(points // 100) AS referral_cost
  FROM (SELECT *, {_LOCAL_DAY} AS d FROM v_points WHERE type = 'p_user_referral') p
  WHERE d >= DATE '1995-01-01' GROUP BY 1, 2"""
reg.add(
    "referral_spend",
    lambda t: acq.referral_spend(t["user_points"], st.BOOKING_START),
    query(f"SELECT {out(DAY_OUT + 'l: referral_cost')} FROM referral", referral=referral_sql),
)
other_ctes = {
    "o_days": """SELECT DISTINCT order_month, order_day, order_week FROM v_ord
      WHERE payment_mode = 'F' AND order_month >= DATE '1994-12-01'""",
    "o_brand": "SELECT date, sum(cost) AS brand FROM v_spend WHERE starts_with(channel, 'Branding') GROUP BY 1",
    "other": """
      SELECT order_day AS time_day_unit, order_week AS time_week_unit,
        sum(content) AS content_marketing_spend, sum(salary_cost) AS salary_cost, sum(agency_fee) AS agency_fee,
        sum(contractor_fee) AS contractor_fee, sum(tools_cost) AS tools_cost, sum(brand) AS branding_cost,
        sum(ethnic) AS ethnic_cost,
        sum(content + salary_cost + agency_fee + contractor_fee + tools_cost + brand + ethnic) AS total_other_spend
      FROM (SELECT order_day, order_week, round(coalesce(content_marketing_spend, 0), 2) AS content, salary_cost,
              agency_fee, contractor_fee, tools_cost, coalesce(o_brand.brand, 0) AS brand,
              coalesce(es_ethnic_cost, 0) + coalesce(ja_ethnic_cost, 0) + coalesce(ko_ethnic_cost, 0)
                + coalesce(vi_ethnic_cost, 0) AS ethnic
            FROM o_days JOIN v_overheads ON month = order_month LEFT JOIN o_brand ON o_brand.date = order_day) s
      GROUP BY 1, 2""",
}
OTHER_OUT = DAY_OUT + (
    "f: content_marketing_spend salary_cost agency_fee contractor_fee tools_cost branding_cost "
    "ethnic_cost total_other_spend"
)
reg.add(
    "other_spend",
    lambda t: acq.other_spend(
        t["orders"], t["mkt_other_spend"], t["marketing_spend"], st.OVERHEAD_START
    ),
    query(f"SELECT {out(OTHER_OUT)} FROM other", **other_ctes),
)
acquisition_ctes = (
    both_ctes
    | {
        "spend": spend_sql,
        "referral": referral_sql,
        "a_days": "SELECT time_day_unit, time_week_unit, sum(earned) AS n FROM both_days GROUP BY 1, 2",
    }
    | coupon_ctes()
    | other_ctes
)
ACQ = {
    "marketing_spend": "marketing_spend", "new_user_rev_coupon_amount": "new_user_rev_coupon_amount",
    "referral_spend": "referral_cost", "content_marketing_spend": "content_marketing_spend",
    "salary_spend": "salary_cost", "agency_spend": "agency_fee", "contractor_spend": "contractor_fee",
    "tool_spend": "tools_cost",
}


def acquisition_sql(unit: str) -> str:
    u = start_of("time_day_unit", base(unit))
    items = [f"coalesce(sum({c}), 0) AS {n}" for n, c in ACQ.items()]
    every = " + ".join(f"coalesce(sum({c}), 0)" for c in ACQ.values())
    return f"""SELECT {u} AS delivery_unit, sum(n) AS revenue_new_user, {', '.join(items)}, {every} AS total_spend
      FROM a_days LEFT JOIN coupons USING (time_day_unit, time_week_unit) LEFT JOIN spend USING (time_day_unit, time_week_unit)
      LEFT JOIN referral USING (time_day_unit, time_week_unit) LEFT JOIN other USING (time_day_unit, time_week_unit)
      WHERE {window(u, unit)} GROUP BY 1"""


# name: function, oracle for a unit, output columns
METRICS = {
    "net_revenue_period": (
        sc.net_revenue_period, net_revenue_sql,
        "f: discount points_expense net_revenue new_user_coupon oos shipped_and_refunded total_discount",
    ),
    "sessions": (
        sc.sessions,
        lambda u: by_unit(["sum(orders) AS orders", nd("session_id", "total_sessions")], rows("v_sessions", "sess_date", u, "sess_date")),
        "l: orders total_sessions",
    ),
    "nps_by_region": (sc.nps_by_region, nps_sql, "f: nps " + names("nps")),
    "perfect_order_rate": (
        sc.perfect_order_rate, perfect_sql, "f: perfect_order_rate " + names("perfect_order_rate", LABELS),
    ),
    "acquisition_cost": (
        sc.acquisition_cost, acquisition_sql,
        "l: revenue_new_user referral_spend; f: total_spend " + " ".join(n for n in ACQ if n != "referral_spend"),
    ),
    "restaurant_margin": (
        sc.restaurant_margin, restaurant_sql, "f: sc_booking sc_cm od_booking od_cm sc_od_booking sc_od_cm",
    ),
    "division_scorecard": (
        sc.division_scorecard, division_sql,
        "f: " + " ".join(f"{d}_rev {d}_gm" for d in DIVISIONS) + "; l: " + " ".join(f"{d}_user" for d in DIVISIONS),
    ),
    "plan_targets": (
        sc.plan_targets, plan_sql,
        "s: unit_type; f: gross_rev_plan net_rev_plan prod_gm_plan arpu_plan; l: new_user_plan active_user_plan",
    ),
    "on_time_delivery": (
        sc.on_time_delivery, on_time_sql,
        "l: " + names("on_time_deliveries", LABELS) + " " + names("total_deliveries", LABELS),
    ),
    "split_week_plan": (sc.split_week_plan, split_plan_sql, "f: " + " ".join(f"{p}_plan" for p in DIV_PLANS)),
    "case_rate": (
        sc.case_rate, cases_sql,
        "l: " + " ".join(f"delivery_cnt_{b} delivery_case_{b}" for b in ("fl", "chi", "la", "nj", "sf", "tx", "sea")),
    ),
    "sku_capacity": (
        sc.sku_capacity, capacity_sql, "f: " + " ".join(f"{k}_cap_{b}" for b in CITIES for k in STORAGE),
    ),
    "sku_in_stock": (
        sc.sku_in_stock, stock_sql, "l: " + " ".join(f"{k}_instock_{b}" for b in CITIES for k in STORAGE),
    ),
}


def metric_query(name: str, unit: str, sql: str | None = None) -> str:
    _, make, spec = METRICS[name]
    extra = acquisition_ctes if name == "acquisition_cost" else {}
    return query(f"SELECT {out('d: delivery_unit; ' + spec)} FROM metric", **extra, metric=sql or make(unit))


for _name, (_fn, _make, _spec) in METRICS.items():
    for _unit in ("week", "month", "quarter"):
        reg.add(
            _name if _unit == "week" else f"{_name}_{_unit}",
            partial(lambda t, fn, u: fn(t, review(u)), fn=_fn, u=_unit),
            metric_query(_name, _unit),
        )
reg.add(
    "restaurant_margin_corrected",
    lambda t: sc.restaurant_margin(t, review("month", corrected=True)),
    metric_query("restaurant_margin", "month", restaurant_sql("month", "('OD', 'Partner', 'Partner_vip')")),
)
reg.add(
    "split_week_plan_corrected",
    lambda t: sc.split_week_plan(t, review("week", corrected=True)),
    metric_query("split_week_plan", "week", split_plan_sql("week", shift=-1)),
)

# --- assembly -------------------------------------------------------------------------

COMMERCE_SPEC = (
    "f: gross_rev prod_gm gm_margin gm_base "
    + " ".join(f"eth_{d}_rev eth_return_{d}_rev" for d in DIVISIONS)
    + f" {names('refund_amount')} {names('gross_rev')} {PROMO_NAMES}"
    + "; l: active_users new_users delivery_cnt total_orders oos_orders "
    + " ".join(names(p) for p in ("new_users", "users", "total_orders", "oos_orders", "return_orders"))
)
CARD_SPEC = SEG + COMMERCE_SPEC + "; " + "; ".join(spec for _, _, spec in METRICS.values())


def card_ctes(unit: str) -> dict[str, str]:
    items = [
        *commerce_sums, *division_rev, *division_ret, *return_sums, *promo_items(),
        nd("buyer_id", "active_users"), *new_users, *users, nd("group_invoice_id", "delivery_cnt"),
        *order_items, *return_orders,
    ]
    ctes = commerce_ctes(unit) | acquisition_ctes | {"seg": by_segment(items)}
    until = str(as_of(unit) - timedelta(days=1))
    ctes["booked"] = buyers_sql("order_day", "order_week", "daily_new_users_flag_order", until)
    ctes["earned"] = buyers_sql("delivery_day", "delivery_week", "daily_new_users_flag", until)
    joins, picked = [], ["seg.*"]
    for i, (name, (_, make, _)) in enumerate(METRICS.items()):
        ctes[f"x{i}"] = make(unit)
        joins.append(
            f"LEFT JOIN x{i} ON x{i}.delivery_unit = seg.delivery_unit AND seg.ethnicity_user = 'ASIA'"
        )
        picked.append(f"x{i}.* EXCLUDE (delivery_unit)")
    ctes["card"] = f"SELECT {', '.join(picked)} FROM seg {' '.join(joins)}"
    return ctes


reg.add(
    "scorecard",
    lambda t: sc.scorecard(t, review("week")),
    query(f"SELECT {out(CARD_SPEC)} FROM card", **card_ctes("week")),
    window=review("week").window,
)
YEAR_AGO = {"month": ("1999-03-01", "1999-01-01"), "quarter": ("1999-01-01", "1996-07-01")}
for _unit in ("week", "month", "quarter", "week@sunday", "month@sunday", "week@tuesday"):
    _report = "SELECT delivery_unit AS delivery_week, * FROM card"
    if base(_unit) != "week":
        _from, _shown = YEAR_AGO[base(_unit)]
        _report += f" UNION ALL SELECT DATE '{_shown}', * FROM card WHERE delivery_unit = DATE '{_from}'"
    reg.add(
        "scorecard_report" + {"week": ""}.get(_unit, "_" + _unit.removeprefix("week@").replace("@", "_")),
        partial(lambda t, u: sc.scorecard_report(t, review(u)), u=_unit),
        query(
            f"SELECT {out('d: delivery_week; ' + CARD_SPEC)} FROM report", **card_ctes(_unit), report=_report
        ),
        window=review(_unit).window,
    )
