"""The stand-in tables in DuckDB SQL, and small helpers to put oracle queries together."""

from __future__ import annotations

import re

from checks import standins as st


def listed(values: list, index: str) -> str:
    """Element ``index`` (from 0) of a fixed list."""
    body = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{body}])[({index}) + 1]"


def titled(column: str, titles: dict[int, str]) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in titles.items())
    return f"CASE {column} {arms} END"


def sunday(d: str) -> str:
    return f"({d} - CAST(dayofweek({d}) AS INTEGER))"


def start_of(d: str, unit: str) -> str:
    return sunday(f"CAST({d} AS DATE)") if unit == "week" else f"CAST(date_trunc('{unit}', {d}) AS DATE)"


D4 = "DECIMAL(18,4)"
REGION = listed(st.REGION_IDS, "c_nationkey % 9")
COUPON = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'sign_up_coupon' WHEN '2-HIGH' THEN "
    "'second_order_coupon' WHEN '3-MEDIUM' THEN 'order_share_sign_up_coupon' ELSE '' END"
)
SURVEY_TITLES = [st.REGION_TITLES[i] for i in st.REGION_IDS]
SURVEY_TITLES[2] = "MAIL ORDER - WEST"


def _rates(keys: str, group: str) -> str:
    def bp(value: str, sign: str = "") -> str:
        return (
            f"{sign}CAST(CAST(sum(CAST(({value}) * 10000 AS BIGINT)) * 10000 "
            f"// sum(CAST(sub_total * 10000 AS BIGINT)) AS DECIMAL(10,0)) * 0.0001 AS DECIMAL(10,4))"
        )

    return f"""
      SELECT {keys}, CAST(sum(sub_total) AS DECIMAL(28,2)) AS gross,
        {bp('product_refund_amount', '-')} AS inbound,
        {bp('CASE WHEN is_gm = 0 THEN sub_total ELSE 0 END')} AS wh_labor,
        {bp('discount * 100', '-')} AS packaging,
        {bp('CAST(quantity AS DECIMAL(10,0)) * 10')} AS processing,
        {bp('CAST(quantity AS DECIMAL(10,0)) * 20')} AS wh,
        {bp('product_price * 0.5')} AS ops,
        {bp('discount * 50')} AS misc
      FROM v_op WHERE delivery_month < DATE '{st.REPORTED_BEFORE}' GROUP BY {group}"""


_PCTS = ", ".join(
    f"CAST({n} AS VARCHAR) AS {n}_pct"
    for n in ("inbound", "wh_labor", "packaging", "processing", "wh", "ops", "misc")
)
_BLANKS = ", ".join(
    f"'' AS {n}_pct" for n in ("inbound", "wh_labor", "packaging", "processing", "wh", "ops", "misc")
)


def _labor_pct(inventory: str, region: int) -> str:
    return f"""
      SELECT CAST(delivery_week AS VARCHAR) AS delivery_week, CAST({region} AS BIGINT) AS sales_region_id,
        CASE WHEN day(delivery_week) > 7 THEN CAST(CAST(CAST(
          sum(CASE WHEN is_gm = 0 THEN CAST(sub_total * 100 AS BIGINT) ELSE 0 END) * 10000
          // sum(CAST(sub_total * 100 AS BIGINT)) AS DECIMAL(10,0)) * 0.0001 AS DECIMAL(10,4)) AS VARCHAR)
        END AS inbound_pct
      FROM v_op WHERE inventory_title = '{inventory}' GROUP BY v_op.delivery_week"""


def _plan(title: str) -> str:
    return f"CAST(sum(CASE WHEN division = '{title}' THEN gm_margin ELSE 0 END) AS {D4})"


VIEWS: dict[str, str] = {
    "v_op": f"""
      SELECT d AS delivery_day, {sunday('d')} AS delivery_week,
        CAST(date_trunc('month', d) AS DATE) AS delivery_month,
        CAST(o_orderdate AS DATE) AS order_day, o_orderdate AS order_create_time,
        o_orderkey AS order_id, o_custkey AS buyer_id, l_partkey AS product_id,
        o_orderkey * 10 + l_suppkey % 3 AS group_invoice_id,
        CAST({REGION} AS BIGINT) AS sales_region_id, CAST({REGION} AS BIGINT) AS sales_org_id,
        {titled(REGION, st.REGION_TITLES)} AS sales_region_title,
        CASE WHEN p_type = 'SMALL' THEN 'pantry' ELSE 'normal' END AS biz_type,
        CASE c_mktsegment WHEN 'MACHINERY' THEN 'restaurant' WHEN 'BUILDING' THEN 'alcohol'
          ELSE 'grocery' END AS order_biz_type,
        CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE 'F' END AS payment_mode,
        {listed(st.INVENTORY_LIST, 'l_suppkey % 7')} AS inventory_title,
        {listed(st.STORAGE_LIST, 'p_size % 3')} AS storage_type,
        {listed(st.DIVISION_LIST, 'brand_no % 6')} AS division,
        r_name AS ethnicity_user, {COUPON} AS coupon,
        {listed(['sale', 'lightening', 'normal'], 'l_linenumber % 3')} AS price_type,
        CASE WHEN l_linenumber % 2 <> 0 THEN 'Vendor funded' END AS discount_reason,
        CASE WHEN p_type = 'SMALL' THEN 'pantry' ELSE 'fresh' END AS mail_type,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS daily_new_users_flag,
        gm AS is_gm, CAST(ext AS {D4}) AS sub_total,
        CAST(CASE WHEN l_returnflag = 'R' THEN ext * CAST(l_tax AS DECIMAL(4,2)) ELSE 0 END AS {D4})
          AS product_refund_amount,
        CAST(o_orderkey % 7 AS {D4}) AS discount,
        CAST(ext * 0.7 AS {D4}) AS gm_cost,
        CAST(ext * gm - ext * 0.7 * gm AS {D4}) AS gm_margin,
        CAST(ext * gm AS {D4}) AS gm_base,
        CAST(p_retailprice AS DECIMAL(18,2)) AS product_base_price,
        CAST(CAST(CAST(ext * 100 AS BIGINT) // CAST(l_quantity AS BIGINT) AS DECIMAL(18,0)) * 0.01 AS {D4})
          AS product_price,
        CAST(l_quantity AS INTEGER) AS quantity,
        l_linenumber AS line_number, l_returnflag AS return_flag, brand_no AS brand
      FROM (SELECT *, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS ext,
              CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 0 ELSE 1 END AS gm
            FROM lineitem) li
      JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey
      JOIN (SELECT *, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no FROM part) pt
        ON l_partkey = p_partkey""",
    "v_ev": """
      SELECT event_id, user_id, event_type, value,
        ts - to_days(CAST(8700 + 30 * (user_id % 13) AS INTEGER)) AS ts FROM events""",
    "v_ord": f"""
      SELECT od AS order_day, {sunday('od')} AS order_week,
        CAST(date_trunc('month', od) AS DATE) AS order_month,
        dd AS delivery_day, {sunday('dd')} AS delivery_week,
        o_orderkey AS order_id, o_custkey AS buyer_id, CAST({REGION} AS BIGINT) AS sales_org_id,
        {listed(['APP iOS', 'APP Android', 'PC'], 'c_custkey % 3')} AS device_type,
        {listed(['zh', 'zh-Hant', 'en', 'es'], 'c_custkey % 4')} AS language,
        CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE 'F' END AS payment_mode, {COUPON} AS coupon,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS daily_new_users_flag_order,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS daily_new_users_flag,
        CAST(o_orderkey % 7 AS {D4}) AS discount, CAST(o_totalprice AS DECIMAL(18,2)) AS total
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS od,
              CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS dd FROM orders) o
      JOIN customer ON o_custkey = c_custkey""",
    "v_rates_region": _rates(
        f"delivery_month, sales_region_id AS region_id, {titled('sales_region_id', st.SHEET_TITLES)} AS title",
        "ALL",
    ),
    "v_rates_total": _rates(
        "delivery_month, CAST(999 AS BIGINT) AS region_id, 'Total' AS title", "delivery_month"
    ),
    "v_rates": "SELECT * FROM v_rates_region UNION ALL SELECT * FROM v_rates_total",
    "v_actual_pl": f"""
      SELECT CAST(delivery_month AS VARCHAR) AS delivery_month, title AS sales_region_title,
        CASE WHEN title IN ('Florida', 'Pantry') THEN '' ELSE CAST(gross AS VARCHAR) END AS gross_rev,
        {_PCTS} FROM v_rates""",
    "v_regional_pl": f"""
      SELECT region_id, title AS sales_region_title,
        strftime(delivery_month, '%b') || '''' || strftime(delivery_month, '%y') AS delivery_month, {_PCTS}
      FROM v_rates
      UNION ALL
      SELECT region_id, title, 'YTD', {_BLANKS} FROM v_rates""",
    "v_nj_labor": _labor_pct("NJ - New York", 7),
    "v_chi_labor": _labor_pct("IL - Chicago", 15),
    "v_dispatch": """
      SELECT delivery_day AS delivery_date, delivery_week, sales_region_id,
        sales_region_id || ' - ' || sales_region_title AS sales_region,
        CAST(sub_total * 0.05 AS DECIMAL(18,4)) AS total_delivery_cost,
        CAST(sub_total * 0.01 AS DECIMAL(18,4)) AS linehaul_cost,
        CASE WHEN order_biz_type = 'restaurant' THEN 'restaurant' ELSE 'grocery' END AS delivery_plan_type,
        CASE WHEN return_flag = 'R' THEN 'N' ELSE 'Y' END AS tms_on_time_flag,
        group_invoice_id AS invoice_id
      FROM v_op WHERE biz_type = 'normal' AND sales_region_id NOT IN (3, 24)""",
    "v_shipment": """
      SELECT CAST(delivery_day AS VARCHAR) AS deal_delivery_date, order_id AS wms_order_id,
        CAST(sub_total * 0.02 AS DECIMAL(18,4)) AS rate FROM v_op WHERE biz_type = 'pantry'""",
    "v_labor": """
      SELECT delivery_day AS entry_date, delivery_week AS entry_week,
        CASE WHEN line_number = 6 THEN 'LA - Greater' WHEN line_number = 7 THEN 'check'
          WHEN inventory_title = 'NJ - New York' THEN 'NJ - Edison' ELSE inventory_title END AS warehouse,
        CASE division WHEN 'Dry Grocery' THEN 'OP - Dry' WHEN 'Frozen' THEN 'Mail Order - Outbound'
          WHEN 'Produce' THEN 'OP - DC' ELSE 'OP - Pick' END AS department_name,
        CASE WHEN brand = 25 THEN 'Y' ELSE 'N' END AS filter_flag,
        CAST(sub_total * 0.1 AS DECIMAL(18,4)) AS labor_cost FROM v_op""",
    "v_price": "SELECT p_partkey + 500 AS id, p_partkey AS product_id, 1 + p_partkey % 4 AS sales_org_id FROM part",
    "v_special": f"""
      SELECT p_partkey + 500 AS product_price_id, s AS start_time, s + 60 * 86400 AS end_time,
        {listed(st.REASONS, 'p_partkey % 7')} AS reason
      FROM (SELECT p_partkey, {st.SPECIALS_START} + (p_partkey % 90) * 86400 AS s FROM part) a
      UNION ALL
      SELECT p_partkey + 500, s + 10 * 86400, s + 40 * 86400, {listed(st.REASONS, '(p_partkey + 1) % 7')}
      FROM (SELECT p_partkey, {st.SPECIALS_START} + (p_partkey % 90) * 86400 AS s FROM part) b
      WHERE p_partkey % 5 = 0""",
    "v_price_region": f"""
      SELECT org AS sales_org_id, 1 + org % 4 AS price_region_id
      FROM (SELECT DISTINCT CAST({REGION} AS BIGINT) AS org FROM customer) c""",
    "v_revenue": """
      SELECT delivery_week, delivery_month, delivery_day, discount,
        CAST(quantity % 5 AS DECIMAL(18,4)) AS expense_pct, sub_total AS revenue,
        sub_total - product_refund_amount AS net_revenue,
        CASE WHEN coupon IN ('sign_up_coupon', 'second_order_coupon') THEN discount ELSE 0 END AS new_user_coupon,
        CASE WHEN is_gm = 0 THEN sub_total ELSE 0 END AS oos,
        product_refund_amount * is_gm AS shipped_and_refunded, discount * 2 AS total_discount
      FROM v_op""",
    "v_sessions": """
      SELECT CAST(ts AS DATE) AS sess_date, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS orders,
        user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id FROM v_ev""",
    "v_survey": f"""
      SELECT CAST(ts AS DATE) AS response_date, event_id AS response_id,
        CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS question_id,
        CASE WHEN value > 60 THEN 1 ELSE 0 END AS promoter_flag,
        CASE WHEN value < 10 THEN 1 ELSE 0 END AS detractor_flag,
        {listed(SURVEY_TITLES, 'user_id % 9')} AS response_region FROM v_ev""",
    "v_perfect": """
      SELECT delivery_day, sales_region_id || ' - ' || sales_region_title AS region,
        CASE WHEN order_biz_type = 'restaurant' THEN 'restaurant' ELSE 'grocery' END AS delivery_type,
        CASE WHEN is_gm = 0 OR return_flag = 'R' THEN 1 ELSE 0 END AS not_perfect_orders,
        1 AS total_orders FROM v_op""",
    "v_ltv": """
      SELECT CASE device_type WHEN 'APP iOS' THEN 'iOS' WHEN 'APP Android' THEN 'Android' ELSE 'Web' END AS device,
        CASE WHEN language LIKE 'zh%' THEN 'Chinese' WHEN language = 'en' THEN 'English' ELSE 'OTHER' END AS language,
        CASE WHEN sales_org_id IN (3, 16) THEN 'Mail' ELSE 'Local' END AS region,
        CAST(1 + order_id % 8 AS INTEGER) AS wd, total AS revenue, 1 AS cohort_buyers, order_week AS start_week
      FROM v_ord""",
    "v_spend": """
      SELECT CAST(ts AS DATE) AS date, CASE WHEN event_type = 'error' THEN 'Branding-X' ELSE event_type END AS channel,
        CAST(value AS DECIMAL(18,2)) AS cost FROM v_ev""",
    "v_coupon_use": """
      SELECT o_orderkey AS order_id, 'C' || (o_custkey % 50) AS code FROM orders
      UNION ALL SELECT o_orderkey, 'C' || (o_custkey % 50) FROM orders WHERE o_orderkey % 10 = 0""",
    "v_coupon_code": "SELECT DISTINCT 'C' || (c_custkey % 50) AS code FROM customer",
    "v_discount": """
      SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'O' THEN 'points' ELSE 'coupon' END AS type,
        CAST(o_orderkey % 7 AS DECIMAL(18,4)) AS amount FROM orders""",
    "v_points": """
      SELECT ts AS rec_create_time, CAST(floor(value) AS BIGINT) * 5 AS points,
        CASE WHEN event_type = 'signup' THEN 'p_user_referral' ELSE 'p_other' END AS type FROM v_ev""",
    "v_overheads": """
      SELECT order_month AS month, CAST(sum(total) * 0.0013 AS DECIMAL(18,4)) AS content_marketing_spend,
        CAST(sum(total) * 0.0020 AS DECIMAL(18,4)) AS salary_cost, CAST(sum(total) * 0.0005 AS DECIMAL(18,4)) AS agency_fee,
        CAST(sum(total) * 0.0004 AS DECIMAL(18,4)) AS contractor_fee, CAST(sum(total) * 0.0003 AS DECIMAL(18,4)) AS tools_cost,
        CAST(sum(total) * 0.0002 AS DECIMAL(18,4)) AS es_ethnic_cost, CAST(sum(total) * 0.0001 AS DECIMAL(18,4)) AS ja_ethnic_cost,
        CAST(NULL AS DECIMAL(18,4)) AS ko_ethnic_cost, CAST(sum(total) * 0.0001 AS DECIMAL(18,4)) AS vi_ethnic_cost
      FROM v_ord GROUP BY order_month""",
    "v_restaurant": f"""
      SELECT delivery_day, order_day,
        {listed(['RTG', 'OD', 'Partner', 'Partner_vip', 'RTG', 'OD', 'Other'], 'line_number - 1')} AS order_type,
        sub_total AS order_total, gm_margin AS cm_margin, gm_base AS cm_base FROM v_op""",
    "v_plan": "\n      UNION ALL\n".join(
        f"""
      SELECT CAST({start_of('delivery_day', u)} AS VARCHAR) AS delivery_unit, '{u}' AS unit_type,
        CAST(sum(sub_total) * 1.1 AS {D4}) AS gross_rev_plan, CAST(sum(sub_total) AS {D4}) AS net_rev_plan,
        CAST(sum(gm_margin) AS {D4}) AS gm_plan, CAST(sum(daily_new_users_flag) AS BIGINT) AS new_users,
        count(*) AS active_users, CAST(sum(quantity) AS {D4}) AS arpu_plan FROM v_op GROUP BY 1"""
        for u in ("week", "month", "quarter")
    ),
    "v_calendar": f"""
      SELECT c AS cal_date, {sunday('c')} AS week_begin_date,
        CAST(date_trunc('month', c) AS DATE) AS month_begin_date,
        CAST(date_trunc('quarter', c) AS DATE) AS quarter_begin_date
      FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS c
            FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem) b) s""",
    "v_division_plan": f"""
      SELECT CAST(delivery_month AS VARCHAR) AS delivery_month, {_plan('Dairy/Deli')} AS dairy_deli,
        {_plan('Protein')} AS protein, {_plan('Frozen')} AS frozen, {_plan('Produce')} AS produce,
        {_plan('Dry Grocery')} AS dry_grocery, {_plan('GM & HBC')} AS gm_hbc
      FROM v_op GROUP BY v_op.delivery_month""",
    "v_cases": """
      SELECT delivery_day, order_day, inventory_title, group_invoice_id,
        CASE WHEN return_flag = 'R' AND line_number % 2 = 1 THEN order_id END AS order_case_id_np,
        CASE WHEN return_flag = 'R' AND line_number = 4 THEN order_id END AS order_case_id_p FROM v_op""",
    "v_sku": f"""
      SELECT DATE '2000-04-08' - CAST(p_partkey % 420 AS INTEGER) AS date,
        {listed(st.STORAGE_LIST, 'p_size % 3')} AS storage_type,
        {listed(st.SITE_LIST, 'p_partkey % 3')} || CASE WHEN p_type = 'LARGE' THEN '_wh_annex' ELSE '_wh' END AS title,
        CASE WHEN p_type = 'PROMO' THEN 'Y' ELSE '-' END AS is_food, '-' AS is_protein, '-' AS is_produce,
        CASE WHEN p_brand = 'Brand#9' THEN 'x' ELSE '-' END AS ethnicity, p_size AS max_sku_count FROM part""",
    "v_stock": """
      SELECT order_day, storage_type, sales_region_title, lpad(CAST(brand AS VARCHAR), 2, '0') || '-x' AS department,
        CASE WHEN line_number = 7 THEN 'I' ELSE 'A' END AS sku_region_status, is_gm AS sku_availability, product_id
      FROM v_op""",
}

_NAME = re.compile(r"\bv_\w+")


def _needed(sql: str) -> list[str]:
    """Views the text refers to, each after those it is built from."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def query(body: str, **ctes: str) -> str:
    """``body`` with the views it needs and further CTEs, in the order given."""
    text = " ".join([*ctes.values(), body])
    parts = [f"{n} AS ({VIEWS[n]})" for n in _needed(text)]
    parts += [f"{n} AS ({sql})" for n, sql in ctes.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


TYPES = {"d": "DATE", "l": "BIGINT", "f": "DOUBLE", "s": "VARCHAR", "t": "TIMESTAMP"}


def out(spec: str) -> str:
    """Select list from ``"l: a b; f: c"``: the columns cast to comparable types."""
    items = []
    for group in spec.split(";"):
        kind, names = group.split(":")
        items += [f"CAST({n} AS {TYPES[kind.strip()]}) AS {n}" for n in names.split()]
    return ", ".join(items)
