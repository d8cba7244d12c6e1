"""Monthly P&L queries and their oracles."""

from __future__ import annotations

from checks import standins as st
from checks.registry import Registry
from checks.views import out, query
from periodbook.plans import labor, monthly, rates

reg = Registry()
AS_OF = st.AS_OF
MONTH = "DATE '2000-03-01'"
M6 = "DECIMAL(24,6)"

# lines with the folded region
FOLD = """
  SELECT * REPLACE (CASE WHEN mail THEN 3 ELSE sales_region_id END AS sales_region_id,
                    CASE WHEN mail THEN 'MAIL ORDER' ELSE sales_region_title END AS sales_region_title)
  FROM (SELECT *, sales_region_id = 24 OR contains(lower(biz_type), 'pantry') AS mail FROM v_op) tagged
  WHERE order_biz_type IN ('grocery', 'alcohol')"""


def order_grain(period: str, where: str) -> str:
    return f"""
      SELECT {period}, sales_region_id, sales_region_title, order_id, buyer_id, group_invoice_id,
        max(daily_new_users_flag) AS daily_new_users_flag, sum(sub_total) AS sub_total,
        coalesce(sum(sub_total) FILTER (WHERE is_gm = 0), 0) AS oos,
        coalesce(sum(product_refund_amount) FILTER (WHERE is_gm = 1), 0) AS refund,
        max(discount) AS coupon,
        coalesce(max(discount) FILTER (WHERE coupon IN ('sign_up_coupon', 'second_order_coupon')), 0) AS new_user_coupon,
        sum(gm_cost * is_gm) AS cogs, sum(gm_margin) AS gm_margin, sum(gm_base) AS gm_base
      FROM fold WHERE {where} GROUP BY ALL"""


def waterfall_sums(period: str, title: str) -> str:
    """Region rows and the company row from one set of rows."""
    return f"""
      SELECT {period}, coalesce(sales_region_id, 999) AS sales_region_id,
        coalesce(sales_region_title, '{title}') AS sales_region_title,
        sum(daily_new_users_flag) AS new_user, count(DISTINCT buyer_id) AS active_user,
        sum(sub_total) AS gross_rev, sum(coupon) AS total_coupon_rev,
        sum(new_user_coupon) AS new_user_coupon, sum(refund) AS refund_sum, sum(oos) AS oos_rev,
        sum(cogs) AS cogs_rev
      FROM grain GROUP BY GROUPING SETS (({period}, sales_region_id, sales_region_title), ({period}))"""


GRAIN_OUT = (
    "d: {p}; l: sales_region_id; s: sales_region_title; l: order_id buyer_id group_invoice_id "
    "daily_new_users_flag; f: sub_total oos refund coupon new_user_coupon cogs gm_margin gm_base"
)

grain = {"fold": FOLD, "grain": order_grain("delivery_month", f"delivery_month = {MONTH}")}
sales = grain | {
    "sums": waterfall_sums("delivery_month", "Company"),
    "sales": """
      SELECT *, 0.023 AS rebate_rate, total_coupon_rev - new_user_coupon AS coupon_rev,
        refund_sum AS refund_rev,
        gross_rev * (1 - 0.023) - oos_rev - refund_sum - (total_coupon_rev - new_user_coupon) AS net_rev
      FROM sums""",
}
SALES_OUT = (
    "d: delivery_month; l: sales_region_id; s: sales_region_title; f: rebate_rate; "
    "l: new_user active_user; f: gross_rev total_coupon_rev new_user_coupon coupon_rev refund_rev "
    "oos_rev cogs_rev net_rev"
)

reported = {
    "typed": """
      SELECT TRY_CAST(delivery_month AS DATE) AS report_month,
        CASE lower(sales_region_title) WHEN 'bay area' THEN 1 WHEN 'la' THEN 2 WHEN 'mail order' THEN 3
          WHEN 'northwest' THEN 4 WHEN 'seattle' THEN 4 WHEN 'east coast' THEN 7 WHEN 'new jersey' THEN 7
          WHEN 'texas' THEN 10 WHEN 'chicago' THEN 15 WHEN 'midwest' THEN 15 WHEN 'florida' THEN 23
          WHEN 'consolidated' THEN 999 WHEN 'total' THEN 999 END AS region_id,
        abs(TRY_CAST(inbound_pct AS DOUBLE)) AS inbound_pct, abs(TRY_CAST(wh_labor_pct AS DOUBLE)) AS wh_labor,
        abs(TRY_CAST(packaging_pct AS DOUBLE)) AS packaging_pct,
        abs(TRY_CAST(processing_pct AS DOUBLE)) AS processing_fee_pct, 0.001 AS css,
        abs(TRY_CAST(wh_pct AS DOUBLE)) AS wh_pct, abs(TRY_CAST(ops_pct AS DOUBLE)) AS ops_pct,
        abs(TRY_CAST(misc_pct AS DOUBLE)) AS misc_pct
      FROM v_actual_pl WHERE gross_rev <> ''""",
    "reported": """
      SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY report_month DESC) AS rn FROM typed
        WHERE region_id IS NOT NULL AND report_month BETWEEN DATE '2000-02-01' AND DATE '2000-03-01') r
      WHERE rn = 1""",
}
costs = (
    sales
    | reported
    | {
        "costs": """
      SELECT s.*, r.inbound_pct * CAST(net_rev AS DOUBLE) AS inbound_rev,
        r.processing_fee_pct * CAST(net_rev AS DOUBLE) AS processing_rev,
        r.packaging_pct * CAST(net_rev AS DOUBLE) AS packaging_rev,
        CAST(0.001 AS DOUBLE) * CAST(net_rev AS DOUBLE) AS cs_rev, r.wh_pct * CAST(net_rev AS DOUBLE) AS warehouse_rev,
        r.misc_pct * CAST(net_rev AS DOUBLE) AS misc_rev, r.ops_pct * CAST(net_rev AS DOUBLE) AS ops_rev
      FROM sales s LEFT JOIN reported r ON r.region_id = s.sales_region_id"""
    }
)
COSTS_OUT = SALES_OUT + (
    " inbound_rev processing_rev packaging_rev cs_rev warehouse_rev misc_rev ops_rev"
)


def delivery(period: str, key: str, mail_key: str, where: str) -> dict[str, str]:
    return {
        "parts": f"""
          SELECT {key} AS {period}, sales_region_id, sum(total_delivery_cost + linehaul_cost) AS delivery_cost
          FROM v_dispatch WHERE delivery_plan_type = 'grocery' AND {where.format(k=key)} GROUP BY 1, 2
          UNION ALL
          SELECT {period}, 3, sum(rate) FROM (
            SELECT {mail_key} AS {period}, wms_order_id, max(rate) AS rate FROM v_shipment
            WHERE {where.format(k=mail_key)} GROUP BY 1, 2) once GROUP BY 1""",
        "delivery": f"""
          SELECT * FROM parts UNION ALL SELECT {period}, 999, sum(delivery_cost) FROM parts GROUP BY 1""",
    }


deliveries = delivery(
    "delivery_month",
    "CAST(date_trunc('month', delivery_date) AS DATE)",
    "CAST(date_trunc('month', CAST(deal_delivery_date AS DATE)) AS DATE)",
    "{k} = " + MONTH,
)

pct = {
    "pct": """
      SELECT *, lag(inbound_pct) OVER (PARTITION BY sales_region_id ORDER BY delivery_week) AS lag_inbound_pct
      FROM (SELECT CAST(delivery_week AS DATE) AS delivery_week, sales_region_id,
              TRY_CAST(inbound_pct AS DOUBLE) AS inbound_pct
            FROM (SELECT * FROM v_nj_labor UNION ALL SELECT * FROM v_chi_labor) u
            WHERE CAST(delivery_week AS DATE) < DATE '2000-04-10') w"""
}
WAREHOUSE = """CASE warehouse WHEN 'SF - Union City' THEN 1 WHEN 'LA - La Mirada' THEN 2 WHEN 'WA - Seattle' THEN 4
        WHEN 'NJ - Edison' THEN 7 WHEN 'TX - Houston' THEN 10 WHEN 'IL - Chicago' THEN 15 WHEN 'FL - Tampa' THEN 23 END"""
work = {
    "work": f"""
      SELECT entry_date, entry_week, sales_region_id, sum(labor_cost) AS total_cost,
        coalesce(sum(labor_cost) FILTER (WHERE sales_region_id = 2 AND department_name ILIKE '%dry%'), 0) AS dry_cost,
        coalesce(sum(labor_cost) FILTER (WHERE sales_region_id = 2 AND department_name NOT ILIKE '%dry%'), 0) AS nondry_cost,
        coalesce(sum(labor_cost) FILTER (WHERE sales_region_id IN (7, 15)
          AND department_name ILIKE '%mail order - outbound%'), 0) AS mo_outbound
      FROM (SELECT *, {WAREHOUSE} AS sales_region_id FROM v_labor
            WHERE warehouse NOT IN ('check', 'LA - Greater') AND filter_flag = 'N') w
      WHERE date_trunc('month', entry_date) = {MONTH} GROUP BY ALL"""
}
LINES = "order_biz_type IN ('grocery', 'alcohol') AND delivery_month = " + MONTH
dry = {
    "dry": f"""
      SELECT delivery_day, sales_region_id, CAST(r AS DOUBLE) / CAST(sum(r) OVER (PARTITION BY delivery_day) AS DOUBLE) AS dry_rev_pct
      FROM (SELECT delivery_day, CASE WHEN sales_region_id IN (1, 2) THEN sales_region_id ELSE 3 END AS sales_region_id,
              sum(sub_total) AS r FROM v_op
            WHERE {LINES} AND inventory_title = 'LA - La Mirada' AND division = 'Dry Grocery' GROUP BY 1, 2) g"""
}
nondry = {
    "nondry": f"""
      SELECT delivery_day, sales_region_id, CAST(r AS DOUBLE) / CAST(sum(r) OVER (PARTITION BY delivery_day) AS DOUBLE) AS nondry_rev_pct
      FROM (SELECT delivery_day, sales_region_id, sum(sub_total) AS r FROM v_op
            WHERE {LINES} AND inventory_title = 'LA - La Mirada' AND division <> 'Dry Grocery'
              AND sales_region_id IN (1, 2) GROUP BY 1, 2) g"""
}
share = (
    dry
    | nondry
    | {
        "share": """
      SELECT d.delivery_day, d.sales_region_id, d.dry_rev_pct,
        CASE WHEN d.delivery_day >= DATE '2000-03-25' OR d.sales_region_id NOT IN (1, 2)
             THEN coalesce(n.nondry_rev_pct, 0)
             WHEN d.sales_region_id = 2 THEN 1 ELSE 0 END AS nondry_rev_pct
      FROM dry d LEFT JOIN nondry n USING (delivery_day, sales_region_id)"""
    }
)
MAIL_LINE = (
    "(contains(biz_type, 'pantry') OR sales_region_id = 3 OR contains(lower(sales_region_title), 'mof'))"
)
mail = {
    "mail": f"""
      SELECT delivery_day, CASE inventory_title WHEN 'IL - Chicago' THEN 15 ELSE 7 END AS sales_region_id,
        CAST(coalesce(sum(sub_total) FILTER (WHERE {MAIL_LINE}), 0) AS DOUBLE) / CAST(sum(sub_total) AS DOUBLE) AS mo_pct
      FROM v_op WHERE {LINES} AND inventory_title IN ('IL - Chicago', 'NJ - New York') GROUP BY 1, 2"""
}
base = (
    pct
    | work
    | share
    | mail
    | {
        "lbase": f"""
      SELECT w.entry_date, w.entry_week, w.sales_region_id, CAST(w.total_cost AS {M6}) AS total_cost,
        CAST(w.dry_cost AS {M6}) AS dry_cost, CAST(w.nondry_cost AS {M6}) AS nondry_cost,
        CASE WHEN w.sales_region_id = 2 THEN CAST(CAST(w.dry_cost AS DOUBLE) * s3.dry_rev_pct AS {M6}) ELSE CAST(w.mo_outbound AS {M6}) END AS mo_outbound,
        CASE WHEN w.sales_region_id IN (7, 15)
             THEN CAST(CAST(w.total_cost AS DOUBLE) * coalesce(p.inbound_pct, p.lag_inbound_pct) * m.mo_pct AS {M6}) ELSE 0 END AS mo_labor,
        CASE WHEN w.sales_region_id = 2 THEN CAST(CAST(w.dry_cost AS DOUBLE) * s1.dry_rev_pct AS {M6}) ELSE 0 END AS allo_dry_cost,
        CASE WHEN w.sales_region_id = 2 THEN CAST(CAST(w.nondry_cost AS DOUBLE) * s1.nondry_rev_pct AS {M6}) ELSE 0 END AS allo_nondry_cost
      FROM work w
      LEFT JOIN share s3 ON s3.delivery_day = w.entry_date AND s3.sales_region_id = 3
      LEFT JOIN share s1 ON s1.delivery_day = w.entry_date AND s1.sales_region_id = 1
      LEFT JOIN mail m ON m.delivery_day = w.entry_date AND m.sales_region_id = w.sales_region_id
      LEFT JOIN pct p ON p.delivery_week = w.entry_week AND p.sales_region_id = w.sales_region_id"""
    }
)
BASE_OUT = (
    "d: entry_date entry_week; l: sales_region_id; f: total_cost dry_cost nondry_cost mo_outbound "
    "mo_labor allo_dry_cost allo_nondry_cost"
)
final = base | {
    "final": """
      SELECT b.entry_date, b.sales_region_id, b.total_cost, coalesce(g.cost, 0) AS la_greater_labor_cost,
        CASE b.sales_region_id WHEN 1 THEN la.allo_dry_cost ELSE b.allo_dry_cost END AS allo_dry_cost,
        CASE b.sales_region_id WHEN 1 THEN la.allo_nondry_cost ELSE b.allo_nondry_cost END AS allo_nondry_cost,
        b.mo_outbound, b.mo_labor,
        CASE b.sales_region_id
          WHEN 2 THEN b.dry_cost + b.nondry_cost - b.mo_outbound - b.allo_dry_cost - b.allo_nondry_cost + coalesce(g.cost, 0)
          WHEN 1 THEN b.total_cost + la.allo_dry_cost + la.allo_nondry_cost
          WHEN 7 THEN b.total_cost - b.mo_outbound - b.mo_labor
          WHEN 15 THEN b.total_cost - b.mo_outbound - b.mo_labor
          ELSE CASE WHEN b.sales_region_id IS NOT NULL THEN b.total_cost END END AS final_labor_cost
      FROM lbase b
      LEFT JOIN lbase la ON la.entry_date = b.entry_date AND la.sales_region_id = 2
      LEFT JOIN (SELECT entry_date, CAST(sum(labor_cost) AS DECIMAL(24,6)) AS cost FROM v_labor
                 WHERE filter_flag = 'N' AND warehouse = 'LA - Greater' GROUP BY 1) g
        ON b.sales_region_id = 2 AND g.entry_date = b.entry_date"""
}
FINAL_OUT = (
    "d: entry_date; l: sales_region_id; f: total_cost la_greater_labor_cost allo_dry_cost "
    "allo_nondry_cost mo_outbound mo_labor final_labor_cost"
)
labor_mo = final | {
    "labor_mo": """
      SELECT entry_date, 3 AS sales_region_id, sum(mo_outbound) + sum(mo_labor) AS total_cost,
        0 AS la_greater_labor_cost, 0 AS allo_dry_cost, 0 AS allo_nondry_cost,
        sum(mo_outbound) AS mo_outbound, sum(mo_labor) AS mo_labor,
        sum(mo_outbound) + sum(mo_labor) AS final_labor_cost
      FROM final GROUP BY 1"""
}
_SUMS = ", ".join(f"sum({m}) AS {m}" for m in labor.MONTHLY_MEASURES)
rollup = labor_mo | {
    "roll_region": f"""
      SELECT CAST(date_trunc('month', entry_date) AS DATE) AS delivery_month, sales_region_id, {_SUMS}
      FROM (SELECT * FROM final UNION ALL BY NAME SELECT * FROM labor_mo) u GROUP BY 1, 2""",
    "roll": f"""
      SELECT * FROM roll_region UNION ALL BY NAME
      SELECT delivery_month, 999 AS sales_region_id, {_SUMS} FROM roll_region GROUP BY 1""",
}
ROLL_OUT = FINAL_OUT.replace("entry_date", "delivery_month")


def pnl(on_region: str) -> dict[str, str]:
    cols = ", ".join(f"w.{m}" for m in labor.MONTHLY_MEASURES)
    return (
        costs
        | deliveries
        | rollup
        | {
            "pnl": f"""
      SELECT c.*, d.delivery_cost, {cols} FROM costs c
      LEFT JOIN delivery d ON d.delivery_month = c.delivery_month AND d.sales_region_id = c.sales_region_id
      LEFT JOIN roll w ON w.delivery_month = c.delivery_month AND w.sales_region_id = {on_region}"""
        }
    )


PNL_OUT = COSTS_OUT + " delivery_cost " + " ".join(labor.MONTHLY_MEASURES)


def _select(spec: str, cte: str, where: str = "") -> str:
    return f"SELECT {out(spec)} FROM {cte} {where}"


reg.add(
    "order_grain_base",
    lambda t: monthly.order_grain_base(t, AS_OF),
    query(_select(GRAIN_OUT.format(p="delivery_month"), "grain"), **grain),
)
reg.add(
    "monthly_region_net_revenue",
    lambda t: monthly.net_revenue(t, AS_OF).filter("sales_region_id <> 999"),
    query(_select(SALES_OUT, "sales", "WHERE sales_region_id <> 999"), **sales),
)
reg.add(
    "monthly_company_net_revenue",
    lambda t: monthly.net_revenue(t, AS_OF).filter("sales_region_id = 999"),
    query(_select(SALES_OUT, "sales", "WHERE sales_region_id = 999"), **sales),
)
reg.add(
    "reported_pl_latest",
    lambda t: rates.reported_rates_latest(t["monthly_actual_pl"], AS_OF),
    query(
        _select(
            "d: report_month; l: region_id; f: inbound_pct wh_labor packaging_pct processing_fee_pct "
            "css wh_pct ops_pct misc_pct",
            "reported",
        ),
        **reported,
    ),
)
reg.add(
    "allocate_rate_costs",
    lambda t: monthly.rate_costs(t, AS_OF),
    query(_select(COSTS_OUT, "costs"), **costs),
)
reg.add(
    "delivery_cost",
    lambda t: monthly.delivery_cost(t, AS_OF),
    query(
        _select("d: delivery_month; l: sales_region_id; f: delivery_cost", "delivery"), **deliveries
    ),
)
reg.add(
    "inbound_labor_pct",
    lambda t: labor.inbound_labor_pct_monthly([t["nj_labor"], t["chi_labor"]], AS_OF),
    query(
        _select("d: delivery_week; l: sales_region_id; f: inbound_pct lag_inbound_pct", "pct"),
        **pct,
    ),
)
reg.add(
    "labor_by_warehouse",
    lambda t: labor.labor_by_warehouse(t["labor_cost_detail"], AS_OF),
    query(
        _select(
            "d: entry_date entry_week; l: sales_region_id; f: total_cost dry_cost nondry_cost mo_outbound",
            "work",
        ),
        **work,
    ),
)
reg.add(
    "dry_revenue_share",
    lambda t: labor.dry_revenue_share(t["order_product"], AS_OF),
    query(_select("d: delivery_day; l: sales_region_id; f: dry_rev_pct", "dry"), **dry),
)
reg.add(
    "nondry_revenue_share",
    lambda t: labor.nondry_revenue_share(t["order_product"], AS_OF),
    query(_select("d: delivery_day; l: sales_region_id; f: nondry_rev_pct", "nondry"), **nondry),
)
reg.add(
    "cutover_share",
    lambda t: labor.cutover_share(t["order_product"], AS_OF, st.CUTOVER),
    query(
        _select("d: delivery_day; l: sales_region_id; f: dry_rev_pct nondry_rev_pct", "share"),
        **share,
    ),
)
reg.add(
    "mail_order_share",
    lambda t: labor.mail_order_share(t["order_product"], AS_OF),
    query(_select("d: delivery_day; l: sales_region_id; f: mo_pct", "mail"), **mail),
)
reg.add(
    "labor_allocation_base",
    lambda t: monthly.labor_base(t, AS_OF, st.CUTOVER),
    query(_select(BASE_OUT, "lbase"), **base),
)
reg.add(
    "labor_final_by_region",
    lambda t: monthly.labor_final(t, AS_OF, st.CUTOVER),
    query(_select(FINAL_OUT, "final"), **final),
)
reg.add(
    "labor_mail_order",
    lambda t: labor.labor_mail_order(monthly.labor_final(t, AS_OF, st.CUTOVER)),
    query(_select(FINAL_OUT, "labor_mo"), **labor_mo),
)
reg.add(
    "labor_period_rollup",
    lambda t: monthly.labor_rollup(t, AS_OF, st.CUTOVER),
    query(_select(ROLL_OUT, "roll"), **rollup),
)
reg.add(
    "monthly_pnl",
    lambda t: monthly.monthly_pnl(t, AS_OF, st.CUTOVER),
    query(_select(PNL_OUT, "pnl"), **pnl("d.sales_region_id")),
)
reg.add(
    "monthly_pnl_corrected",
    lambda t: monthly.monthly_pnl(t, AS_OF, st.CUTOVER, corrected=True),
    query(_select(PNL_OUT, "pnl"), **pnl("c.sales_region_id")),
)
