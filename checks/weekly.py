"""Weekly P&L queries and their oracles."""

from __future__ import annotations


from checks import standins as st
from checks.monthly import FOLD, GRAIN_OUT, M6, MAIL_LINE, WAREHOUSE, delivery, order_grain, waterfall_sums
from checks.registry import Registry
from checks.views import out, query, sunday
from periodbook.plans import labor, rates, weekly

reg = Registry()
AS_OF = st.AS_OF
SHEETS = ("regional_pl",)
LAST = "DATE '2000-04-02'"
FIRST_SHOWN = "DATE '2000-03-12'"
SHOWN = f"BETWEEN {FIRST_SHOWN} AND {LAST}"


def _select(spec: str, cte: str, where: str = "") -> str:
    return f"SELECT {out(spec)} FROM {cte} {where}"


def _sales(first: str, last: str, monday: bool, corrected: bool = False) -> dict[str, str]:
    grown = f"""CASE WHEN sales_region_id <> 999 AND delivery_week = {last} THEN
          CAST(CAST(refund_sum AS DOUBLE) / (CASE sales_region_id WHEN 3 THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END) AS {M6})
        ELSE CAST(refund_sum AS {M6}) END"""
    refund = grown if monday else f"CAST(refund_sum AS {M6})"
    company = (
        """CASE WHEN sales_region_id = 999 THEN sum(r0) FILTER (WHERE sales_region_id <> 999)
             OVER (PARTITION BY delivery_week) ELSE r0 END"""
        if corrected
        else "r0"
    )
    return {
        "fold": FOLD,
        "grain": order_grain("delivery_week", f"delivery_week BETWEEN {first} AND {last}"),
        "sums": waterfall_sums("delivery_week", "Company Total"),
        "refunds": f"SELECT *, {company} AS refund_rev FROM (SELECT *, {refund} AS r0 FROM sums) s",
        "ranks": """
          SELECT delivery_week, rank() OVER (PARTITION BY year(delivery_week), month(delivery_week)
            ORDER BY delivery_week DESC) AS rk FROM (SELECT DISTINCT delivery_week FROM sums) w""",
        "sales": """
          SELECT delivery_week, rk, sales_region_id, sales_region_title, 0.023 AS rebate_rate, new_user,
            active_user, gross_rev, CAST(gross_rev AS DOUBLE) / active_user AS arpu, total_coupon_rev,
            new_user_coupon, total_coupon_rev - 10 * new_user AS coupon_rev, refund_rev, oos_rev,
            oos_rev + refund_rev AS total_refund_rev, cogs_rev,
            CAST(gross_rev - gross_rev * 0.023 AS DECIMAL(28,6)) - oos_rev - refund_rev
              - (total_coupon_rev - 10 * new_user) AS net_rev
          FROM refunds JOIN ranks USING (delivery_week)""",
    }


SALES_OUT = (
    "d: delivery_week; l: rk sales_region_id; s: sales_region_title; f: rebate_rate; "
    "l: new_user active_user; f: gross_rev arpu total_coupon_rev new_user_coupon coupon_rev "
    "refund_rev oos_rev total_refund_rev cogs_rev net_rev"
)
sales = _sales("DATE '2000-02-06'", LAST, monday=True)
grain = {k: sales[k] for k in ("fold", "grain")} | {
    "ranked": """
      SELECT g.*, rk FROM grain g JOIN (
        SELECT delivery_week, rank() OVER (PARTITION BY date_trunc('month', delivery_week)
          ORDER BY delivery_week DESC) AS rk FROM (SELECT DISTINCT delivery_week FROM grain) w) r USING (delivery_week)"""
}

ranked = {
    "ranked_rates": """
      SELECT region_id, sales_region_title,
        CAST(strptime('01 ' || replace(delivery_month, '''', ' '), '%d %b %y') AS DATE) AS report_month,
        dense_rank() OVER (PARTITION BY region_id
          ORDER BY strptime('01 ' || replace(delivery_month, '''', ' '), '%d %b %y') DESC) AS rn,
        TRY_CAST(inbound_pct AS DOUBLE) AS inbound_pct, TRY_CAST(wh_labor_pct AS DOUBLE) AS wh_labor,
        TRY_CAST(packaging_pct AS DOUBLE) AS packaging_pct, TRY_CAST(processing_pct AS DOUBLE) AS processing_fee_pct,
        0.001 AS css, TRY_CAST(wh_pct AS DOUBLE) AS wh_pct, TRY_CAST(ops_pct AS DOUBLE) AS ops_pct,
        TRY_CAST(misc_pct AS DOUBLE) AS misc_pct
      FROM v_regional_pl WHERE contains(delivery_month, '''')"""
}
RATES_OUT = (
    "l: region_id; s: sales_region_title; d: report_month; l: rn; f: inbound_pct wh_labor "
    "packaging_pct processing_fee_pct css wh_pct ops_pct misc_pct"
)


def _mean(v: str) -> str:
    return f"CAST(sum(CAST({v} AS {M6})) AS DOUBLE) / count({v})"


# the cross product as the report spells it: every branch repeats every other
card = (
    sales
    | ranked
    | {
        "card": f"""
      SELECT n.report_month, n.region_id, {_mean('i.inbound_pct')} AS avg_inbound_pct, max(n.inbound_pct) AS inbound_pct,
        max(n.packaging_pct) AS packaging_pct, {_mean('p.packaging_pct')} AS avg_packaging_pct,
        max(n.processing_fee_pct) AS processing_fee_pct, max(n.wh_pct) AS wh_pct,
        {_mean('(n.wh_pct * CAST(s.net_rev AS DOUBLE))')} AS avg_wh_dollar_value, max(n.ops_pct) AS ops_pct,
        {_mean('(n.ops_pct * CAST(s.net_rev AS DOUBLE))')} AS avg_ops_dollar_value, max(n.misc_pct) AS misc_pct,
        {_mean('(n.misc_pct * CAST(s.net_rev AS DOUBLE))')} AS avg_misc_dollar_value
      FROM (SELECT * FROM ranked_rates WHERE rn = 1) n
      LEFT JOIN (SELECT * FROM sales WHERE delivery_week BETWEEN DATE '2000-03-01' AND DATE '2000-03-31') s
        ON s.sales_region_id = n.region_id
      LEFT JOIN (SELECT region_id, packaging_pct FROM ranked_rates WHERE rn <= 4) p ON p.region_id = n.region_id
      LEFT JOIN (SELECT region_id, inbound_pct FROM ranked_rates WHERE rn <= 4) i ON i.region_id = n.region_id
      GROUP BY 1, 2"""
    }
)
CARD_OUT = (
    "d: report_month; l: region_id; f: avg_inbound_pct inbound_pct packaging_pct avg_packaging_pct "
    "processing_fee_pct wh_pct avg_wh_dollar_value ops_pct avg_ops_dollar_value misc_pct avg_misc_dollar_value"
)
costs = card | {
    "costs0": f"""
      SELECT s.*,
        CASE WHEN april THEN avg_inbound_pct * net ELSE inbound_pct * net END AS inbound_rev,
        processing_fee_pct * net AS processing_rev,
        CASE WHEN april THEN avg_packaging_pct * net ELSE packaging_pct * net END AS packaging_rev,
        0.001::DOUBLE * net AS cs_rev,
        CASE WHEN april THEN avg_wh_dollar_value ELSE wh_pct * net END AS warehouse_rev,
        CASE WHEN april THEN avg_misc_dollar_value ELSE misc_pct * net END AS misc_rev,
        CASE WHEN april THEN avg_ops_dollar_value ELSE ops_pct * net END AS ops_rev
      FROM (SELECT *, month(delivery_week) = 4 AS april, CAST(net_rev AS DOUBLE) AS net FROM sales
            WHERE delivery_week {SHOWN}) s
      LEFT JOIN card c ON c.region_id = s.sales_region_id""",
    "costs": "SELECT *, packaging_rev / net AS packaging_pct, processing_rev / net AS processing_pct FROM costs0",
}
COSTS_OUT = SALES_OUT + (
    " inbound_rev processing_rev packaging_rev cs_rev warehouse_rev misc_rev ops_rev packaging_pct processing_pct"
)
deliveries = delivery(
    "delivery_week", "delivery_week", sunday("CAST(deal_delivery_date AS DATE)"), "{k} " + SHOWN
)

pct = {
    "pct": """
      SELECT CAST(delivery_week AS DATE) AS delivery_week, sales_region_id, TRY_CAST(inbound_pct AS DOUBLE) AS inbound_pct
      FROM (FROM v_nj_labor UNION ALL FROM v_chi_labor) u WHERE CAST(delivery_week AS DATE) < DATE '2000-04-02'"""
}
KEY = "CASE {w} WHEN DATE '2000-03-19' THEN {d} ELSE {w} END"
work = {
    "work": f"""
      SELECT {KEY.format(w='w.entry_week', d='w.entry_date')} AS entry_week, rid AS sales_region_id,
        sum(labor_cost) AS total_cost,
        coalesce(sum(labor_cost) FILTER (WHERE rid = 2 AND NOT contains(department_name, 'OP - DC')), 0) AS total_cost_ex_dc,
        coalesce(sum(labor_cost) FILTER (WHERE rid = 2 AND department_name ILIKE '%dry%'), 0) AS dry_cost,
        coalesce(sum(labor_cost) FILTER (WHERE rid IN (7, 15) AND department_name ILIKE '%mail order - outbound%'), 0) AS mo_outbound
      FROM (SELECT *, {WAREHOUSE} AS rid FROM v_labor WHERE warehouse NOT IN ('check', 'LA - Greater')
              AND filter_flag = 'N' AND entry_week {SHOWN}) w
      GROUP BY 1, 2"""
}
LINES = f"order_biz_type IN ('grocery', 'alcohol') AND delivery_week {SHOWN}"
share = {
    "share": f"""
      SELECT delivery_week, sales_region_id,
        CASE WHEN sales_region_id = 2 THEN 0::DOUBLE
             WHEN sales_region_id = 3 OR delivery_week < DATE '2000-03-25'
               THEN CAST(dry_rev AS DOUBLE) / nullif(CAST(sum(dry_rev) OVER w AS DOUBLE), 0)
             ELSE CAST(gross_rev AS DOUBLE) / nullif(CAST(sum(gross_rev) OVER w AS DOUBLE), 0) END AS rev_pct
      FROM (SELECT {KEY.format(w='v.delivery_week', d='v.delivery_day')} AS delivery_week,
              CASE WHEN sales_region_id IN (1, 2) THEN sales_region_id ELSE 3 END AS sales_region_id,
              coalesce(sum(sub_total) FILTER (WHERE storage_type = 'N'), 0) AS dry_rev, sum(sub_total) AS gross_rev
            FROM v_op v WHERE {LINES} AND inventory_title = 'LA - La Mirada' AND payment_mode = 'F' GROUP BY 1, 2) g
      WINDOW w AS (PARTITION BY delivery_week)"""
}
mail = {
    "mail": f"""
      SELECT {KEY.format(w='v.delivery_week', d='v.delivery_day')} AS delivery_week,
        CASE inventory_title WHEN 'IL - Chicago' THEN 15 ELSE 7 END AS sales_region_id,
        CAST(coalesce(sum(sub_total) FILTER (WHERE {MAIL_LINE}), 0) AS DOUBLE) / CAST(sum(sub_total) AS DOUBLE) AS mo_pct
      FROM v_op v WHERE {LINES} AND inventory_title IN ('IL - Chicago', 'NJ - New York') GROUP BY 1, 2"""
}
base = (
    pct
    | work
    | share
    | mail
    | {
        "lbase": f"""
      SELECT w.entry_week, w.sales_region_id, CAST(w.total_cost AS {M6}) AS total_cost,
        CAST(w.total_cost_ex_dc AS {M6}) AS total_cost_ex_dc, CAST(w.dry_cost AS {M6}) AS dry_cost,
        CAST(w.mo_outbound AS {M6}) AS mo_outbound,
        CASE WHEN w.sales_region_id IN (7, 15) THEN CAST(CAST(w.total_cost AS DOUBLE) * p.inbound_pct * m.mo_pct AS {M6})
             WHEN w.sales_region_id = 2 THEN CAST(CAST(w.dry_cost AS DOUBLE) * s3.rev_pct AS {M6}) ELSE 0 END AS mo_labor,
        CAST(CAST(CASE WHEN w.sales_region_id = 2 AND w.entry_week < DATE '2000-03-25' THEN w.dry_cost
             ELSE w.total_cost_ex_dc END AS DOUBLE) * s1.rev_pct AS {M6}) AS allo_cost
      FROM work w
      LEFT JOIN share s3 ON s3.delivery_week = w.entry_week AND s3.sales_region_id = 3
      LEFT JOIN share s1 ON s1.delivery_week = w.entry_week AND s1.sales_region_id = 1
      LEFT JOIN mail m ON m.delivery_week = w.entry_week AND m.sales_region_id = w.sales_region_id
      LEFT JOIN pct p ON p.delivery_week = {sunday('w.entry_week')} AND p.sales_region_id = w.sales_region_id"""
    }
)
BASE_OUT = (
    "d: entry_week; l: sales_region_id; f: total_cost total_cost_ex_dc dry_cost mo_outbound mo_labor allo_cost"
)
final = base | {
    "final": f"""
      SELECT b.entry_week, b.sales_region_id, b.total_cost, coalesce(g.cost, 0) AS la_greater_labor_cost,
        CASE b.sales_region_id WHEN 1 THEN la.allo_cost ELSE b.allo_cost END AS allo_cost, b.mo_outbound, b.mo_labor,
        CASE WHEN b.sales_region_id = 2 THEN b.total_cost - b.mo_labor - b.allo_cost + coalesce(g.cost, 0)
             WHEN b.sales_region_id = 1 THEN b.total_cost + la.allo_cost
             WHEN b.sales_region_id IN (7, 15) THEN b.total_cost - b.mo_outbound - b.mo_labor
             WHEN b.sales_region_id IS NOT NULL THEN b.total_cost END AS final_labor_cost
      FROM lbase b
      LEFT JOIN lbase la ON la.entry_week = b.entry_week AND la.sales_region_id = 2
      LEFT JOIN (SELECT {KEY.format(w='x.entry_week', d='x.entry_date')} AS k, CAST(sum(labor_cost) AS {M6}) AS cost
                 FROM v_labor x WHERE filter_flag = 'N' AND warehouse = 'LA - Greater' GROUP BY 1) g
        ON b.sales_region_id = 2 AND g.k = b.entry_week"""
}
FINAL_OUT = (
    "d: entry_week; l: sales_region_id; f: total_cost la_greater_labor_cost allo_cost mo_outbound mo_labor final_labor_cost"
)
labor_mo = final | {
    "labor_mo": """
      SELECT entry_week, 3 AS sales_region_id, sum(mo_outbound) + sum(mo_labor) AS total_cost,
        0 AS la_greater_labor_cost, 0 AS allo_cost, sum(mo_outbound) AS mo_outbound, sum(mo_labor) AS mo_labor,
        sum(mo_outbound) + sum(mo_labor) AS final_labor_cost FROM final GROUP BY 1"""
}
_SUMS = ", ".join(f"sum({m}) AS {m}" for m in labor.WEEKLY_MEASURES)
rollup = labor_mo | {
    "roll_region": f"""
      SELECT CASE WHEN entry_week BETWEEN DATE '2000-03-19' AND DATE '2000-03-25' THEN DATE '2000-03-19'
             ELSE entry_week END AS delivery_week, sales_region_id, {_SUMS}
      FROM (SELECT * FROM final UNION ALL BY NAME SELECT * FROM labor_mo) u GROUP BY 1, 2""",
    "roll": f"""
      SELECT * FROM roll_region UNION ALL BY NAME
      SELECT delivery_week, 999 AS sales_region_id, {_SUMS} FROM roll_region GROUP BY 1""",
}
ROLL_OUT = FINAL_OUT.replace("entry_week", "delivery_week")
_WORK = ", ".join(f"w.{m}" for m in labor.WEEKLY_MEASURES)
pnl_base = (
    costs
    | deliveries
    | rollup
    | {
        "pnl_base": f"""
      SELECT c.*, d.delivery_cost, CAST(d.delivery_cost AS DOUBLE) * 1.01::DOUBLE / net AS delivery_cost_pct, {_WORK},
        CAST(w.final_labor_cost AS DOUBLE) / net AS wh_labor_pct
      FROM costs c
      JOIN delivery d ON d.delivery_week = c.delivery_week AND d.sales_region_id = c.sales_region_id
      LEFT JOIN roll w ON w.delivery_week = c.delivery_week AND w.sales_region_id = c.sales_region_id"""
    }
)
PNL_BASE_OUT = (
    COSTS_OUT + " delivery_cost delivery_cost_pct " + " ".join(labor.WEEKLY_MEASURES) + " wh_labor_pct"
)


def carried(own: dict[str, str]) -> str:
    cols = ("total_cost", "la_greater_labor_cost", "allo_cost", "mo_outbound", "mo_labor",
            "final_labor_cost", "delivery_cost", "delivery_cost_pct", "wh_labor_pct")
    items = ", ".join(
        f"CASE WHEN delivery_week < {LAST} THEN {own.get(c, c)} ELSE lag({c}) OVER w END AS {c}" for c in cols
    )
    return f"SELECT * REPLACE ({items}) FROM pnl_base WINDOW w AS (PARTITION BY sales_region_id ORDER BY delivery_week)"


pnl = pnl_base | {"pnl": carried({"mo_labor": "allo_cost", "final_labor_cost": "delivery_cost"})}
PNL_OUT = PNL_BASE_OUT.replace("l: rk ", "l: ")

reg.add(
    "weekly_order_grain_base",
    lambda t: weekly.ranked_order_grain(t, AS_OF),
    query(_select(GRAIN_OUT.format(p="delivery_week") + "; l: rk", "ranked"), **grain),
)
reg.add(
    "weekly_region_net_revenue",
    lambda t: weekly.net_revenue(t, AS_OF).filter("sales_region_id <> 999"),
    query(_select(SALES_OUT, "sales", "WHERE sales_region_id <> 999"), **sales),
)
reg.add(
    "weekly_company_net_revenue",
    lambda t: weekly.net_revenue(t, AS_OF).filter("sales_region_id = 999"),
    query(_select(SALES_OUT, "sales", "WHERE sales_region_id = 999"), **sales),
)
for label, as_of, first, last in (
    ("sunday", st.AS_OF_SUNDAY, "DATE '2000-02-06'", "DATE '2000-04-02'"),
    ("wednesday", st.AS_OF_WED, "DATE '2000-02-06'", "DATE '2000-04-02'"),
):
    reg.add(
        f"weekly_net_revenue_{label}",
        lambda t, as_of=as_of: weekly.net_revenue(t, as_of),
        query(_select(SALES_OUT, "sales"), **_sales(first, last, monday=False)),
    )
reg.add(
    "weekly_net_revenue_corrected",
    lambda t: weekly.net_revenue(t, AS_OF, corrected=True),
    query(_select(SALES_OUT, "sales"), **_sales("DATE '2000-02-06'", LAST, True, corrected=True)),
)
reg.add(
    "reported_pl_ranked",
    lambda t: rates.reported_rates_ranked([t["regional_pl"]]),
    query(_select(RATES_OUT, "ranked_rates"), **ranked),
)
reg.add(
    "rate_card",
    lambda t: rates.rate_card(
        rates.reported_rates_ranked([t["regional_pl"]]), weekly.net_revenue(t, AS_OF), AS_OF
    ),
    query(_select(CARD_OUT, "card"), **card),
)
reg.add(
    "weekly_rate_costs",
    lambda t: weekly.rate_costs(t, AS_OF, SHEETS),
    query(_select(COSTS_OUT, "costs"), **costs),
)
reg.add(
    "weekly_delivery_cost",
    lambda t: weekly.delivery_cost(t, AS_OF),
    query(_select("d: delivery_week; l: sales_region_id; f: delivery_cost", "delivery"), **deliveries),
)
reg.add(
    "weekly_inbound_labor_pct",
    lambda t: labor.inbound_labor_pct_weekly([t["nj_labor"], t["chi_labor"]], AS_OF),
    query(_select("d: delivery_week; l: sales_region_id; f: inbound_pct", "pct"), **pct),
)
reg.add(
    "weekly_labor_by_warehouse",
    lambda t: labor.weekly_labor_by_warehouse(t["labor_cost_detail"], AS_OF, st.CUTOVER),
    query(
        _select("d: entry_week; l: sales_region_id; f: total_cost total_cost_ex_dc dry_cost mo_outbound", "work"),
        **work,
    ),
)
reg.add(
    "weekly_la_share",
    lambda t: labor.weekly_la_share(t["order_product"], AS_OF, st.CUTOVER),
    query(_select("d: delivery_week; l: sales_region_id; f: rev_pct", "share"), **share),
)
reg.add(
    "weekly_mail_order_share",
    lambda t: labor.weekly_mail_order_share(t["order_product"], AS_OF, st.CUTOVER),
    query(_select("d: delivery_week; l: sales_region_id; f: mo_pct", "mail"), **mail),
)
reg.add(
    "weekly_labor_allocation_base",
    lambda t: weekly.labor_base(t, AS_OF, st.CUTOVER),
    query(_select(BASE_OUT, "lbase"), **base),
)
reg.add(
    "weekly_labor_final",
    lambda t: weekly.labor_final(t, AS_OF, st.CUTOVER),
    query(_select(FINAL_OUT, "final"), **final),
)
reg.add(
    "weekly_labor_mail_order",
    lambda t: labor.weekly_labor_mail_order(weekly.labor_final(t, AS_OF, st.CUTOVER)),
    query(_select(FINAL_OUT, "labor_mo"), **labor_mo),
)
reg.add(
    "weekly_labor_rollup",
    lambda t: weekly.labor_rollup(t, AS_OF, st.CUTOVER),
    query(_select(ROLL_OUT, "roll"), **rollup),
)
reg.add(
    "weekly_pnl_base",
    lambda t: weekly.weekly_pnl_base(t, AS_OF, st.CUTOVER, SHEETS),
    query(_select(PNL_BASE_OUT, "pnl_base"), **pnl_base),
)
reg.add(
    "weekly_pnl",
    lambda t: weekly.weekly_pnl(t, AS_OF, st.CUTOVER, SHEETS),
    query(_select(PNL_OUT, "pnl"), **pnl),
)
reg.add(
    "weekly_pnl_nine_sheets",  # the nine regional sheets, read together
    lambda t: weekly.weekly_pnl(t, AS_OF, st.CUTOVER),
    query(_select(PNL_OUT, "pnl"), **pnl),
)
# dictionaries keep the order of their keys, so the corrected steps take the old ones' places
corrected = pnl_base | _sales("DATE '2000-02-06'", LAST, True, corrected=True)
corrected["pnl_base"] = corrected["pnl_base"].replace("JOIN delivery d", "LEFT JOIN delivery d")
corrected["pnl"] = carried({})
reg.add(
    "weekly_pnl_corrected",
    lambda t: weekly.weekly_pnl(t, AS_OF, st.CUTOVER, SHEETS, corrected=True),
    query(_select(PNL_OUT, "pnl"), **corrected),
)
