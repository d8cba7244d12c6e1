"""Column contracts of the input tables (only the columns that reports use).

Sheets that people fill in by hand hold numbers and dates as text; they stay
text here and are typed by :mod:`periodbook.sources.sheets`.
"""

from __future__ import annotations

MONEY_T = "decimal(18,4)"

_REGIONAL_PL = (
    "region_id bigint, sales_region_title string, delivery_month string, inbound_pct string, "
    "wh_labor_pct string, packaging_pct string, processing_pct string, wh_pct string, "
    "ops_pct string, misc_pct string"
)
_LABOR_PCT = "delivery_week string, sales_region_id bigint, inbound_pct string"

SCHEMAS: dict[str, str] = {
    "order_product": (
        "delivery_day date, delivery_week date, delivery_month date, order_day date, "
        "order_create_time timestamp_ntz, order_id bigint, buyer_id bigint, product_id bigint, "
        "group_invoice_id bigint, sales_region_id bigint, sales_org_id bigint, "
        "sales_region_title string, biz_type string, order_biz_type string, payment_mode string, "
        "inventory_title string, storage_type string, division string, ethnicity_user string, "
        "coupon string, price_type string, discount_reason string, mail_type string, "
        "daily_new_users_flag int, is_gm int, sub_total decimal(18,4), "
        "product_refund_amount decimal(18,4), discount decimal(18,4), gm_cost decimal(18,4), "
        "gm_margin decimal(18,4), gm_base decimal(18,4), product_base_price decimal(18,4), "
        "product_price decimal(18,4), quantity int"
    ),
    "monthly_actual_pl": (
        "delivery_month string, sales_region_title string, gross_rev string, inbound_pct string, "
        "wh_labor_pct string, packaging_pct string, processing_pct string, wh_pct string, "
        "ops_pct string, misc_pct string"
    ),
    "dispatch_performance": (
        "delivery_date date, delivery_week date, sales_region_id bigint, sales_region string, "
        "total_delivery_cost decimal(18,4), linehaul_cost decimal(18,4), "
        "delivery_plan_type string, tms_on_time_flag string, invoice_id bigint"
    ),
    "mail_order_shipment": "deal_delivery_date string, wms_order_id bigint, rate decimal(18,4)",
    "nj_labor": _LABOR_PCT,
    "chi_labor": _LABOR_PCT,
    "labor_cost_detail": (
        "entry_date date, entry_week date, warehouse string, department_name string, "
        "filter_flag string, labor_cost decimal(18,4)"
    ),
    **{f"{r}_pl": _REGIONAL_PL for r in ("ba", "la", "nj", "sea", "fl", "tx", "mo", "groc", "chi")},
    "product_price": "id bigint, product_id bigint, sales_org_id bigint",
    "product_price_special": (
        "product_price_id bigint, start_time bigint, end_time bigint, reason string"
    ),
    "sales_org_price_region": "sales_org_id bigint, price_region_id bigint",
    "revenue_main": (
        "delivery_week date, delivery_month date, delivery_day date, discount decimal(18,4), "
        "expense_pct decimal(18,4), revenue decimal(18,4), net_revenue decimal(18,4), "
        "new_user_coupon decimal(18,4), oos decimal(18,4), shipped_and_refunded decimal(18,4), "
        "total_discount decimal(18,4)"
    ),
    "sessions_details": "sess_date date, orders int, session_id string",
    "survey_response": (
        "response_date date, response_id bigint, question_id bigint, promoter_flag int, "
        "detractor_flag int, response_region string"
    ),
    "perfect_order": (
        "delivery_day date, region string, delivery_type string, not_perfect_orders bigint, "
        "total_orders bigint"
    ),
    "orders": (
        "order_day date, order_week date, order_month date, delivery_day date, "
        "delivery_week date, order_id bigint, buyer_id bigint, sales_org_id bigint, "
        "device_type string, language string, payment_mode string, coupon string, "
        "daily_new_users_flag_order int, daily_new_users_flag int, discount decimal(18,4)"
    ),
    "mkt_ltv": (
        "device string, language string, region string, wd int, revenue decimal(18,4), "
        "cohort_buyers bigint, start_week date"
    ),
    "marketing_spend": "date date, channel string, cost decimal(18,4)",
    "coupon_use": "order_id bigint, code string",
    "coupon_code": "code string",
    "order_discount": "order_id bigint, type string, amount decimal(18,4)",
    "user_points": "rec_create_time timestamp_ntz, points bigint, type string",
    "mkt_other_spend": (
        "month date, content_marketing_spend decimal(18,4), salary_cost decimal(18,4), "
        "agency_fee decimal(18,4), contractor_fee decimal(18,4), tools_cost decimal(18,4), "
        "es_ethnic_cost decimal(18,4), ja_ethnic_cost decimal(18,4), "
        "ko_ethnic_cost decimal(18,4), vi_ethnic_cost decimal(18,4)"
    ),
    "restaurant_order": (
        "delivery_day date, order_day date, order_type string, order_total decimal(18,4), "
        "cm_margin decimal(18,4), cm_base decimal(18,4)"
    ),
    "plan_data": (
        "delivery_unit string, unit_type string, gross_rev_plan decimal(18,4), "
        "net_rev_plan decimal(18,4), gm_plan decimal(18,4), new_users bigint, "
        "active_users bigint, arpu_plan decimal(18,4)"
    ),
    "calendar": (
        "cal_date date, week_begin_date date, month_begin_date date, quarter_begin_date date"
    ),
    "division_plan": (
        "delivery_month string, dairy_deli decimal(18,4), protein decimal(18,4), "
        "frozen decimal(18,4), produce decimal(18,4), dry_grocery decimal(18,4), "
        "gm_hbc decimal(18,4)"
    ),
    "order_case_details": (
        "delivery_day date, order_day date, inventory_title string, group_invoice_id bigint, "
        "order_case_id_np bigint, order_case_id_p bigint"
    ),
    "sku_params_snapshot": (
        "date date, storage_type string, title string, is_food string, is_protein string, "
        "is_produce string, ethnicity string, max_sku_count int"
    ),
    "in_stock_rate": (
        "order_day date, storage_type string, sales_region_title string, department string, "
        "sku_region_status string, sku_availability int, product_id bigint"
    ),
}
