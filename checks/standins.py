"""The driver's tables in the shape of the report inputs.

Everything here is derived by Spark from the whole given tables.  The same mapping
is written in SQL in :mod:`checks.views` for the oracle.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodbook.functions.periods import PeriodWindow, month_start, quarter_start, week_start
from periodbook.plans.labor import Cutover
from periodbook.sources.tables import Tables, calendar, read_table

AS_OF = date(2000, 4, 10)  # a Monday: the newest week's refunds are still incomplete
AS_OF_SUNDAY = date(2000, 4, 9)
AS_OF_TUESDAY = date(2000, 4, 11)
AS_OF_WED = date(2000, 4, 12)
CUTOVER = Cutover(week=date(2000, 3, 19), day=date(2000, 3, 25))
REPORTED_BEFORE = date(2000, 3, 1)  # sheets hold the months before this one
BOOKING_START = date(1995, 1, 1)
OVERHEAD_START = date(1994, 12, 1)
GATE = "ASIA"

REGION_IDS = [1, 2, 3, 4, 7, 10, 15, 23, 24]
REGION_TITLES = {
    1: "SF Bay Area", 2: "LA - Greater", 3: "MAIL ORDER", 4: "Seattle", 7: "New York",
    10: "Houston", 15: "Chicago", 23: "Tampa", 24: "MOF",
}
SHEET_TITLES = {
    1: "Bay Area", 2: "LA", 3: "Mail Order", 4: "Seattle", 7: "New Jersey",
    10: "Texas", 15: "Midwest", 23: "Florida", 24: "Pantry",
}
DIVISION_LIST = ["Produce", "Protein", "Frozen", "Dairy/Deli", "Dry Grocery", "GM & HBC"]
STORAGE_LIST = ["N", "F", "R"]
INVENTORY_LIST = [
    "LA - La Mirada", "IL - Chicago", "NJ - New York", "SF - Union City", "TX - Houston",
    "WA - Seattle", "FL - Tampa",
]
SITE_LIST = ["Houston", "Chicago", "Tampa"]
REASONS = [
    "Vendor funded", "Boost Revenue", "Clearance", "Expiring Control",
    "Q1 Freeup space", "Vendor Sponsored Promotion A", "",
]
PCTS = [f"{n}_pct" for n in ("inbound", "wh_labor", "packaging", "processing", "wh", "ops", "misc")]
SPECIALS_START = 946684800  # 2000-01-01 00:00 UTC
DAY_SECONDS = 86400


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index + 1).cast("int"))


def title_of(region: Column, titles: dict[int, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in titles.items() for x in kv)), region)


def dec(c: Column | str, kind: str = "decimal(18,4)") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(kind)


# what the stand-ins take from the joined lines
LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_tax l_returnflag l_linestatus l_shipdate "
    "o_orderkey o_custkey o_orderdate o_orderstatus o_orderpriority c_nationkey c_mktsegment r_name "
    "p_brand p_type p_size p_retailprice"
).split()
ORDER_COLUMNS = (
    "o_orderkey o_custkey o_orderdate o_orderstatus o_orderpriority o_totalprice "
    "c_custkey c_nationkey c_mktsegment"
).split()


class StandIns:
    """Stand-ins of a folder's tables.

    With a ``window``, orders with their buyers and the lines delivered in the window are
    joined once and kept on the executors' disks, for a report that reads the window's rows
    of many tables made of them.  Tables that are not about delivery days take every line.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, window: PeriodWindow | None = None):
        self.spark, self.dir, self.window = spark, sf_dir, window
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.dir, name)
        return self._raw[name]

    @cached_property
    def _sold(self) -> DataFrame:
        """Orders with their buyers."""
        o, c = self.raw("orders"), self.raw("customer")
        sold = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(*ORDER_COLUMNS)
        return sold if self.window is None else sold.persist(StorageLevel.DISK_ONLY)

    @cached_property
    def _wide(self) -> DataFrame:
        """Lines with their order, buyer and product."""
        n, r, p = self.raw("nation"), self.raw("region"), self.raw("part")
        return (
            self.raw("lineitem")
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .join(self._sold, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(*LINE_COLUMNS)
        )

    @cached_property
    def order_product(self) -> DataFrame:
        return self._lines(self._wide)

    @cached_property
    def delivered(self) -> DataFrame:
        """``order_product``; with a window, its lines delivered in there."""
        if self.window is None:
            return self.order_product
        inside = self._wide.filter(self.window.holds_day(F.col("l_shipdate").cast("date")))
        return self._lines(inside.persist(StorageLevel.DISK_ONLY))

    @staticmethod
    def _lines(wide: DataFrame) -> DataFrame:
        day = F.col("l_shipdate").cast("date")
        region = pick(REGION_IDS, F.col("c_nationkey") % 9).cast("bigint")
        brand = F.substring_index("p_brand", "#", -1).cast("int")
        sub_total = F.col("l_extendedprice").cast("decimal(18,2)")
        is_gm = F.when(
            (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), 0
        ).otherwise(1)
        refund = F.when(
            F.col("l_returnflag") == "R", sub_total * F.col("l_tax").cast("decimal(4,2)")
        ).otherwise(F.lit(0))
        cents = (sub_total * 100).cast("bigint")
        qty = F.col("l_quantity").cast("int")
        unit_cents = F.call_function("div", cents, qty.cast("bigint"))
        base = dec(sub_total * is_gm)
        cost = dec(sub_total * F.lit("0.7").cast("decimal(2,1)"))
        pantry = F.col("p_type") == "SMALL"
        priority = F.col("o_orderpriority")
        return wide.select(
            day.alias("delivery_day"),
            week_start(day).alias("delivery_week"),
            month_start(day).alias("delivery_month"),
            F.col("o_orderdate").cast("date").alias("order_day"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("order_create_time"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("buyer_id"),
            F.col("l_partkey").alias("product_id"),
            (F.col("o_orderkey") * 10 + F.col("l_suppkey") % 3).alias("group_invoice_id"),
            region.alias("sales_region_id"),
            region.alias("sales_org_id"),
            title_of(region.cast("int"), REGION_TITLES).alias("sales_region_title"),
            F.when(pantry, "pantry").otherwise("normal").alias("biz_type"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "restaurant")
            .when(F.col("c_mktsegment") == "BUILDING", "alcohol")
            .otherwise("grocery")
            .alias("order_biz_type"),
            F.when(F.col("o_orderstatus") == "P", "P").otherwise("F").alias("payment_mode"),
            pick(INVENTORY_LIST, F.col("l_suppkey") % 7).alias("inventory_title"),
            pick(STORAGE_LIST, F.col("p_size") % 3).alias("storage_type"),
            pick(DIVISION_LIST, brand % 6).alias("division"),
            F.col("r_name").alias("ethnicity_user"),
            F.when(priority == "1-URGENT", "sign_up_coupon")
            .when(priority == "2-HIGH", "second_order_coupon")
            .when(priority == "3-MEDIUM", "order_share_sign_up_coupon")
            .otherwise("")
            .alias("coupon"),
            pick(["sale", "lightening", "normal"], F.col("l_linenumber") % 3).alias("price_type"),
            F.when(F.col("l_linenumber") % 2 != 0, "Vendor funded").alias("discount_reason"),
            F.when(pantry, "pantry").otherwise("fresh").alias("mail_type"),
            F.when(priority == "1-URGENT", 1).otherwise(0).alias("daily_new_users_flag"),
            is_gm.alias("is_gm"),
            dec(sub_total).alias("sub_total"),
            dec(refund).alias("product_refund_amount"),
            dec(F.col("o_orderkey") % 7).alias("discount"),
            cost.alias("gm_cost"),
            dec(base - cost * is_gm).alias("gm_margin"),
            base.alias("gm_base"),
            dec("p_retailprice", "decimal(18,2)").alias("product_base_price"),
            dec(unit_cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).alias(
                "product_price"
            ),
            qty.alias("quantity"),
            # not part of the contract; other stand-ins are built from these
            F.col("l_linenumber").alias("line_number"),
            F.col("l_returnflag").alias("return_flag"),
            brand.alias("brand"),
        )

    @cached_property
    def events(self) -> DataFrame:
        """Event log moved back so that it covers the year before ``AS_OF``."""
        back = F.make_interval(days=(F.lit(8700) + F.lit(30) * (F.col("user_id") % 13)).cast("int"))
        return self.raw("events").withColumn("ts", (F.col("ts") - back).cast("timestamp_ntz"))

    @cached_property
    def order_rows(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        delivered = F.date_add(day, (F.col("o_orderkey") % 5).cast("int"))
        priority = F.col("o_orderpriority")
        return self._sold.select(
            day.alias("order_day"),
            week_start(day).alias("order_week"),
            month_start(day).alias("order_month"),
            delivered.alias("delivery_day"),
            week_start(delivered).alias("delivery_week"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("buyer_id"),
            pick(REGION_IDS, F.col("c_nationkey") % 9).cast("bigint").alias("sales_org_id"),
            pick(["APP iOS", "APP Android", "PC"], F.col("c_custkey") % 3).alias("device_type"),
            pick(["zh", "zh-Hant", "en", "es"], F.col("c_custkey") % 4).alias("language"),
            F.when(F.col("o_orderstatus") == "P", "P").otherwise("F").alias("payment_mode"),
            F.when(priority == "1-URGENT", "sign_up_coupon")
            .when(priority == "2-HIGH", "second_order_coupon")
            .when(priority == "3-MEDIUM", "order_share_sign_up_coupon")
            .otherwise("")
            .alias("coupon"),
            F.when(priority == "1-URGENT", 1).otherwise(0).alias("daily_new_users_flag_order"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), 1)
            .otherwise(0)
            .alias("daily_new_users_flag"),
            dec(F.col("o_orderkey") % 7).alias("discount"),
            dec("o_totalprice", "decimal(18,2)").alias("total"),
        )

    # --- sheets, as people would have typed them -------------------------------

    @cached_property
    def _rates(self) -> DataFrame:
        """Cost rates in basis points per month and region (999: all), from whole cents."""
        parts = {
            "gross": F.col("sub_total"),
            "inbound": F.col("product_refund_amount"),
            "wh_labor": F.when(F.col("is_gm") == 0, F.col("sub_total")).otherwise(F.lit(0)),
            "packaging": F.col("discount") * 100,
            "processing": F.col("quantity").cast("decimal(10,0)") * 10,
            "wh": F.col("quantity").cast("decimal(10,0)") * 20,
            "ops": F.col("product_price") * F.lit("0.5").cast("decimal(2,1)"),
            "misc": F.col("discount") * 50,
        }
        own = F.struct(F.col("sales_region_id").alias("region_id"))
        total = F.struct(F.lit(999).cast("bigint").alias("region_id"))
        sums = (
            self.order_product.filter(F.col("delivery_month") < F.lit(REPORTED_BEFORE))
            .groupBy("delivery_month", "sales_region_id")
            .agg(*(F.sum((c * 10000).cast("decimal(38,0)")).alias(n) for n, c in parts.items()))
            .select("delivery_month", *parts, F.inline(F.array(own, total)))
            .groupBy("delivery_month", "region_id")
            .agg(*(F.sum(n).alias(n) for n in parts))
        )

        def points(n: str) -> Column:
            bp = F.call_function("div", F.col(n) * 10000, F.col("gross")).cast("decimal(10,0)")
            pct = dec(bp * F.lit("0.0001").cast("decimal(5,4)"), "decimal(10,4)")
            return (-pct if n in ("inbound", "packaging") else pct).cast("string")

        title = F.coalesce(
            title_of(F.col("region_id").cast("int"), SHEET_TITLES), F.lit("Total")
        )
        gross = (F.col("gross") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(28,2)")
        return sums.select(
            "delivery_month",
            "region_id",
            title.alias("sales_region_title"),
            gross.alias("gross"),
            *(points(n).alias(f"{n}_pct") for n in parts if n != "gross"),
        )

    @cached_property
    def monthly_actual_pl(self) -> DataFrame:
        blank = F.col("sales_region_title").isin("Florida", "Pantry")
        gross = F.when(blank, F.lit("")).otherwise(F.col("gross").cast("string"))
        return self._rates.select(
            F.col("delivery_month").cast("string").alias("delivery_month"),
            "sales_region_title",
            gross.alias("gross_rev"),
            *PCTS,
        )

    @cached_property
    def regional_pl(self) -> DataFrame:
        """The nine regional sheets as one: each month's row, under it a row of blanks."""
        month = F.col("delivery_month")
        label = F.concat(F.date_format(month, "MMM"), F.lit("'"), F.date_format(month, "yy"))
        lines = F.array(
            F.struct(label.alias("delivery_month"), *(F.col(c).alias(c) for c in PCTS)),
            F.struct(F.lit("YTD").alias("delivery_month"), *(F.lit("").alias(c) for c in PCTS)),
        )
        return self._rates.select("region_id", "sales_region_title", F.inline(lines))

    def regional_sheet(self, region_id: int) -> DataFrame:
        return self.regional_pl.filter(F.col("region_id") == region_id)

    def _labor_pct(self, inventory: str, region_id: int) -> DataFrame:
        rows = self.order_product.filter(F.col("inventory_title") == inventory)
        cents = F.sum((F.col("sub_total") * 100).cast("decimal(38,0)"))
        oos = F.sum(F.when(F.col("is_gm") == 0, (F.col("sub_total") * 100).cast("decimal(38,0)")).otherwise(F.lit(0)))
        bp = F.call_function("div", oos * 10000, cents).cast("decimal(10,0)")
        pct = dec(bp * F.lit("0.0001").cast("decimal(5,4)"), "decimal(10,4)").cast("string")
        week = F.col("delivery_week")
        return rows.groupBy(week).agg(pct.alias("_pct")).select(
            week.cast("string").alias("delivery_week"),
            F.lit(region_id).cast("bigint").alias("sales_region_id"),
            F.when(F.dayofmonth(week) > 7, F.col("_pct")).alias("inbound_pct"),
        )

    # --- facts ------------------------------------------------------------------

    @cached_property
    def dispatch_performance(self) -> DataFrame:
        op = self.delivered.filter(
            (F.col("biz_type") == "normal") & ~F.col("sales_region_id").isin(3, 24)
        )
        rid, title = F.col("sales_region_id"), F.col("sales_region_title")
        return op.select(
            F.col("delivery_day").alias("delivery_date"),
            "delivery_week",
            "sales_region_id",
            F.concat(rid.cast("string"), F.lit(" - "), title).alias("sales_region"),
            dec(F.col("sub_total") * F.lit("0.05").cast("decimal(3,2)"), "decimal(18,4)").alias(
                "total_delivery_cost"
            ),
            dec(F.col("sub_total") * F.lit("0.01").cast("decimal(3,2)"), "decimal(18,4)").alias(
                "linehaul_cost"
            ),
            F.when(F.col("order_biz_type") == "restaurant", "restaurant")
            .otherwise("grocery")
            .alias("delivery_plan_type"),
            F.when(F.col("return_flag") == "R", "N").otherwise("Y").alias("tms_on_time_flag"),
            F.col("group_invoice_id").alias("invoice_id"),
        )

    @cached_property
    def mail_order_shipment(self) -> DataFrame:
        return self.order_product.filter(F.col("biz_type") == "pantry").select(
            F.col("delivery_day").cast("string").alias("deal_delivery_date"),
            F.col("order_id").alias("wms_order_id"),
            dec(F.col("sub_total") * F.lit("0.02").cast("decimal(3,2)")).alias("rate"),
        )

    @cached_property
    def labor_cost_detail(self) -> DataFrame:
        inventory, line = F.col("inventory_title"), F.col("line_number")
        return self.order_product.select(
            F.col("delivery_day").alias("entry_date"),
            F.col("delivery_week").alias("entry_week"),
            F.when(line == 6, "LA - Greater")
            .when(line == 7, "check")
            .when(inventory == "NJ - New York", "NJ - Edison")
            .otherwise(inventory)
            .alias("warehouse"),
            F.when(F.col("division") == "Dry Grocery", "OP - Dry")
            .when(F.col("division") == "Frozen", "Mail Order - Outbound")
            .when(F.col("division") == "Produce", "OP - DC")
            .otherwise("OP - Pick")
            .alias("department_name"),
            F.when(F.col("brand") == 25, "Y").otherwise("N").alias("filter_flag"),
            dec(F.col("sub_total") * F.lit("0.1").cast("decimal(2,1)")).alias("labor_cost"),
        )

    @cached_property
    def product_price(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            (key + 500).alias("id"), key.alias("product_id"), (1 + key % 4).alias("sales_org_id")
        )

    @cached_property
    def product_price_special(self) -> DataFrame:
        key = F.col("p_partkey")
        start = F.lit(SPECIALS_START) + (key % 90) * DAY_SECONDS
        first = self.raw("part").select(
            (key + 500).alias("product_price_id"),
            start.alias("start_time"),
            (start + 60 * DAY_SECONDS).alias("end_time"),
            pick(REASONS, key % 7).alias("reason"),
        )
        overlapping = self.raw("part").filter(key % 5 == 0).select(
            (key + 500).alias("product_price_id"),
            (start + 10 * DAY_SECONDS).alias("start_time"),
            (start + 40 * DAY_SECONDS).alias("end_time"),
            pick(REASONS, (key + 1) % 7).alias("reason"),
        )
        return first.unionByName(overlapping)

    @cached_property
    def sales_org_price_region(self) -> DataFrame:
        org = pick(REGION_IDS, F.col("c_nationkey") % 9).cast("bigint")
        orgs = self.raw("customer").select(org.alias("sales_org_id")).distinct()
        return orgs.select("sales_org_id", (1 + F.col("sales_org_id") % 4).alias("price_region_id"))

    @cached_property
    def revenue_main(self) -> DataFrame:
        new_coupon = F.col("coupon").isin("sign_up_coupon", "second_order_coupon")
        shipped = F.col("product_refund_amount") * F.col("is_gm")
        return self.delivered.select(
            "delivery_week",
            "delivery_month",
            "delivery_day",
            "discount",
            dec(F.col("quantity") % 5).alias("expense_pct"),
            F.col("sub_total").alias("revenue"),
            dec(F.col("sub_total") - F.col("product_refund_amount")).alias("net_revenue"),
            dec(F.when(new_coupon, F.col("discount")).otherwise(F.lit(0))).alias("new_user_coupon"),
            dec(F.when(F.col("is_gm") == 0, F.col("sub_total")).otherwise(F.lit(0))).alias("oos"),
            dec(shipped).alias("shipped_and_refunded"),
            dec(F.col("discount") * 2).alias("total_discount"),
        )

    @cached_property
    def sessions_details(self) -> DataFrame:
        day = F.col("ts").cast("date")
        return self.events.select(
            day.alias("sess_date"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("orders"),
            F.concat(F.col("user_id").cast("string"), F.lit("/"), day.cast("string")).alias(
                "session_id"
            ),
        )

    @cached_property
    def survey_response(self) -> DataFrame:
        titles = [REGION_TITLES[i] for i in REGION_IDS]
        titles[2] = "MAIL ORDER - WEST"
        return self.events.select(
            F.col("ts").cast("date").alias("response_date"),
            F.col("event_id").alias("response_id"),
            F.when(F.col("event_type") == "error", 2).otherwise(1).alias("question_id"),
            F.when(F.col("value") > 60, 1).otherwise(0).alias("promoter_flag"),
            F.when(F.col("value") < 10, 1).otherwise(0).alias("detractor_flag"),
            pick(titles, F.col("user_id") % 9).alias("response_region"),
        )

    @cached_property
    def perfect_order(self) -> DataFrame:
        bad = (F.col("is_gm") == 0) | (F.col("return_flag") == "R")
        return self.delivered.select(
            "delivery_day",
            F.concat(
                F.col("sales_region_id").cast("string"), F.lit(" - "), F.col("sales_region_title")
            ).alias("region"),
            F.when(F.col("order_biz_type") == "restaurant", "restaurant")
            .otherwise("grocery")
            .alias("delivery_type"),
            F.when(bad, 1).otherwise(0).cast("bigint").alias("not_perfect_orders"),
            F.lit(1).cast("bigint").alias("total_orders"),
        )

    @cached_property
    def mkt_ltv(self) -> DataFrame:
        mail = F.col("sales_org_id").isin(3, 16)
        return self.order_rows.select(
            F.when(F.col("device_type") == "APP iOS", "iOS")
            .when(F.col("device_type") == "APP Android", "Android")
            .otherwise("Web")
            .alias("device"),
            F.when(F.col("language").isin("zh", "zh-Hant"), "Chinese")
            .when(F.col("language") == "en", "English")
            .otherwise("OTHER")
            .alias("language"),
            F.when(mail, "Mail").otherwise("Local").alias("region"),
            (1 + F.col("order_id") % 8).cast("int").alias("wd"),
            F.col("total").alias("revenue"),
            F.lit(1).cast("bigint").alias("cohort_buyers"),
            F.col("order_week").alias("start_week"),
        )

    @cached_property
    def marketing_spend(self) -> DataFrame:
        kind = F.col("event_type")
        return self.events.select(
            F.col("ts").cast("date").alias("date"),
            F.when(kind == "error", "Branding-X").otherwise(kind).alias("channel"),
            dec("value", "decimal(18,2)").alias("cost"),
        )

    @cached_property
    def coupon_use(self) -> DataFrame:
        """Every order uses a code; each tenth order uses it twice."""
        o = self.raw("orders")
        times = F.when(F.col("o_orderkey") % 10 == 0, 2).otherwise(1)
        code = F.concat(F.lit("C"), (F.col("o_custkey") % 50).cast("string"))
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            code.alias("code"),
            F.explode(F.sequence(F.lit(1), times)).alias("n"),
        ).drop("n")

    @cached_property
    def coupon_code(self) -> DataFrame:
        code = F.concat(F.lit("C"), (F.col("c_custkey") % 50).cast("string"))
        return self.raw("customer").select(code.alias("code")).distinct()

    @cached_property
    def order_discount(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("order_id"),
            F.when(F.col("o_orderstatus") == "O", "points").otherwise("coupon").alias("type"),
            dec(key % 7).alias("amount"),
        )

    @cached_property
    def user_points(self) -> DataFrame:
        return self.events.select(
            F.col("ts").alias("rec_create_time"),
            (F.floor(F.col("value")) * 5).cast("bigint").alias("points"),
            F.when(F.col("event_type") == "signup", "p_user_referral")
            .otherwise("p_other")
            .alias("type"),
        )

    @cached_property
    def mkt_other_spend(self) -> DataFrame:
        total = F.sum("total")

        def part(rate: str) -> Column:
            return dec(total * F.lit(rate).cast("decimal(5,4)"))

        return self.order_rows.groupBy(F.col("order_month").alias("month")).agg(
            part("0.0013").alias("content_marketing_spend"),
            part("0.0020").alias("salary_cost"),
            part("0.0005").alias("agency_fee"),
            part("0.0004").alias("contractor_fee"),
            part("0.0003").alias("tools_cost"),
            part("0.0002").alias("es_ethnic_cost"),
            part("0.0001").alias("ja_ethnic_cost"),
            F.lit(None).cast("decimal(18,4)").alias("ko_ethnic_cost"),
            part("0.0001").alias("vi_ethnic_cost"),
        )

    @cached_property
    def restaurant_order(self) -> DataFrame:
        kinds = ["RTG", "OD", "Partner", "Partner_vip", "RTG", "OD", "Other"]
        return self.delivered.select(
            "delivery_day",
            "order_day",
            pick(kinds, F.col("line_number") - 1).alias("order_type"),
            F.col("sub_total").alias("order_total"),
            F.col("gm_margin").alias("cm_margin"),
            F.col("gm_base").alias("cm_base"),
        )

    @cached_property
    def plan_data(self) -> DataFrame:
        """Plan of each period: a little above what happened."""
        day = F.col("delivery_day")
        keys = F.array(
            F.struct(F.lit("week").alias("unit_type"), week_start(day).alias("unit")),
            F.struct(F.lit("month").alias("unit_type"), month_start(day).alias("unit")),
            F.struct(F.lit("quarter").alias("unit_type"), quarter_start(day).alias("unit")),
        )
        daily = self.order_product.groupBy("delivery_day").agg(
            F.sum("sub_total").alias("gross"),
            F.sum("gm_margin").alias("gm"),
            F.sum("daily_new_users_flag").alias("new"),
            F.count("*").alias("lines"),
            F.sum("quantity").alias("qty"),
        )
        rows = daily.select(F.inline(keys), "gross", "gm", "new", "lines", "qty")
        gross = F.sum("gross")
        up = F.lit("1.1").cast("decimal(2,1)")
        return rows.groupBy("unit_type", "unit").agg(
            dec(gross * up).alias("gross_rev_plan"),
            dec(gross).alias("net_rev_plan"),
            dec(F.sum("gm")).alias("gm_plan"),
            F.sum("new").alias("new_users"),
            F.sum("lines").alias("active_users"),
            dec(F.sum("qty")).alias("arpu_plan"),
        ).select(
            F.col("unit").cast("string").alias("delivery_unit"), "unit_type", "gross_rev_plan",
            "net_rev_plan", "gm_plan", "new_users", "active_users", "arpu_plan",
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Days from the first to the last delivery in the data."""
        day = F.col("l_shipdate").cast("date")
        bounds = self.raw("lineitem").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        return calendar(bounds, "lo", "hi")

    @cached_property
    def division_plan(self) -> DataFrame:
        """Margin per division and month, from lines and parts alone."""
        sold = self.raw("lineitem").join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        missing = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
        margin = F.when(missing, F.lit(0)).otherwise(price - price * F.lit("0.7").cast("decimal(2,1)"))
        brand = F.substring_index("p_brand", "#", -1).cast("int")
        rows = sold.select(
            month_start(F.col("l_shipdate").cast("date")).alias("month"),
            pick(DIVISION_LIST, brand % 6).alias("division"),
            margin.alias("margin"),
        )

        def plan(title: str) -> Column:
            return dec(F.sum(F.when(F.col("division") == title, F.col("margin")).otherwise(F.lit(0))))

        months = rows.groupBy("month").agg(
            plan("Dairy/Deli").alias("dairy_deli"),
            plan("Protein").alias("protein"),
            plan("Frozen").alias("frozen"),
            plan("Produce").alias("produce"),
            plan("Dry Grocery").alias("dry_grocery"),
            plan("GM & HBC").alias("gm_hbc"),
        ).select(
            F.col("month").cast("string").alias("delivery_month"), "dairy_deli", "protein", "frozen",
            "produce", "dry_grocery", "gm_hbc",
        )
        return months if self.window is None else months.persist(StorageLevel.DISK_ONLY)  # read more than once

    @cached_property
    def order_case_details(self) -> DataFrame:
        returned, line = F.col("return_flag") == "R", F.col("line_number")
        return self.delivered.select(
            "delivery_day",
            "order_day",
            "inventory_title",
            "group_invoice_id",
            F.when(returned & (line % 2 == 1), F.col("order_id")).alias("order_case_id_np"),
            F.when(returned & (line == 4), F.col("order_id")).alias("order_case_id_p"),
        )

    @cached_property
    def sku_params_snapshot(self) -> DataFrame:
        key = F.col("p_partkey")
        site = pick(SITE_LIST, key % 3)
        return self.raw("part").select(
            F.date_sub(F.lit(date(2000, 4, 8)), (key % 420).cast("int")).alias("date"),
            pick(STORAGE_LIST, F.col("p_size") % 3).alias("storage_type"),
            F.when(F.col("p_type") == "LARGE", F.concat(site, F.lit("_wh_annex")))
            .otherwise(F.concat(site, F.lit("_wh")))
            .alias("title"),
            F.when(F.col("p_type") == "PROMO", "Y").otherwise("-").alias("is_food"),
            F.lit("-").alias("is_protein"),
            F.lit("-").alias("is_produce"),
            F.when(F.col("p_brand") == "Brand#9", "x").otherwise("-").alias("ethnicity"),
            F.col("p_size").alias("max_sku_count"),
        )

    @cached_property
    def in_stock_rate(self) -> DataFrame:
        return self.order_product.select(
            "order_day",
            "storage_type",
            "sales_region_title",
            F.concat(F.lpad(F.col("brand").cast("string"), 2, "0"), F.lit("-x")).alias("department"),
            F.when(F.col("line_number") == 7, "I").otherwise("A").alias("sku_region_status"),
            F.col("is_gm").alias("sku_availability"),
            "product_id",
        )

    def tables(self) -> Tables:
        names = (
            "order_product monthly_actual_pl dispatch_performance mail_order_shipment "
            "labor_cost_detail product_price product_price_special sales_org_price_region "
            "revenue_main sessions_details survey_response perfect_order mkt_ltv "
            "marketing_spend coupon_use coupon_code order_discount user_points mkt_other_spend "
            "restaurant_order plan_data calendar division_plan order_case_details "
            "sku_params_snapshot in_stock_rate regional_pl"
        ).split()
        openers = {n: (lambda n=n: getattr(self, n)) for n in names}
        openers["order_product"] = lambda: self.delivered
        openers["orders"] = lambda: self.order_rows
        openers["nj_labor"] = lambda: self._labor_pct("NJ - New York", 7)
        openers["chi_labor"] = lambda: self._labor_pct("IL - Chicago", 15)
        for sheet, region in {
            "ba_pl": 1, "la_pl": 2, "mo_pl": 3, "sea_pl": 4, "nj_pl": 7, "tx_pl": 10,
            "chi_pl": 15, "fl_pl": 23, "groc_pl": 999,
        }.items():
            openers[sheet] = lambda region=region: self.regional_sheet(region)
        return Tables(openers)


_opened: dict[tuple[str, str, PeriodWindow | None], Tables] = {}


def tables(spark: SparkSession, sf_dir: str, window: PeriodWindow | None = None) -> Tables:
    """Stand-in tables of a folder; their (lazy) plans are built once per session.

    See :class:`StandIns` for ``window``.
    """
    key = (f"{spark.sparkContext.applicationId}/{id(spark)}", sf_dir, window)
    if key not in _opened:
        _opened[key] = StandIns(spark, sf_dir, window).tables()
    return _opened[key]
