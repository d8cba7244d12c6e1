"""What must hold for large inputs: one shuffle, one scan, pruned scans, reruns and rejects."""

from __future__ import annotations

import random
import re
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks import compare
from checks import standins as st
from checks.scorecard import review
from periodbook import dimensions as dim
from periodbook.functions import periods as pd
from periodbook.operators import joins as jn
from periodbook.operators.distincts import distinct_counts
from periodbook.operators.sets import append_comparison
from periodbook.plans import acquisition, delivery, labor, scorecard, weekly
from periodbook.sources.sheets import SheetSpec, parse_sheet, split_rejects
from periodbook.sources.sinks import write_report
from periodbook.sources.tables import Tables
from tests.test_plans import plan, scans, widest_expand


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": -1, "spark__sql__adaptive__autoBroadcastJoinThreshold": -1}
HOUR = timedelta(hours=1)
START = datetime(2000, 1, 1)


# --- specials as an interval map ------------------------------------------------------------


@pytest.mark.parametrize("name", ["promo_funding", "promo_funding_corrected", "interval_join", "interval_join_by_day", "returns_by_region"])
def test_price_reasons_without_broadcast(spark, duck, sf_dir, name):
    with settings(spark, **NO_BROADCAST):
        df = driver.queries()[name](spark, sf_dir)
        assert "BroadcastHashJoin" not in plan(df)
        assert compare.differences(df, duck, driver.oracle_sql()[name]) == []


def test_lines_meet_the_specials_in_one_join(spark):
    lines = spark.createDataFrame([], "order_id bigint, product_id bigint, sales_org_id bigint, order_create_time timestamp_ntz, discount_reason string, mail_type string")
    regions = spark.createDataFrame([], "sales_org_id bigint, price_region_id bigint")
    windows = spark.createDataFrame([], "product_id bigint, sales_org_id bigint, reason string, start_time_extended timestamp_ntz, end_time_extended timestamp_ntz")
    lines = lines.repartition(3)  # its rows are no constants
    with settings(spark, **NO_BROADCAST):
        text = scorecard.with_price_reason(lines, regions, windows)._jdf.queryExecution().optimizedPlan().toString()
    # one join below the lines, one of specials with price regions
    assert len(re.findall(r"Join LeftOuter", text)) == 2 and text.index("Join LeftOuter") < text.index("Repartition 3")


def test_price_reasons_against_brute_force(spark):
    rng = random.Random(3)
    windows = {
        (rng.randrange(3), rng.choice([1, 2, 3, 16]), f"r{rng.randrange(4)}", a, a + rng.choice([0, 1, 5, 60]) * HOUR)
        for a in (START + rng.randrange(200) * HOUR for _ in range(150))
    } | {(0, None, "lost", START, START + 90 * HOUR), (1, 16, None, START, START + 300 * HOUR)}
    lines = [
        (i, rng.choice([0, 1, 2, 9, None]), rng.choice([1, 2, 15, 7, None]), rng.choice([None, START + rng.randrange(260) * HOUR]),
         rng.choice([None, None, None, "own", ""]), rng.choice(["pantry", "other", None]))
        for i in range(400)
    ]
    regions = [(1, 1), (2, 2), (15, 3), (7, None)]
    want = []
    for i, product, org, at, reason, mail in lines:
        hits = [w for w in windows if at and w[0] == product and w[3] <= at < w[4]] if reason is None else []
        own = [w[2] for w in hits if w[1] is not None and w[1] == dict(regions).get(org)] or [None]
        pantry = [w[2] for w in hits if w[1] == (16 if org == 15 else None) and w[1] is not None and mail == "pantry"] or [None]
        for d in own:
            for p in pantry:
                want.append((i, next((x for x in (reason, d, p) if x is not None), None)))
    frame = spark.createDataFrame(lines, "order_id bigint, product_id bigint, sales_org_id bigint, order_create_time timestamp_ntz, discount_reason string, mail_type string")
    got = scorecard.with_price_reason(
        frame, spark.createDataFrame(regions, "sales_org_id bigint, price_region_id bigint"),
        spark.createDataFrame(list(windows), "product_id bigint, sales_org_id bigint, reason string, start_time_extended timestamp_ntz, end_time_extended timestamp_ntz"),
    )
    assert got.columns == [*frame.columns, "promo_reason"]
    key = lambda r: (r[0], r[1] is None, r[1] or "")
    assert sorted(((r.order_id, r.promo_reason) for r in got.collect()), key=key) == sorted(want, key=key)


def test_binary_search_finds_what_covers(spark):
    rng = random.Random(4)
    spans = [(a, a + rng.randrange(1, 40)) for a in (rng.randrange(100) for _ in range(57))]
    stamp = lambda n: START + n * HOUR
    intervals = spark.createDataFrame([(7, stamp(a), stamp(b), f"{a}-{b}-{k}") for k, (a, b) in enumerate(spans)], "p bigint, a timestamp_ntz, b timestamp_ntz, name string")
    events = spark.createDataFrame([(stamp(n),) for n in range(-5, 150)], "at timestamp_ntz")
    days = jn.interval_map(intervals, "p", "a", "b", ["name"])
    met = events.join(days, F.col("at").cast("date") == F.col("_day"), "left")
    got = {r.at: sorted(r.names or []) for r in met.select("at", F.transform(jn.covering(F.col("_spans"), F.col("at")), lambda s: s["name"]).alias("names")).collect()}
    assert got == {stamp(n): sorted(f"{a}-{b}-{k}" for k, (a, b) in enumerate(spans) if a <= n < b) for n in range(-5, 150)}


# --- one pass ---------------------------------------------------------------------------------


@pytest.mark.parametrize("build", [weekly.rate_costs, weekly.net_revenue])
def test_weekly_costs_compute_the_order_grain_once(tables, build):
    df = build(tables, st.AS_OF) if build is weekly.net_revenue else build(tables, st.AS_OF, ("regional_pl",))
    text = plan(df)
    assert text.count("group_invoice_id") and len(re.findall(r"HashAggregate\(keys=\[delivery_week#\d+, sales_region_id#\d+[^\]]*, order_id#\d+L?, buyer_id", text)) == 2  # partial and final


def test_windowed_rate_costs_are_the_card_s(spark, tables):
    from periodbook.plans import rates

    sales, reported = weekly.net_revenue(tables, st.AS_OF), rates.reported_rates_ranked([tables["regional_pl"]])
    window = pd.trailing(st.AS_OF, "week", weekly.WEEKS_SHOWN)
    literal = rates.weekly_rate_costs(sales, rates.rate_card(reported, sales, st.AS_OF), st.AS_OF, window)
    once = rates.windowed_rate_costs(sales, reported, st.AS_OF, window)
    assert once.columns == literal.columns and sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, literal.collect()), key=str)
    # regions without a sheet, and months without weeks
    for other in (reported.filter("region_id = 1"), reported.limit(0)):
        a = rates.weekly_rate_costs(sales, rates.rate_card(other, sales, st.AS_OF), st.AS_OF, window)
        b = rates.windowed_rate_costs(sales, other, st.AS_OF, window)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("table", ["dry_revenue_share", "nondry_revenue_share", "cutover_share", "mail_order_share", "weekly_la_share", "weekly_mail_order_share"])
def test_share_tables_are_one_shuffle_of_sums_by_period(tables, table):
    text = plan(getattr(labor, table)(tables["order_product"], st.AS_OF))
    assert "Window" not in text and "Join" not in text.split("HashAggregate")[0]
    assert len(re.findall(r"HashAggregate\(keys=\[(?:delivery_day|delivery_week)#\d+\]", text)) == 2  # partial and final


def test_allocation_reads_what_the_share_tables_hold(tables):
    lines = tables["order_product"]
    rows = {r.entry_date: r for r in labor.daily_share_row(lines, st.AS_OF, st.CUTOVER).collect()}
    shares = labor.cutover_share(lines, st.AS_OF, st.CUTOVER).collect()
    assert shares and {r.sales_region_id for r in shares} <= {dim.BAY_AREA, dim.LOS_ANGELES, dim.MAIL_ORDER}
    for r in shares:
        if r.sales_region_id == dim.BAY_AREA:
            assert (rows[r.delivery_day]["_bay_pct"], rows[r.delivery_day]["_bay_nondry_pct"]) == (r.dry_rev_pct, r.nondry_rev_pct)
        if r.sales_region_id == dim.MAIL_ORDER:
            assert rows[r.delivery_day]["_mo_pct"] == r.dry_rev_pct
    weeks = {r.entry_week: r for r in labor.weekly_share_row(lines, st.AS_OF, st.CUTOVER).collect()}
    held = {(r.delivery_week, r.sales_region_id): r.rev_pct for r in labor.weekly_la_share(lines, st.AS_OF, st.CUTOVER).collect()}
    for week, r in weeks.items():
        assert (r["_bay_pct"], r["_mo_pct"]) == (held.get((week, dim.BAY_AREA)), held.get((week, dim.MAIL_ORDER)))


@pytest.mark.parametrize("part, fact", [("division_scorecard", "lineitem"), ("nps_by_region", "events")])
def test_sums_and_distinct_counts_share_a_scan(tables, part, fact):
    text = plan(getattr(scorecard, part)(tables, review("week")))
    assert len(re.findall(rf"FileScan parquet.*{fact}", text)) == 1 and widest_expand(text) <= 1


def test_sums_ride_along_with_distinct_counts(spark):
    rows = [("a", 1, 7, Decimal("1.50")), ("a", 1, 8, None), ("a", None, 8, Decimal("2.00")), ("b", 2, None, None), ("b", 2, None, None), (None, 3, 9, Decimal("4.00"))]
    df = spark.createDataFrame(rows, "k string, buyer bigint, ord bigint, v decimal(18,4)")
    got = distinct_counts(df, ["k"], {"buyer": {"buyers": None, "big": F.col("v") > 1}, "ord": {"orders": None}}, {"total": F.col("v"), "n": F.lit(1)})
    assert {tuple(r) for r in got.select("k", "buyers", "big", "orders", "total", "n").collect()} == {
        ("a", 1, 1, 2, Decimal("3.5000"), 3), ("b", 1, 0, 0, None, 2), (None, 1, 1, 1, Decimal("4.0000"), 1)
    }
    assert got.schema["total"].dataType == df.agg(F.sum("v").alias("v")).schema["v"].dataType
    assert distinct_counts(df.limit(0), ["k"], {"buyer": {"buyers": None}}, {"total": F.col("v")}).count() == 0


def test_coupon_amounts_are_filtered_before_they_are_grouped(spark, tmp_path):
    ids = spark.range(20_000)
    day = F.lit(date(2021, 1, 3))
    orders = ids.select(
        F.col("id").alias("order_id"), *(day.alias(c) for c in ("order_day", "order_week", "delivery_day", "delivery_week")),
        F.lit("F").alias("payment_mode"), F.lit(1).cast("decimal(18,4)").alias("discount"), F.when(F.col("id") % 1000 == 0, "SIGNUP").otherwise("x").alias("coupon"),
    )
    from periodbook import dimensions as dim

    orders = orders.withColumn("coupon", F.when(F.col("coupon") == "SIGNUP", F.lit(dim.SIGN_UP_COUPONS[0])).otherwise("x"))
    frames = {
        "orders": orders, "use": ids.select(F.col("id").alias("order_id"), F.lit("c").alias("code")),
        "code": spark.createDataFrame([("c",)], "code string"),
        "disc": ids.select(F.col("id").alias("order_id"), F.lit("coupon").alias("type"), F.lit(2).cast("decimal(18,4)").alias("amount")),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    low = {"spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": 0, "spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold": "1GB"}
    with settings(spark, **NO_BROADCAST, **low):
        got = acquisition.coupon_spend(read("orders"), read("use"), read("code"), read("disc"))
        text = plan(got)
        assert text.count("might_contain") >= 2  # amounts and uses
        assert [tuple(r)[2:] for r in got.collect()] == [(Decimal("40.0000"), Decimal("40.0000"))]


# --- shipments: ranges of text ------------------------------------------------------------------


def shipments(spark, path, days):
    spark.createDataFrame([(d, i, Decimal(1)) for i, d in enumerate(days)], "deal_delivery_date string, wms_order_id bigint, rate decimal(18,4)").write.parquet(path)
    return spark.read.parquet(path)


def test_text_days_are_pruned_in_the_scan(spark, tmp_path):
    window = pd.trailing(st.AS_OF, "month", 1)
    days = [date(1999, 12, 1) + timedelta(days=n) for n in range(200)]
    mail = shipments(spark, f"{tmp_path}/s", [*(d.isoformat() for d in days), "2000-03-31 23:59:00", "", None, "  "])
    dispatch = spark.createDataFrame([], "delivery_date date, sales_region_id bigint, total_delivery_cost decimal(18,4), linehaul_cost decimal(18,4), delivery_plan_type string")
    got = delivery.delivery_cost(dispatch, mail, window, "delivery_month")
    pushed = next(x for x in scans(got).splitlines() if "PushedFilters" in x and "deal_delivery_date" in x)
    assert re.search(r"GreaterThanOrEqual\(deal_delivery_date,2000-03-01\),LessThan\(deal_delivery_date,2000-04-01\)", pushed), pushed
    assert {r.delivery_cost for r in got.collect()} == {Decimal("32.0000")}


@pytest.mark.parametrize("bad", ["2000/03/05", "03-05-2000 x", "March 5", "2000-03-45", "20000399", "?"])
def test_bad_text_days_still_fail(spark, tmp_path, bad):
    mail = shipments(spark, f"{tmp_path}/s", ["2000-03-01", bad])
    dispatch = spark.createDataFrame([], "delivery_date date, sales_region_id bigint, total_delivery_cost decimal(18,4), linehaul_cost decimal(18,4), delivery_plan_type string")
    with pytest.raises(Exception, match="not a date"):
        delivery.delivery_cost(dispatch, mail, pd.trailing(st.AS_OF, "month", 1), "delivery_month").collect()


# --- sheets and reports --------------------------------------------------------------------------


@pytest.mark.parametrize("labels", [False, True])
def test_rejects_are_told_beside_the_rest(spark, labels):
    when = "Mar'00" if labels else "2000-03-01"
    rows = [("1", when, "0.5", "10"), ("2", when, "half", "10"), ("3", when, "half", "10"), ("4", "x'y" if labels else "soon", "n/a", "10"), ("5", when, " ", "10"), ("6", when, None, "10"), ("7", "Total" if labels else when, "bad", "" if not labels else "10")]
    sheet = spark.createDataFrame(rows, "region string, delivery_month string, pct string, gross_rev string")
    spec = SheetSpec(("report_month", "delivery_month"), {"pct": "pct"}, keep=["region"], required=["gross_rev"], month_labels=labels)
    good, rejects = split_rejects(sheet, spec)
    assert good.columns == sheet.columns
    typed = parse_sheet(good, spec).collect()
    assert sorted((r.region, r.report_month, r.pct) for r in typed if r.region in "156") == [("1", date(2000, 3, 1), 0.5), ("5", date(2000, 3, 1), None), ("6", date(2000, 3, 1), None)]
    assert {r.region for r in typed} == {"1", "5", "6"}
    month = "delivery_month: x'y; " if labels else "delivery_month: soon; "
    assert sorted((r.region, r.reason, r.rejects) for r in rejects.collect()) == [("2", "pct: half", 2), ("3", "pct: half", 2), ("4", f"{month}pct: n/a", 1)]
    with pytest.raises(Exception, match="not a"):
        parse_sheet(sheet, spec).collect()


def test_a_rerun_replaces_its_period_only(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = lambda month, *values: spark.createDataFrame([(date(2000, month, 1), v) for v in values], "period date, v bigint")
    stored = lambda: sorted((r.period.month, r.v) for r in spark.read.parquet(path).collect())
    write_report(rows(2, 1, 2), path, ["period"])
    write_report(rows(3, 3, 4), path, ["period"])
    # a run that fails half way leaves what was there
    broken = rows(3, 5, 6, 7, 8).repartition(4).withColumn("v", F.when(F.col("v") == 8, F.raise_error(F.lit("late cell"))).otherwise(F.col("v")).cast("bigint"))
    with pytest.raises(Exception, match="late cell"):
        write_report(broken, path, ["period"])
    assert stored() == [(2, 1), (2, 2), (3, 3), (3, 4)]
    # the retry, and the same retry again
    for _ in range(2):
        write_report(rows(3, 5), path, ["period"])
        assert stored() == [(2, 1), (2, 2), (3, 5)]


def test_nine_sheets_are_one_scan(spark, tmp_path):
    columns = ("region_id bigint, sales_region_title string, delivery_month string, inbound_pct string, wh_labor_pct string, "
               "packaging_pct string, processing_pct string, wh_pct string, ops_pct string, misc_pct string")
    for k, name in enumerate(weekly.SHEETS):
        spark.createDataFrame([(k, name, "Mar'00", *["0.1"] * 7)], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    sheets = Tables.from_dir(spark, str(tmp_path)).stacked(weekly.SHEETS)
    text = plan(sheets)
    assert text.count("FileScan parquet") == 1 and "Union" not in text
    assert sorted(r.region_id for r in sheets.collect()) == list(range(9))
    with pytest.raises(ValueError, match="differ"):
        Tables.from_dir(spark, str(tmp_path)).stacked(["ba_pl", "orders"])


# --- reports of many tables made of the same lines ----------------------------------------------


@pytest.mark.parametrize("name", ["scorecard", "scorecard_report"])
def test_scorecard_joins_the_window_s_lines_once(spark, sf_dir, name):
    """The window's lines and the orders are kept; beside them only the plans and the stock go through every line."""
    text = driver.queries()[name](spark, sf_dir)._jdf.queryExecution().withCachedData().toString()
    assert text.count("InMemoryRelation") > 5
    assert len(re.findall(r"(?<!InMemory)Relation \[[^\]]*l_shipdate", text)) <= 4  # stock, plan, calendar and one more


def test_window_s_tables_hold_its_lines(spark, sf_dir):
    window = review("week").window
    whole, kept = st.tables(spark, sf_dir), st.tables(spark, sf_dir, window)
    for name, day in {"order_product": "delivery_day", "dispatch_performance": "delivery_date", "revenue_main": "delivery_day"}.items():
        want = whole[name].filter(window.holds_day(day))
        assert kept[name].columns == want.columns
        assert kept[name].exceptAll(want).isEmpty() and want.exceptAll(kept[name]).isEmpty()
    for name in ("orders", "plan_data", "in_stock_rate", "division_plan"):
        assert kept[name].exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(kept[name]).isEmpty()


def test_comparison_period_is_computed_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("p"), "o_orderkey")
    both = append_comparison(df, "p", "l", date(1999, 3, 1), date(1999, 1, 1))
    assert plan(both).count("FileScan") == 1
    empty = spark.createDataFrame([(None, 1)], "p date, v int")
    assert list(map(tuple, append_comparison(empty, "p", "l", date(1999, 3, 1), date(1999, 1, 1)).collect())) == [(None, None, 1)]


def test_long_specials_are_listed_by_month(spark):
    spans = [(datetime(1999, 12, 31, 23), datetime(2000, 3, 1)), (datetime(2000, 2, 1), datetime(2000, 2, 1, 1)), (datetime(2000, 2, 5), datetime(2000, 2, 1))]
    intervals = spark.createDataFrame([(7, a, b, str(k)) for k, (a, b) in enumerate(spans)], "p bigint, a timestamp_ntz, b timestamp_ntz, name string")
    months = jn.interval_map(intervals, "p", "a", "b", ["name"], by="month")
    got = {r["_day"]: [s["name"] for s in r["_spans"]] for r in months.collect()}
    assert got == {date(1999, 12, 1): ["0"], date(2000, 1, 1): ["0"], date(2000, 2, 1): ["0", "1"], date(2000, 3, 1): ["0"]}
    with pytest.raises(ValueError):
        jn.interval_map(intervals, "p", "a", "b", ["name"], by="week")


def test_labels_are_read_once_per_day(spark, sf_dir):
    text = plan(driver.queries()["fn_to_date_label"](spark, sf_dir))
    assert re.search(r"HashAggregate\(keys=\[delivery_day#", text)
