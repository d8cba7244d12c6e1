"""Small cases worked out by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from periodbook import dimensions as dim
from periodbook.functions import periods as pd
from periodbook.functions.predicates import bucket_conditions, fold_region, in_buckets, region_bucket
from periodbook.functions.scalars import (
    epoch_to_local,
    month_from_label,
    part_of,
    safe_div,
    utc_to_local,
    whole_div,
)
from periodbook.operators import aggregates as ag
from periodbook.operators import joins as jn
from periodbook.operators import windows as wn
from periodbook.operators.distincts import BITS, distinct_counts
from periodbook.operators.sets import append_comparison
from periodbook.plans import acquisition, labor, scorecard
from periodbook.sources.sheets import SheetSpec, parse_sheet
from periodbook.sources.sinks import write_report
from periodbook.sources.tables import Tables, calendar_between, conform, read_table


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- periods -----------------------------------------------------------------


def test_both_week_spellings_agree_for_ten_years(spark):
    days = calendar_between(spark, date(1995, 1, 1), date(2005, 12, 31))
    assert days.count() == 4018
    assert days.filter(pd.week_start("cal_date") != pd.week_start_by_trunc("cal_date")).isEmpty()
    assert days.filter(F.dayofweek("week_begin_date") != 1).isEmpty()


@pytest.mark.parametrize("unit", pd.UNITS)
def test_driver_dates_agree_with_columns(spark, unit):
    days = calendar_between(spark, date(1999, 12, 20), date(2000, 3, 5))
    for d, key in values(days.select("cal_date", pd.period_key("cal_date", unit).alias("k")), "cal_date", "k"):
        assert pd.floor_date(d, unit) == key


def test_sunday_as_of_differs_between_reports():
    sunday, monday = date(2000, 4, 9), date(2000, 4, 10)
    assert pd.trailing(sunday, "week", 1).hi == date(2000, 4, 2)
    assert pd.scorecard_window(sunday, "week").hi == date(2000, 3, 26)
    assert pd.trailing(monday, "week", 1).hi == pd.scorecard_window(monday, "week").hi == date(2000, 4, 2)


def test_scorecard_bounds():
    w = pd.scorecard_window(date(2000, 4, 10), "month")
    assert (w.lo, w.hi, w.anchor) == (date(1999, 2, 1), date(2000, 3, 1), date(1999, 4, 4))
    assert pd.coarse_day_bound(date(2000, 4, 10), "week") == date(1999, 3, 21)
    assert pd.coarse_day_bound(date(2000, 4, 10), "quarter") == date(1996, 9, 11)


def test_month_window_keeps_exact_days(spark):
    w = pd.scorecard_window(date(2000, 4, 10), "month")
    days = calendar_between(spark, date(1998, 1, 1), date(2001, 1, 1))
    exact = days.filter(w.holds("month_begin_date"))
    assert exact.filter(~w.holds_day("cal_date")).isEmpty()


def test_immature_only_on_the_right_days():
    assert pd.is_immature(date(2000, 4, 10))
    assert not pd.is_immature(date(2000, 4, 9)) and not pd.is_immature(date(2000, 4, 11))
    assert pd.is_immature(date(2000, 4, 11), (8, 9))


def test_cutover_goes_daily_and_back(spark):
    days = calendar_between(spark, date(2000, 3, 12), date(2000, 4, 1))
    keyed = days.withColumn("k", pd.split_cutover("week_begin_date", "cal_date", date(2000, 3, 19)))
    assert keyed.select("k").distinct().count() == 9  # two weeks and seven days
    back = keyed.withColumn("w", pd.reroll_cutover("k", date(2000, 3, 19)))
    assert back.filter(F.col("w") != F.col("week_begin_date")).isEmpty()


# --- scalars -------------------------------------------------------------------


def test_trailing_blank_is_not_significant(spark):
    df = spark.createDataFrame([("LA - La Mirada",), ("a_b",)], "s string")
    assert values(df.select(part_of("s", "-", 1).alias("p")), "p") == [("LA",), ("a_b",)]
    assert values(df.select(part_of("s", "_", 3).alias("p")), "p") == [("",), ("",)]


def test_month_labels(spark):
    df = spark.createDataFrame([("Mar'00",), ("Oct'22",), ("Feb'98",), ("YTD",)], "s string")
    got = {r.s: r.m for r in df.select("s", month_from_label("s").alias("m")).collect()}
    assert got == {"Mar'00": date(2000, 3, 1), "Oct'22": date(2022, 10, 1), "Feb'98": date(1998, 2, 1), "YTD": None}


def test_local_time_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2022, 7, 1), 1656633600)], "t timestamp_ntz, e bigint")
    got = df.select(utc_to_local("t", dim.LOCAL_ZONE).alias("a"), epoch_to_local("e", dim.LOCAL_ZONE).alias("b"))
    assert got.first() == (datetime(2022, 6, 30, 17), datetime(2022, 6, 30, 17))


def test_division_and_whole_division(spark):
    df = spark.createDataFrame([(-350, 0), (350, 7)], "a bigint, b bigint")
    got = values(df.select("a", whole_div("a", 100).alias("w"), safe_div("a", "b").alias("d")), "a", "w", "d")
    assert got == [(-350, -3, None), (350, 3, 50.0)]


# --- classification -------------------------------------------------------------

LINES = "sales_region_id bigint, sales_region_title string, biz_type string"


def test_fold_and_bucket(spark):
    df = spark.createDataFrame(
        [(24, "MOF", "x"), (4, "Seattle", "Pantry-1"), (4, "Seattle", "x"), (4, "Seattle", None), (3, "MAIL ORDER", None)],
        LINES,
    )
    folded = fold_region(df)
    assert values(folded, "sales_region_id") == [(3,), (3,), (3,), (4,), (4,)]
    got = [r.b for r in df.select(region_bucket().alias("b")).collect()]
    assert got == ["mo", "mo", "sea", None, "mo"]
    for b, cond in bucket_conditions().items():
        a = df.filter(cond).count()
        assert a == df.withColumn("bucket", region_bucket()).filter(in_buckets()[b]).count()


# --- aggregates -----------------------------------------------------------------


def test_sum_without_else_is_null(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    got = values(df.groupBy("k").agg(ag.sum_only(F.col("k") == "a", "v").alias("n"), ag.sum_when(F.col("k") == "a", "v").alias("z")), "k", "n", "z")
    assert got == [("a", 1, 1), ("b", None, 0)]


def test_distinct_counts_null_ids_and_many_conditions(spark):
    rows = [(1, i % 7 if i % 5 else None, i) for i in range(40)] + [(2, None, 1)]
    df = spark.createDataFrame(rows, "g int, id bigint, v int")
    spec = {"id": {f"c{i}": F.col("v") >= i for i in range(BITS + 5)} | {"every": None}}
    got = {r.g: r.asDict() for r in distinct_counts(df, ["g"], spec).collect()}
    for i in range(BITS + 5):
        assert got[1][f"c{i}"] == len({a for g, a, v in rows if g == 1 and a is not None and v >= i})
    assert got[1]["every"] == 7 and got[2]["every"] == 0


def test_distinct_counts_equal_literal_form_under_skew(spark):
    # one id holds a third of all rows
    df = spark.range(9000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 701).alias("u"),
        F.concat(F.lit("s"), F.col("id") % 97).alias("s"),
        (F.col("id") % 11).alias("v"),
    )
    spec = {"u": {"u_all": None, "u_hi": F.col("v") > 5}, "s": {"s_all": None, "s_lo": F.col("v") < 2}}
    got = values(distinct_counts(df, ["g"], spec), "g", "u_all", "u_hi", "s_all", "s_lo")
    want = df.groupBy("g").agg(
        F.count_distinct("u").alias("u_all"), F.count_distinct(F.when(F.col("v") > 5, F.col("u"))).alias("u_hi"),
        F.count_distinct("s").alias("s_all"), F.count_distinct(F.when(F.col("v") < 2, F.col("s"))).alias("s_lo"),
    )
    assert got == values(want, "g", "u_all", "u_hi", "s_all", "s_lo")


def test_company_row_counts_a_buyer_once(spark):
    df = spark.createDataFrame([("w", 1, "A", 7), ("w", 2, "B", 7), ("w", 2, "B", 8)], "p string, r bigint, t string, u int")
    got = values(ag.with_company_total(df, {"r": 999, "t": "All"}, ["p", "r", "t"], [F.count_distinct("u").alias("n")]), "r", "t", "n")
    assert got == [(1, "A", 1), (2, "B", 2), (999, "All", 2)]


def test_additive_company_row_keeps_rows_apart(spark):
    df = spark.createDataFrame([("w", 3, 1, "a"), ("w", 3, 2, "b")], "p string, r bigint, v int, kind string")
    got = values(ag.add_company_row(df, "p", "r", ["v"], apart=["kind"]), "r", "v")
    assert got == [(3, 1), (3, 2), (999, 3)]


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("b", 3)], "p string, v int")
    assert {r.s for r in ag.share_of_total(df, "p", "v", "s").collect()} == {None, 0.25, 0.75}


def test_ltv_needs_the_last_week(spark):
    df = spark.createDataFrame([("x", 1, 2.0), ("x", 6, 3.0), ("y", 1, 9.0)], "k string, wd int, v double")
    assert values(ag.lifetime_value(df, ["k"], "wd", "v", 6, 45), "k", "ltv") == [("x", Decimal("140.000000"))]


# --- joins and windows ------------------------------------------------------------


def test_full_outer_null_keys_do_not_match(spark):
    a = spark.createDataFrame([(1, 5), (None, 6)], "k int, x int")
    b = spark.createDataFrame([(None, 7), (2, 8)], "k int, y int")
    assert jn.full_outer_zero(a, b, ["k"], ["x", "y"]).count() == 4


def test_interval_join_edges_and_overlap(spark):
    events = spark.createDataFrame(
        [(1, datetime(2000, 1, 1, 10)), (1, datetime(2000, 1, 3)), (1, datetime(2000, 1, 5)), (2, datetime(2000, 1, 3))],
        "k int, t timestamp_ntz",
    )
    spans = spark.createDataFrame(
        [(1, datetime(2000, 1, 1, 10), datetime(2000, 1, 5), "a"), (1, datetime(2000, 1, 2), datetime(2000, 1, 4), "b"),
         (1, datetime(2000, 1, 9), datetime(2000, 1, 1), "never")],
        "k int, s timestamp_ntz, e timestamp_ntz, why string",
    )
    got = jn.interval_join(events, spans, {"k": "k"}, "t", "s", "e", ["why"])
    assert sorted((r.k, r.t.day, r.why or "") for r in got.collect()) == [
        (1, 1, "a"), (1, 3, "a"), (1, 3, "b"), (1, 5, ""), (2, 3, ""),
    ]


def test_gate_puts_metrics_on_one_segment(spark):
    base = spark.createDataFrame([("w", "A", 1), ("w", "B", 2), ("v", "B", 3)], "p string, seg string, x int")
    extra = spark.createDataFrame([("w", 9), ("v", 8)], "_k string, m int")
    got = values(jn.attach_to_segment(base, "p", "seg", "A", [(extra, "_k")]), "p", "seg", "m")
    assert got == [("v", "B", None), ("w", "A", 9), ("w", "B", None)]


def test_carry_prior_uses_rows_of_the_result_only(spark):
    df = spark.createDataFrame([(1, date(2000, 4, 2), 5, 50), (1, date(2000, 3, 26), 4, 40), (2, date(2000, 4, 2), 7, 70)], "r int, w date, a int, b int")
    got = values(wn.carry_all(df, {"a": "b"}, "r", "w", date(2000, 4, 2)), "r", "w", "a")
    assert got == [(1, date(2000, 3, 26), 40), (1, date(2000, 4, 2), 4), (2, date(2000, 4, 2), None)]


def test_rank_newest_and_latest(spark):
    df = spark.createDataFrame([("x", 3), ("x", 3), ("x", 1), ("y", 2)], "m string, p int")
    assert values(wn.rank_newest(df, "m", "p"), "m", "p", "rn") == [("x", 1, 2), ("x", 3, 1), ("x", 3, 1), ("y", 2, 1)]
    assert values(wn.latest_period(df, "p"), "p") == [(3,), (3,)]


def test_comparison_row_is_appended(spark):
    df = spark.createDataFrame([(date(2000, 3, 1), 1), (date(1999, 3, 1), 2)], "p date, v int")
    got = values(append_comparison(df, "p", "l", date(1999, 3, 1), date(1999, 1, 1)), "l", "p", "v")
    assert got == [(date(1999, 1, 1), date(1999, 3, 1), 2), (date(1999, 3, 1), date(1999, 3, 1), 2), (date(2000, 3, 1), date(2000, 3, 1), 1)]


# --- sheets, tables, sink ------------------------------------------------------------


def test_sheet_text_that_does_not_parse_fails(spark):
    spec = SheetSpec(("d", "m"), {"x": "p"})
    for row in (("2000-03-01", "n/a"), ("03/05/2000", "1")):
        with pytest.raises(Exception, match="not a"):
            parse_sheet(spark.createDataFrame([row], "m string, p string"), spec).collect()
    with pytest.raises(Exception, match="not a date"):
        spark.createDataFrame([("Foo'00",)], "s string").select(month_from_label("s")).collect()


def test_sheet_drops_blank_rows_and_keeps_blank_numbers(spark):
    df = spark.createDataFrame([("2000-03-01", "5", "-0.10"), ("2000-03-01", "", "1"), ("2000-02-01", "1", "")], "m string, g string, p string")
    got = values(parse_sheet(df, SheetSpec(("d", "m"), {"x": "p"}, required=["g"], absolute=True)), "d", "x")
    assert got == [(date(2000, 2, 1), None), (date(2000, 3, 1), 0.1)]


def test_a_folder_table_without_a_column_is_refused(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "coupon_code.parquet"))
    with pytest.raises(ValueError, match="lacks columns"):
        Tables.from_dir(spark, str(tmp_path))["coupon_code"]


def test_restaurant_margin_needs_the_order_types(tables):
    with pytest.raises(ValueError, match="order_types"):
        scorecard.restaurant_margin(tables, scorecard.Review(date(2000, 4, 10), "week"))


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="lacks columns"):
        conform(spark.range(1), "coupon_code")


def test_report_is_written_by_period_and_read_with_its_schema(spark, tmp_path):
    df = spark.createDataFrame([(date(2000, 3, 1), 1), (date(2000, 2, 1), 2)], "m date, v int")
    path = str(tmp_path / "report.parquet")
    write_report(df, path, ["m"])
    write_report(df.filter(F.col("m") == F.lit(date(2000, 3, 1))).withColumn("v", F.lit(5)), path, ["m"])
    back = read_table(spark, str(tmp_path), "report", "v int, m date")
    assert values(back, "m", "v") == [(date(2000, 2, 1), 2), (date(2000, 3, 1), 5)]


def test_tables_open_lazily():
    opened = []
    t = Tables({"calendar": lambda: opened.append(1)})
    assert not opened and "calendar" in t and "orders" not in t
    t["calendar"]
    assert opened == [1]


# --- report rules ----------------------------------------------------------------------


def test_boost_promo_takes_every_line_without_a_reason(spark):
    df = spark.createDataFrame(
        [("normal", None, 1), ("sale", "", 1), ("sale", "Boost Revenue", 1), ("normal", "Boost Revenue", 1), ("sale", "Clearance", 1)],
        "price_type string, promo_reason string, quantity int",
    ).withColumns({"product_base_price": F.lit(3), "product_price": F.lit(2)})
    assert df.agg(*scorecard.promo_measures()).first().boost_rev_promo == 3
    assert df.agg(*scorecard.promo_measures(corrected=True)).first().boost_rev_promo == 2


def _plan_case(spark, unit):
    plan = spark.createDataFrame([(f"2000-0{m}-01", *[Decimal(m * 7)] * 6) for m in (1, 2, 3, 4)],
                                 "delivery_month string, " + ", ".join(f"{c} decimal(18,4)" for c in scorecard.DIVISION_PLANS))
    return Tables({"calendar": lambda: calendar_between(spark, date(1999, 1, 1), date(2001, 1, 1)), "division_plan": lambda: plan})


def test_split_week_blends_with_the_month_before(spark):
    # the week of 2000-03-26 has six days in March and one in April
    t = _plan_case(spark, "week")
    r = scorecard.Review(date(2000, 4, 10), "week")
    got = {x.delivery_unit: x.protein_plan for x in scorecard.split_week_plan(t, r).collect()}
    assert got[date(2000, 3, 26)] == (21 * 6 + 1 * 14) / 7
    assert got[date(2000, 3, 19)] == 21.0
    r = scorecard.Review(date(2000, 4, 10), "week", corrected=True)
    got = {x.delivery_unit: x.protein_plan for x in scorecard.split_week_plan(t, r).collect()}
    assert got[date(2000, 3, 26)] == (21 * 6 + 1 * 28) / 7


def test_labor_is_conserved(tables):
    """What leaves one region arrives at another, on days whose shares are all known."""
    from checks import standins as st
    from periodbook.plans import monthly

    src = tables["labor_cost_detail"]
    final = monthly.labor_final(tables, st.AS_OF, st.CUTOVER)
    known = final.groupBy("entry_date").agg(
        F.sum(F.when(F.col("final_labor_cost").isNull(), 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("mo_outbound").isNull() | F.col("mo_labor").isNull(), 1).otherwise(0)).alias("bad2"),
        F.sum("final_labor_cost").alias("kept"),
        (F.sum("mo_outbound") + F.sum("mo_labor")).alias("mailed"),
        F.max(F.when(F.col("sales_region_id") == 1, 1).otherwise(0)).alias("bay"),
        F.max(F.when(F.col("sales_region_id") == 2, 1).otherwise(0)).alias("la"),
    ).filter("bad = 0 and bad2 = 0 and bay = 1 and la = 1")
    spent = src.filter("filter_flag = 'N' and warehouse <> 'check'").groupBy("entry_date").agg(F.sum("labor_cost").alias("spent"))
    rows = known.join(spent, "entry_date").collect()
    for row in rows:
        assert abs(row.kept + row.mailed - row.spent) < Decimal("0.001")


def test_other_spend_can_be_spread_over_days(spark):
    orders = spark.createDataFrame(
        [(date(2021, 1, 1), date(2021, 1, d), date(2021, 1, 3), "F") for d in (4, 5, 5)],
        "order_month date, order_day date, order_week date, payment_mode string",
    )
    costs = ("content_marketing_spend", "salary_cost", "agency_fee", "contractor_fee", "tools_cost",
             "es_ethnic_cost", "ja_ethnic_cost", "ko_ethnic_cost", "vi_ethnic_cost")
    month = spark.createDataFrame([(date(2021, 1, 1), *[Decimal(10)] * 9)], "month date, " + ", ".join(f"{c} decimal(18,4)" for c in costs))
    spend = spark.createDataFrame([(date(2021, 1, 4), "Branding-A", Decimal(1)), (date(2021, 1, 4), "Search", Decimal(2))], "date date, channel string, cost decimal(18,4)")
    got = values(acquisition.other_spend(orders, month, spend), "time_day_unit", "total_other_spend")
    assert [v for _, v in got] == [Decimal(91), Decimal(90)]
    got = values(acquisition.other_spend(orders, month, spend, corrected=True), "time_day_unit", "total_other_spend")
    assert [v for _, v in got] == [Decimal(46), Decimal(45)]


def test_unlisted_warehouse_has_no_region(spark):
    df = spark.createDataFrame(
        [(date(2000, 3, 1), date(2000, 2, 27), "Depot 9", "OP", "N", Decimal(5)), (date(2000, 3, 1), date(2000, 2, 27), "check", "OP", "N", Decimal(5))],
        "entry_date date, entry_week date, warehouse string, department_name string, filter_flag string, labor_cost decimal(18,4)",
    )
    got = labor.labor_by_warehouse(df, date(2000, 4, 10)).collect()
    assert [(r.sales_region_id, r.total_cost) for r in got] == [(None, Decimal(5))]
