"""Physical plans: what must hold for the reports to run on a large cluster."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from checks import standins as st
from periodbook.plans import monthly, scorecard
from checks.scorecard import review

SCORECARD_PARTS = ("commerce_block", *(m.__name__ for m in scorecard.COMPANY_METRICS))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> str:
    """Plan with the full list of pushed filters per scan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def widest_expand(text: str) -> int:
    """Most row copies any Expand of the plan makes."""
    return max((line.count("], [") + 1 for line in text.splitlines() if "Expand [" in line), default=0)


def test_period_filter_reaches_the_scan(tables):
    text = scans(monthly.order_grain_base(tables, st.AS_OF))
    assert re.search(r"GreaterThanOrEqual\(l_shipdate,2000-03-01", text)
    assert re.search(r"LessThan\(l_shipdate,2000-04-01", text)


def test_weekly_scan_leaves_out_the_weeks_between(tables):
    text = scans(scorecard.division_scorecard(tables, review("week")))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line and "l_shipdate" in line)
    assert re.search(r"Or\(And\(GreaterThanOrEqual\(l_shipdate,1999-04-04[^)]*\),LessThan\(l_shipdate,1999-04-11", pushed), pushed


def test_flagship_scans_the_fact_once(tables):
    text = plan(monthly.net_revenue(tables, st.AS_OF))
    assert len(re.findall(r"FileScan parquet.*lineitem", text)) == 1
    assert widest_expand(text) == 0


@pytest.mark.parametrize("part", SCORECARD_PARTS)
def test_scorecard_parts_do_not_copy_rows_per_distinct(tables, part):
    text = plan(getattr(scorecard, part)(tables, review("week")))
    assert widest_expand(text) <= 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["monthly_pnl", "weekly_pnl", "dense_rank_global", "booking_vs_revenue"])
def test_no_single_task_window_or_cross_join(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # a window without keys shows as an exchange to one partition right below it
    assert not re.search(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", text)
