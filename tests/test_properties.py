"""Properties of the reports on the fixture tables."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def q(spark):
    qs = E.queries()
    return lambda name: qs[name](spark, SMALL)


def test_shares_sum_to_100(q):
    mix = q("channel_payment_mix").agg(F.sum("pct_of_total_revenue"), F.count(F.lit(1))).first()
    assert abs(mix[0] - 100.0) <= 0.005 * mix[1] + 1e-9
    by_month = (q("regional_cumulative").groupBy("order_month")
                .agg(F.sum("pct_of_month_total").alias("s"), F.count(F.lit(1)).alias("n")).collect())
    assert all(abs(r.s - 100.0) <= 0.005 * r.n + 1e-9 for r in by_month)


def test_cumulative_ends_at_region_total(q):
    rc = q("regional_cumulative")
    last = {r.region: r.cumulative_revenue for r in
            rc.groupBy("region").agg(F.max_by("cumulative_revenue", "order_month").alias("cumulative_revenue"))
              .collect()}
    totals = {r.region: r.revenue for r in q("region_totals").collect()}
    assert set(last) == set(totals)
    assert all(abs(last[k] - totals[k]) < 1e-6 for k in totals)


def test_ntile_sizes_differ_by_at_most_one(q):
    sizes = [r["count"] for r in q("customer_value_quartiles").groupBy("value_quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_quartile_one_holds_top_spenders(q):
    cv = q("customer_value_quartiles")
    lo1 = cv.where("value_quartile = 1").agg(F.min("lifetime_value")).first()[0]
    hi2 = cv.where("value_quartile = 2").agg(F.max("lifetime_value")).first()[0]
    assert lo1 >= hi2


def test_payload_cross_foot_on_fixture(q):
    p = json.loads(q("dashboard_payload").first().payload)
    total = p["kpi"]["total_revenue"]
    for key in ("monthly_trend", "channel_mix", "region_totals", "day_of_week"):
        assert abs(sum(x["revenue"] for x in p[key]) - total) < 1e-3
    drill = sum(c["revenue"] for cats in p["region_drill"].values() for c in cats)
    assert abs(drill - total) < 1e-3
    assert list(p["region_drill"]) == sorted(p["region_drill"])
    assert [d["day"] for d in p["day_of_week"]][0] == "Monday" and len(p["day_of_week"]) == 7
    assert len(p["top_skus"]) == 10


def test_pareto_and_report_consistency(q):
    pareto = q("defect_pareto").orderBy("rank").collect()
    returns = q("returned_lines").count()
    assert sum(r.orders for r in pareto) == returns
    assert abs(pareto[-1].cumulative_pct - 100.0) <= 0.05 * len(pareto)
    summary = {r.label: r.value for r in q("report_summary").collect()}
    assert summary["#1 Root Cause"] == pareto[0].defect_reason
    assert summary["Total Returns / Adjustments"] == f"{returns:,}"
    log = q("report_adjustment_log")
    assert log.count() == min(500, returns)
    assert log.where("is_high <> (severity = 'High')").count() == 0


def test_order_value_stats_are_ordered(q):
    s = q("order_value_stats").first()
    assert s.n == 5937 and s.median_order_value <= s.p90 <= s.p99
    assert s.sd_order_value > 0
