"""Row order of the reports, and inputs that the fixture tables never have."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from salesforge.functions.formatting import fixed_digits, money_label
from salesforge.operators import etl, payload, quality, smoothing, stats
from salesforge.schema import WEEKDAYS
from salesforge.sources import csv_export, sinks
from tests.conftest import SMALL

# name -> (column, descending) pairs of the final order
ORDERS = {
    "monthly_revenue_mom": [("order_month", False)],
    "top_skus_per_category": [("category", False), ("revenue_rank", False), ("sku", False)],
    "regional_cumulative": [("region", False), ("order_month", False)],
    "customer_value_quartiles": [("lifetime_value", True), ("customer_id", False)],
    "return_rate_vs_avg": [("return_rate_pct", True), ("category", False)],
    "channel_payment_mix": [("revenue", True), ("channel", False), ("payment_method", False)],
    "monthly_trend": [("month", False)],
    "region_list": [("region", False)],
    "region_drill_one": [("revenue", True), ("category", False)],
    "channel_mix": [("channel", False)],
    "region_totals": [("revenue", True), ("region", False)],
    "day_of_week_revenue": [("day_index", False)],
    "top_skus_overall": [("rank", False)],
    "defect_pareto": [("rank", False)],
    "defect_rate_by_category": [("defect_rate_pct", True), ("category", False)],
    "defect_rate_by_region": [("defect_rate_pct", True), ("region", False)],
    "report_by_category": [("defect_rate_pct", True), ("category", False)],
    "report_by_region": [("defect_rate_pct", True), ("region", False)],
    "report_adjustment_log": [("order_date", True), ("order_id", False), ("sku", False)],
    "report_summary": [("position", False)],
    "boxplot_by_category": [("category", False)],
    "weekly_revenue": [("week", False)],
    "return_rate_by_discount": [("discount_pct", False)],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_order(spark, name):
    rows = E.queries()[name](spark, SMALL).collect()
    want = list(rows)
    for column, down in reversed(ORDERS[name]):
        want.sort(key=lambda r: r[column], reverse=down)
    assert rows == want and rows


def test_report_files_are_sorted(spark, tmp_path):
    fact = etl.clean_fact(_lines(spark, [(f"c{i % 7}", 1.0 + i, i % 2) for i in range(60)]))
    paths = sinks.write_report(quality.quality_report(fact), str(tmp_path))
    rows = sinks.read_report_rows(spark, paths).collect()
    for table in ("by_category", "by_region"):
        mine = sorted((r for r in rows if r.table == table), key=lambda r: r.row_number)
        assert [r.v1 for r in mine] == sorted((r.v1 for r in mine), reverse=True)
    assert sum(r.table == "adjustment_log" for r in rows) == 30
    assert [r.key for r in rows if r.table == "summary"][0] == "Total Orders"


def _lines(spark, rows):
    """(category, unit price, is_returned) as raw lines."""
    full = [(i, i % 5, dt.date(2023, 1, 1 + i % 28), "N", c, f"s{i}", "Web", "Card", 1, p, 0, 0.0, 0.0, 0.0, r, i, 0, 0, 0.0, 0)
            for i, (c, p, r) in enumerate(rows)]
    from salesforge.schema import RAW_SCHEMA
    schema = RAW_SCHEMA.simpleString()[7:-1] + \
        ",ingest_line int,ingest_part bigint,ingest_supp bigint,ingest_price double,ingest_copy int"
    return spark.createDataFrame(full, schema)


def test_boxplot_of_a_missing_category(spark):
    fact = etl.clean_fact(_lines(spark, [(None, float(v), 0) for v in (10, 11, 12, 13, 14, 0.01, 99999)]
                                 + [("a", 5.0, 0)]))
    box = {r.category: r for r in stats.boxplot_by_category(fact).collect()}
    assert (box[None].n, box[None].n_outliers, box[None].lower_whisker, box[None].upper_whisker) == (7, 2, 10.0, 14.0)
    out = {(r.category, r.net_revenue, r.side) for r in stats.boxplot_outliers(fact).collect()}
    assert out == {(None, 0.01, "low"), (None, 99999.0, "high")}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 10, 13, 14, 20, 40])
def test_loess_of_short_series(spark, n):
    rng = np.random.default_rng(n)
    x, y = np.arange(n) * 7.0, rng.random(n)
    got = smoothing.loess(spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x double, y double"),
                          "x", "y", points=9).orderBy("point").collect()
    assert len(got) == 9
    q = max(1, min(n, math.floor(n * 0.15 + 1e-5)))
    for r in got:
        d = np.abs(x - r.x0)
        h = np.sort(d)[q - 1]
        w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0.0) if h > 0 else (d == 0).astype(float)
        if not (w > 0).any():
            w = (d <= h).astype(float)
        degree = min(2, int((w > 0).sum()) - 1)
        at = w > 0
        want = np.polyval(np.polyfit(x[at] - r.x0, y[at], degree, w=np.sqrt(w[at])), 0.0)
        assert r.fitted == pytest.approx(want, abs=1e-6)


def test_loess_with_one_point(spark):
    (row,) = smoothing.loess(spark.createDataFrame([(0.0, 1.0), (7.0, 2.0)], "x double, y double"), "x", "y",
                             points=1).collect()
    assert row.x0 == 0.0 and row.fitted == 1.0


def test_labels_follow_the_exact_binary_value(spark):
    from decimal import ROUND_HALF_UP, Decimal
    values = [1450.0, 1550.0, 2500.0, 1250.0, 0.5, 2.5, 1005000.0, 1015000.0, 999.5, 12345678.9, 1000.0, 0.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(money_label(F.col("v"))).collect()]

    def want(v):
        scale, digits, unit = (1e6, 2, "M") if v >= 1e6 else (1e3, 1, "K") if v >= 1e3 else (1.0, 0, "")
        return f"${Decimal(v / scale).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)}{unit}"

    assert got == [want(v) for v in values] and got[0] == "$1.4K"
    rng = np.random.default_rng(5)
    many = np.round(rng.random(3000) * 1000, 3)
    out = spark.createDataFrame([(float(v),) for v in many], "v double").select("v", fixed_digits(F.col("v"), 2)).collect()
    assert all(Decimal(repr(b)) == Decimal(a).quantize(Decimal("0.01"), ROUND_HALF_UP).normalize() for a, b in out)


def test_positions_of_many_categories(spark):
    fact = etl.clean_fact(_lines(spark, [(f"c{i:04d}", 1.0 + i, 0) for i in range(1003)]))
    rows = payload.payload_series(payload.dashboard_payload(fact)).where("series = 'region_drill'").collect()
    assert sorted(r.sub_pos for r in rows) == list(range(1003)) and {r.pos for r in rows} == {0}


def test_weekdays_are_the_fixed_list(spark):
    assert [r.day for r in payload.weekday_dimension(spark).orderBy("day_index").collect()] == WEEKDAYS


CSV = """order_id,customer_id,order_date,region,category,sku,channel,payment_method,quantity,unit_price,discount_pct,gross_revenue,discount_amount,net_revenue,is_returned
1,1,2023-01-01 00:00:00,NA,A,s,Web,Card,2.0,10,5,0,0,0,0
2,1,2023-01-02,N,A,s,Web,Card,1,NaN,0.0,0,0,0,1
3,1,2023-01-03,N,A,s,Web,Card,NA,abc,0,0,0,0,0
9007199254740993,1,N/A,N,A,s,Web,Card,1.5,12,0,0,0,0,0
5,1,2023-01-05,N,A,s,Web,Card,1,-1,0,0,0,0,0
"""


def test_csv_tokens_types_and_unparsable_fields(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CSV)
    df = csv_export.read_csv_export(spark, str(tmp_path), with_file_order=True, count_unparsed=True)
    rows = {r.order_id: r for r in df.collect()}
    assert (rows[1].quantity, rows[1].order_date, rows[1].region) == (2, dt.date(2023, 1, 1), None)
    assert rows[2].unit_price is None and rows[2].discount_pct == 0 and rows[3].unit_price is None
    assert rows[9007199254740993].order_date is None and rows[9007199254740993].quantity is None
    assert {k: r.unparsed_fields for k, r in rows.items()} == {1: 0, 2: 0, 3: 1, 9007199254740993: 1, 5: 0}
    # NaN is missing, so the median of A is that of 10 and 12
    fixed = {r.order_id: r.unit_price for r in etl.clean_fact(df).collect()}
    assert fixed[5] == 11.0 and fixed[2] is None
    with pytest.raises(Exception, match="no value of their type: unit_price|no value of their type: quantity"):
        csv_export.read_csv_export(spark, str(tmp_path), strict=True).count()
