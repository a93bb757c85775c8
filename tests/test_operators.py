"""Report operators on hand-made frames: ties, odd ntile sizes, missing days, zero denominators."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from salesforge.operators import payload, quality, sales, smoothing, stats
from salesforge.plans.quantiles import exact_quantiles
from salesforge.plans.ranking import distributed_ntile
from salesforge.schema import FACT_SCHEMA


def _fact(spark, rows):
    """rows: dicts with any fact columns; the rest get defaults."""
    base = dict(order_id=1, customer_id=1, order_date=dt.date(2023, 1, 2), region="N", category="C",
                sku="s", channel="Web", payment_method="Card", quantity=1, unit_price=1.0,
                discount_pct=0, gross_revenue=1.0, discount_amount=0.0, net_revenue=1.0,
                is_returned=0, order_year=2023, order_month="2023-01", order_quarter="2023Q1",
                day_of_week="Monday")
    full = []
    for r in rows:
        d = dict(base)
        d.update(r)
        full.append(tuple(d[f.name] for f in FACT_SCHEMA.fields))
    return spark.createDataFrame(full, FACT_SCHEMA)


def test_rank_ties_let_four_rows_pass(spark):
    rows = [dict(order_id=i, sku=s, net_revenue=v) for i, (s, v) in
            enumerate([("a", 50.0), ("b", 40.0), ("c", 30.0), ("d", 30.0), ("e", 10.0)])]
    out = sales.top_skus_per_category(_fact(spark, rows)).collect()
    assert sorted(r.sku for r in out) == ["a", "b", "c", "d"]
    assert sorted(r.revenue_rank for r in out) == [1, 2, 3, 3]


def test_distributed_ntile_sizes(spark):
    df = spark.createDataFrame([(i, float(100 - i)) for i in range(10)], "id long, v double")
    out = distributed_ntile(df, [F.col("v").desc(), F.col("id")], 4, name="t").collect()
    sizes = [sum(1 for r in out if r.t == k) for k in (1, 2, 3, 4)]
    assert sizes == [3, 3, 2, 2]
    assert {r.id for r in out if r.t == 1} == {0, 1, 2}


def test_distributed_ntile_equals_sql_ntile(spark):
    df = spark.range(1537).select(F.col("id"), ((F.col("id") * 7919) % 613).cast("double").alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    mine = distributed_ntile(df, [F.col("v").desc(), F.col("id")], 7, name="t").select("id", "t")
    ref = df.selectExpr("id", "ntile(7) OVER (ORDER BY v DESC, id) AS t")
    assert mine.exceptAll(ref).count() == 0 and ref.exceptAll(mine).count() == 0


def test_customer_quartiles_has_no_global_ntile_window(spark):
    rows = [dict(order_id=i, customer_id=i % 50, net_revenue=float(i)) for i in range(200)]
    q = sales.customer_value_quartiles(_fact(spark, rows))
    plan = q._jdf.queryExecution().executedPlan().toString().lower()
    assert "ntile" not in plan
    assert q.count() == 50
    sizes = sorted(r["count"] for r in q.groupBy("value_quartile").count().collect())
    assert sizes == [12, 12, 13, 13]


def test_mom_growth_null_after_zero_month(spark):
    rows = [dict(order_id=1, order_month="2023-01", net_revenue=0.0),
            dict(order_id=2, order_month="2023-02", net_revenue=10.0)]
    out = {r.order_month: r for r in sales.monthly_revenue_mom(_fact(spark, rows)).collect()}
    assert out["2023-01"].mom_growth_pct is None
    assert out["2023-02"].mom_growth_pct is None and out["2023-02"].revenue_change == 10.0


def test_null_keys_dropped_in_pandas_paths_kept_in_sql_paths(spark):
    rows = [dict(order_id=1, category=None, net_revenue=5.0), dict(order_id=2, category="C")]
    f = _fact(spark, rows)
    assert [r.category for r in payload.region_category_revenue(f).collect()] == ["C"]
    assert sorted((r.category or "") for r in sales.return_rate_vs_avg(f).collect()) == ["", "C"]


def test_missing_day_has_zero_revenue(spark):
    f = _fact(spark, [dict(day_of_week="Monday", net_revenue=3.0)])
    out = {r.day: r.revenue for r in payload.day_of_week_revenue(f).collect()}
    assert len(out) == 7 and out["Tuesday"] == 0.0 and out["Monday"] == 3.0


def test_mode_ties_pick_alphabetically_first(spark):
    f = _fact(spark, [dict(order_id=i, is_returned=1) for i in range(4)])
    enriched = f.withColumn("defect_reason", F.when(F.col("order_id") < 2, "Wrong Item Shipped")
                            .otherwise("Damaged in Transit"))
    top = quality.top_defect_reason_by(enriched, "category").first()
    assert top.top_defect_reason == "Damaged in Transit"


def test_pareto_cumulative_sums_rounded_shares(spark):
    f = _fact(spark, [dict(order_id=i, is_returned=1) for i in range(3)])
    enriched = f.withColumn("defect_reason", F.concat(F.lit("r"), F.col("order_id").cast("string")))
    p = quality.defect_pareto(enriched.withColumn("adjustment_value", F.col("net_revenue"))).collect()
    assert [r.pct_of_total for r in p] == [33.3, 33.3, 33.3]
    assert sorted(r.cumulative_pct for r in p) == [33.3, 66.6, 99.9]


def test_quantiles_type7_match_numpy(spark):
    vals = [float(v) for v in np.random.default_rng(3).integers(1, 500, 311)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = exact_quantiles(df, "x", {"a": 0.25, "b": 0.5, "c": 0.9, "d": 0.99}).first()
    for name, p in zip("abcd", (0.25, 0.5, 0.9, 0.99)):
        assert abs(q[name] - np.quantile(vals, p)) < 1e-9


def test_log_boxplot_excludes_non_positive(spark):
    vals = [0.0, -5.0, 1.0, 10.0, 10.0, 10.0, 10.0, 100.0, 100000.0]
    f = _fact(spark, [dict(order_id=i, net_revenue=v) for i, v in enumerate(vals)])
    b = stats.boxplot_by_category(f).first()
    assert b.n == 7 and b.n_dropped == 2
    y = np.log10([v for v in vals if v > 0])
    q1, q3 = np.quantile(y, 0.25), np.quantile(y, 0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert b.n_outliers == int(((y < lo) | (y > hi)).sum())
    assert abs(b.q1 - 10 ** q1) < 1e-6


def test_loess_matches_numpy_weighted_polyfit(spark):
    rng = np.random.default_rng(5)
    xs = np.arange(0, 7 * 60, 7, dtype=float)
    ys = 1000 + 50 * np.sin(xs / 40) + rng.normal(0, 5, len(xs))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(xs, ys)], "x double, y double")
    fit = {r.point: r.fitted for r in smoothing.loess(df, "x", "y", 0.15, 80).collect()}
    n, q = len(xs), int(np.floor(len(xs) * 0.15 + 1e-5))
    for p in (0, 17, 40, 79):
        x0 = xs.min() + p * ((xs.max() - xs.min()) / 79)
        d = np.abs(xs - x0)
        h = np.sort(d)[q - 1]
        w = np.where(d / h < 1, (1 - (d / h) ** 3) ** 3, 0.0)
        coef = np.polyfit((xs - x0) / h, ys, 2, w=np.sqrt(w))
        assert abs(fit[p] - coef[-1]) < 1e-6 * abs(coef[-1])
    assert n == 60


def test_payload_roundtrip_and_crossfoot(spark):
    rows = [dict(order_id=i, region=r, category=c, channel=ch, day_of_week=d, net_revenue=v)
            for i, (r, c, ch, d, v) in enumerate([("N", "A", "Web", "Monday", 10.25),
                                                    ("S", "B", "App", "Friday", 4.75),
                                                    ("N", "B", "Web", "Monday", 1.10)])]
    f = _fact(spark, rows)
    series = payload.payload_series(payload.dashboard_payload(f))
    tot = {r.series: r.s for r in series.groupBy("series").agg(F.sum("value").alias("s")).collect()}
    for k in ("monthly_trend", "region_drill", "channel_mix", "region_totals", "day_of_week"):
        assert abs(tot[k] - 16.10) < 1e-9
    text = payload.dashboard_payload(f).first().payload
    assert '"total_revenue":16.10' in text and '"manual_reporting_time_reduction_pct":60' in text
