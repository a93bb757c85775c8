"""Hand-made frames for the semantic rules (rounding, nulls, weeks, labels, draws)."""

import datetime as dt

from pyspark.sql import functions as F

from salesforge.functions import dates, formatting, hashing, money
from salesforge.schema import DEFECT_REASONS


def test_rint_round_is_numpy_style(spark):
    vals = [0.285, 1.005, 2.675, 0.125, 0.375]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(money.rint_round("x", 2)).collect()]
    assert got == [0.28, 1.0, 2.68, 0.12, 0.38]


def test_half_away_round_on_scaled_double(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (1.005,)], "x double")
    got = [r[0] for r in df.select(money.half_away_round("x", 0)).collect()]
    assert got == [3.0, -3.0, 0.0, 1.0]
    got2 = [r[0] for r in df.select(money.half_away_round("x", 2)).collect()]
    assert got2[2] == 0.13 and got2[3] == 1.0  # 1.005*100 = 100.49999999999999


def test_money_sum_exact_and_order_free(spark):
    rows = [(0.1,)] * 10 + [(0.2,)] * 10
    a = spark.createDataFrame(rows, "x double").repartition(7)
    b = spark.createDataFrame(list(reversed(rows)), "x double").repartition(3)
    sa = a.agg(money.money_sum_double("x")).first()[0]
    sb = b.agg(money.money_sum_double("x")).first()[0]
    assert sa == sb == 3.0


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(money.ratio("a", "b")).collect()] == [None, 0.5]


def test_time_dimensions_and_null_date(spark):
    df = spark.createDataFrame([(dt.date(2023, 5, 7),), (None,)], "order_date date")
    rows = dates.add_time_dimensions(df).collect()
    assert (rows[0].order_year, rows[0].order_month, rows[0].order_quarter, rows[0].day_of_week) == \
        (2023, "2023-05", "2023Q2", "Sunday")
    assert rows[1].order_month is None and rows[1].order_quarter is None


def test_week_starts_on_sunday(spark):
    days = [dt.date(2022, 12, 31), dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(dates.week_start_sunday("d")).collect()]
    assert got == [dt.date(2022, 12, 25), dt.date(2023, 1, 1), dt.date(2023, 1, 1), dt.date(2023, 1, 1)]


def test_seasonal_multiplier_rule(spark):
    days = [dt.date(2023, 1, 5), dt.date(2023, 1, 6), dt.date(2023, 5, 30), dt.date(2023, 6, 24),
            dt.date(2023, 6, 25), dt.date(2023, 11, 16)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(dates.seasonal_multiplier("d")).collect()]
    assert got == [1.55, 1.0, 1.25, 1.25, 1.0, 1.55]


def test_money_label(spark):
    df = spark.createDataFrame([(28822445.2,), (4567.0,), (999.4,), (1_000_000.0,)], "v double")
    got = [r[0] for r in df.select(formatting.money_label(F.col("v"))).collect()]
    assert got == ["$28.82M", "$4.6K", "$999", "$1.00M"]


def test_thousands_and_percent(spark):
    df = spark.createDataFrame([(59868, 0.0259, 1234567.5)], "n long, f double, v double")
    r = df.select(formatting.thousands(F.col("n")), formatting.percent_label(F.col("f")),
                  formatting.dollars_label(F.col("v"))).first()
    assert tuple(r) == ("59,868", "2.59%", "$1,234,568")


def test_weighted_choice_shares_and_stability(spark):
    df = spark.range(20000).select(F.col("id").alias("k"))
    u = hashing.hash_uniform(7, "k")
    drawn = df.select("k", hashing.weighted_choice(u, DEFECT_REASONS).alias("r"))
    shares = {r["r"]: r["count"] / 20000 for r in drawn.groupBy("r").count().collect()}
    for name, w in DEFECT_REASONS:
        assert abs(shares[name] - w) < 0.015
    again = drawn.repartition(5).orderBy("k").limit(50).collect()
    first = drawn.orderBy("k").limit(50).collect()
    assert again == first


def test_cumulative_thresholds():
    b = hashing.cumulative_thresholds([w for _, w in DEFECT_REASONS])
    assert b[0] == 0.27 and b[1] == 0.45 and b[-1] == 1.0
