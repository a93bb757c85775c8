"""What the cleaning and the loads move: each line once a shuffle, whatever the size of the dimensions."""

import datetime as dt

from pyspark.sql import functions as F

from salesforge.operators import etl
from salesforge.plans.quantiles import value_bucket
from salesforge.schema import RAW_COLUMNS
from salesforge.session import configure
from salesforge.sources import warehouse
from salesforge.sources.tables import raw_lines
from tests.conftest import SMALL
from tests.test_etl import _raw


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def _without_small_broadcasts(spark, f):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return f()
    finally:
        spark.conf.set(name, before)


def test_lines_and_their_medians_share_the_shuffles(spark):
    configure(spark)
    raw = raw_lines(spark, SMALL)
    for df in (etl.clean_fact(raw), etl.dedup_lines(raw).transform(etl.impute_price_median).select(*RAW_COLUMNS)):
        plan = _without_small_broadcasts(spark, lambda df=df: _final_plan(df))
        assert plan.count("ReadSchema: struct<l_orderkey") == 1
        assert plan.count("ReadSchema: struct<o_orderkey") == 1


def test_medians_are_broadcast_to_the_lines(spark):
    configure(spark)
    plan = _without_small_broadcasts(spark, lambda: _final_plan(etl.clean_fact(raw_lines(spark, SMALL))))
    assert "BroadcastHashJoin [category" in plan and "SortMergeJoin [category" not in plan


def test_customers_are_joined_to_orders_not_lines(spark):
    plan = _without_small_broadcasts(spark, lambda: _final_plan(raw_lines(spark, SMALL)))
    above_customers = plan[:plan.index("SortMergeJoin [o_custkey")]
    assert "SortMergeJoin [l_orderkey" in above_customers


def test_a_histogram_is_built_once(spark):
    assert not spark.range(1).select(value_bucket(F.lit(None).cast("double"))).schema[0].nullable
    rows = spark.createDataFrame([(0.0,), (-3.5,), (2.0,), (None,)], "x double")
    assert [r[0] for r in rows.select(value_bucket(F.col("x"))).collect()] == [0, -32791552, 32788480, 0]


def test_lines_that_tie_in_the_ingest_order_do_not_depend_on_the_rows_order(spark):
    rows = [(1, "a", "X", r, q, 10.0, 0, 1) for r, q in [("S", 1), ("N", 3), ("N", 2)]]
    for ordered in (rows, rows[::-1]):
        kept = etl.dedup_lines(_raw(spark, ordered).repartition(3, F.rand(5))).collect()
        assert [(k.region, k.quantity) for k in kept] == [("N", 2)]


def test_a_load_equals_the_clean_fact(spark, tmp_path):
    configure(spark)
    name = "spark.sql.requireAllClusterKeysForDistribution"
    before = spark.conf.get(name)
    null_day = _raw(spark, [(1, "a", "X", None, 0, -1.0, 5, 1), (2, "b", "X", "N", 2, 3.0, 5, 1)]).withColumn(
        "order_date", F.when(F.col("order_id") == 2, F.lit(dt.date(2023, 5, 1))))
    for n, raw in enumerate([raw_lines(spark, SMALL), null_day]):
        path = warehouse.load_fact(raw, str(tmp_path / f"fact{n}"))
        loaded, clean = warehouse.read_fact(spark, path), etl.clean_fact(raw)
        assert loaded.columns == clean.columns and loaded.count() == clean.count()
        assert loaded.exceptAll(clean).isEmpty()
    assert spark.conf.get(name) == before
