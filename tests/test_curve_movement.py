"""The curve layout moves the fact once, to its place along the curve."""

from pyspark.sql import functions as F

from salesforge.session import configure
from salesforge.sources import spatial
from tests.test_data_movement import _final_plan, _without_small_broadcasts


def test_rows_are_not_moved_to_meet_their_ranks(spark):
    configure(spark)
    rows = spark.range(500).select((F.col("id") % 7).alias("order_date"), (F.col("id") % 3).alias("region"),
                                   F.lit("X").alias("category"))
    plan = _without_small_broadcasts(spark, lambda: _final_plan(spatial.with_curve_key(rows)))
    assert plan.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in plan
