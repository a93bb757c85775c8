"""The number of buckets follows the rows."""

from pyspark.sql import functions as F

from salesforge.sources import bucketed


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    assert bucketed.buckets_for(0) == 16 and bucketed.buckets_for(216_000_000) == 216
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 100)
    table = bucketed.replace_table(spark.range(2001).withColumn("k", F.col("id") % 50), "grown", "k")
    held = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert held["Num Buckets"] == "21" and spark.table("grown").count() == 2001
