"""Bucketed catalog tables of the fact, replaced by writing aside and switching the name.

A table is written under a new name, bucketed and sorted by its key.  Only when the write has succeeded does the public
name (a view) point to it, and the version before goes.  A failed job leaves the old rows in place, and frames that were
handed out read the version they were planned on until the next replacement but one.

Aggregates and joins on the bucket key read the buckets as they lie, without an exchange.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import money_sum
from ..session import delete_path, scratch_dir

BUCKETS = 16  # at least
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int) -> int:
    """So many buckets that a task, which writes or reads one, has about ``ROWS_PER_BUCKET`` rows at most."""
    return max(BUCKETS, -(-rows // ROWS_PER_BUCKET))


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The written versions of a table, oldest first (names end in a running number)."""
    found = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__v") and not t.isTemporary]
    return sorted(found, key=lambda t: int(t.split("__v")[1].split("_")[0]))


def replace_table(df: DataFrame, name: str, key: str, buckets: int | None = None) -> str:
    """Make ``name`` the rows of ``df``, bucketed by ``key``; returns the version's table name.

    Unless it is given, the number of buckets grows with the rows (of a stored fact, the count reads file footers).
    """
    spark = df.sparkSession
    buckets = buckets or buckets_for(df.count())
    older = _versions(spark, name)
    number = int(older[-1].split("__v")[1].split("_")[0]) + 1 if older else 1
    version = f"{name}__v{number}_{uuid.uuid4().hex[:8]}"
    path = scratch_dir(spark, f"tables/{version}")
    try:
        # rows of one bucket come from one task, so a bucket is one sorted file
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
           .option("path", path).format("parquet").saveAsTable(version))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        delete_path(spark, path)
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in older[:-1]:  # the last one may still be read
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        delete_path(spark, scratch_dir(spark, f"tables/{old}"))
    return version


def order_totals(table: DataFrame) -> DataFrame:
    """Lines, units and value of each order: no exchange on a table bucketed by ``order_id``."""
    return table.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("bigint").alias("units"),
        money_sum("net_revenue").cast("double").alias("order_value"))


def customer_totals(table: DataFrame) -> DataFrame:
    """Lifetime value of each customer: no exchange on a table bucketed by ``customer_id``."""
    return table.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"), money_sum("net_revenue").cast("double").alias("lifetime_value"),
        F.max("order_date").alias("last_order_date"))
