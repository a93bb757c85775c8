"""Readers for the star-schema tables and the order-line export built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import rint_round

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Deterministic defects injected into the export (see FIXTURES.md):
# h = (orderkey*31 + linenumber*17 + partkey*7 + suppkey) % 200
DIRT_MODULUS = 200
DIRT_BAD_PRICE = 1      # unit_price -> -1
DIRT_BAD_QTY = 2        # quantity -> 0
DIRT_NO_REGION = 3      # region -> null
DIRT_COPIED = (1, 4)    # these lines are appended a second time


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Columns of the star tables this engine reads.  Declaring them skips the
# footer-inference job per table and prunes the scan to these columns.
STAR_SCHEMAS = {
    "region": _schema(("r_regionkey", T.IntegerType()), ("r_name", T.StringType())),
    "nation": _schema(("n_nationkey", T.IntegerType()), ("n_name", T.StringType()),
                      ("n_regionkey", T.IntegerType())),
    "customer": _schema(("c_custkey", T.LongType()), ("c_nationkey", T.IntegerType()),
                        ("c_mktsegment", T.StringType())),
    "part": _schema(("p_partkey", T.LongType()), ("p_name", T.StringType()),
                    ("p_brand", T.StringType()), ("p_type", T.StringType())),
    "orders": _schema(("o_orderkey", T.LongType()), ("o_custkey", T.LongType()),
                      ("o_orderdate", T.TimestampNTZType()), ("o_orderpriority", T.StringType())),
    "lineitem": _schema(("l_orderkey", T.LongType()), ("l_partkey", T.LongType()),
                        ("l_suppkey", T.LongType()), ("l_linenumber", T.IntegerType()),
                        ("l_quantity", T.DoubleType()), ("l_extendedprice", T.DoubleType()),
                        ("l_discount", T.DoubleType()), ("l_returnflag", T.StringType())),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in STAR_SCHEMAS:
        reader = reader.schema(STAR_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_if_underpartitioned(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when its scan yields fewer splits than the cluster has cores.

    A large table arrives in thousands of splits and is left alone (its join
    shuffles it on ``key`` anyway, and AQE may still split a skewed key).  A
    file stored as one big row group is a single split; spreading it on the
    join key it is about to meet costs one small shuffle and buys full
    parallelism for the join, the repairs and the map-side dedup.
    """
    spark = df.sparkSession
    if df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:  # planned, not run
        return df
    return df.repartition(key)


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its part, and to its order with customer, nation and region.

    The dimension joins are all many-to-one on primary keys.  Customers are
    joined to the orders, of which there are a few times fewer than lines, so
    that the lines move twice at most: on the part key while they are narrow,
    then on the order key (dimensions that are small enough are broadcast).
    """
    li = spread_if_underpartitioned(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag"), "l_orderkey")
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    rg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_name")

    geo = (cu.join(na, cu.c_nationkey == na.n_nationkey)
             .join(rg, F.col("n_regionkey") == rg.r_regionkey)
             .select("c_custkey", "c_mktsegment", "r_name"))
    placed = od.join(geo, od.o_custkey == geo.c_custkey)
    return (li.join(pa, li.l_partkey == pa.p_partkey)
              .join(placed, li.l_orderkey == placed.o_orderkey))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty order-line export: 15 raw columns plus ingest-order helpers."""
    s = star_lines(spark, sf_dir)
    h = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17
         + F.col("l_partkey") * 7 + F.col("l_suppkey")) % DIRT_MODULUS
    price = rint_round(F.col("l_extendedprice") / F.col("l_quantity"), 2)
    base = s.select(
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(h == DIRT_NO_REGION, F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("region"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name")).alias("sku"),
        F.col("c_mktsegment").alias("channel"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(h == DIRT_BAD_QTY, F.lit(0))
         .otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(h == DIRT_BAD_PRICE, F.lit(-1.0)).otherwise(price).alias("unit_price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        # stale revenue figures, to be ignored by the cleaning step
        F.col("l_extendedprice").alias("gross_revenue"),
        F.lit(0.0).alias("discount_amount"),
        F.col("l_extendedprice").alias("net_revenue"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
        F.col("l_linenumber").cast("int").alias("ingest_line"),
        F.col("l_partkey").cast("bigint").alias("ingest_part"),
        F.col("l_suppkey").cast("bigint").alias("ingest_supp"),
        F.col("l_extendedprice").alias("ingest_price"),
        # union all of a second copy of some lines, generated in the same pass
        # (no second scan of the join): copy 0 always, copy 1 for dirty lines
        F.explode(F.when(h.isin(*DIRT_COPIED), F.array(F.lit(0), F.lit(1)))
                   .otherwise(F.array(F.lit(0)))).alias("ingest_copy"),
    )
    return base
