"""A star report that prunes at run time: quarter and segment revenue through a filtered calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_text, quarter_text
from ..functions.money import half_away_round, money_sum, ratio


def write_calendar(fact_dates: DataFrame, path: str, date_col: str = "order_date") -> str:
    """The calendar dimension: one row for each month that ``fact_dates`` has, with its quarter and year."""
    (fact_dates.where(F.col(date_col).isNotNull())
     .select(month_text(date_col).alias("cal_month"), quarter_text(date_col).alias("cal_quarter"),
             F.year(date_col).alias("cal_year")).distinct()
     .coalesce(1).write.mode("overwrite").parquet(path))  # at most twelve rows a year
    return path


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("cal_month string, cal_quarter string, cal_year int").parquet(path)


def quarter_by_segment(fact: DataFrame, calendar: DataFrame, quarters: Column, orders: DataFrame | None = None) -> DataFrame:
    """Revenue, orders and share of the quarter for each segment (sales channel) in the calendar rows of ``quarters``.

    The filter is on the dimension, so the planner passes the months it leaves to the scan of the month-partitioned fact
    while the query runs (dynamic partition pruning).  ``orders`` (o_orderkey, any filters) restricts the lines further;
    a large fact gets a run-time Bloom filter of its keys.
    """
    chosen = calendar.where(quarters).select("cal_month", "cal_quarter")
    lines = fact.join(F.broadcast(chosen), F.col("order_month") == F.col("cal_month"))  # a row a month
    if orders is not None:
        lines = lines.join(orders.select("o_orderkey"), F.col("order_id") == F.col("o_orderkey"))
    per_order = (lines.groupBy("cal_quarter", "channel", "order_id")
                 .agg(money_sum("net_revenue").alias("_rev"), F.sum("quantity").alias("_units")))
    segment = (per_order.groupBy("cal_quarter", "channel")
               .agg(F.sum("_rev").cast("decimal(28,2)").alias("_rev"), F.count(F.lit(1)).alias("orders"),
                    F.sum("_units").cast("bigint").alias("units")))
    total = segment.groupBy(F.col("cal_quarter").alias("_q")).agg(F.sum("_rev").alias("_total"))
    rev = F.col("_rev").cast("double")
    return segment.join(total, F.col("cal_quarter") == F.col("_q")).select(
        F.col("cal_quarter").alias("quarter"), F.col("channel").alias("segment"), rev.alias("revenue"), "orders", "units",
        half_away_round(ratio(F.lit(100.0) * rev, F.col("_total").cast("double")), 2).alias("pct_of_quarter"))
