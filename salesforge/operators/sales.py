"""The analytical SQL layer over ``fact_transactions`` (six reports).

SQL semantics are kept: ``GROUP BY`` keeps null keys, ``ROUND`` is half away
from zero, division by zero gives null.  Money is summed exactly (decimal) and
cast to double at the end; ratios are taken on those doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import half_away_round, money_sum, ratio
from ..plans.ranking import distributed_ntile
from ..schema import DEFAULT_TILES, DEFAULT_TOP_PER_CATEGORY


def monthly_revenue_mom(fact: DataFrame) -> DataFrame:
    """Revenue, orders and AOV per month with month-over-month change (LAG).

    The window has no partition key, but it runs on the monthly aggregate
    (one row per month), so the single-partition step is tiny.
    """
    m = (fact.groupBy("order_month")
             .agg(money_sum("net_revenue").alias("_rev"),
                  F.countDistinct("order_id").alias("orders")))
    w = Window.orderBy("order_month")
    prev = F.lag("_rev").over(w)
    rev = F.col("_rev").cast("double")
    change = (F.col("_rev") - prev).cast("double")
    return m.select(
        "order_month",
        rev.alias("revenue"),
        F.col("orders"),
        half_away_round(ratio(rev, F.col("orders")), 2).alias("avg_order_value"),
        half_away_round(change, 2).alias("revenue_change"),
        half_away_round(ratio(F.lit(100.0) * change, prev.cast("double")), 2).alias("mom_growth_pct"),
    ).orderBy("order_month")


def sku_performance(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("category", "sku")
                .agg(money_sum("net_revenue").cast("double").alias("total_revenue"),
                     F.sum("quantity").cast("bigint").alias("units_sold"),
                     F.countDistinct("order_id").alias("orders")))


def top_skus_per_category(fact: DataFrame, top_n: int = DEFAULT_TOP_PER_CATEGORY) -> DataFrame:
    """RANK() per category by revenue, rank <= top_n (ties share a rank).

    rank + filter becomes a ``WindowGroupLimit`` (partial before the shuffle).
    """
    w = Window.partitionBy("category").orderBy(F.col("total_revenue").desc())
    return (sku_performance(fact)
            .withColumn("revenue_rank", F.rank().over(w).cast("bigint"))
            .where(F.col("revenue_rank") <= top_n)
            .select("category", "sku", "total_revenue", "units_sold", "orders", "revenue_rank")
            .orderBy("category", "revenue_rank", "sku"))


def regional_cumulative(fact: DataFrame) -> DataFrame:
    """Running revenue per region over months and the region's share of each month."""
    rm = fact.groupBy("region", "order_month").agg(money_sum("net_revenue").alias("_rev"))
    w_run = (Window.partitionBy("region").orderBy("order_month")
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    w_month = Window.partitionBy("order_month")
    rev = F.col("_rev").cast("double")
    return rm.select(
        "region", "order_month",
        rev.alias("revenue"),
        F.sum("_rev").over(w_run).cast("double").alias("cumulative_revenue"),
        half_away_round(ratio(F.lit(100.0) * rev, F.sum("_rev").over(w_month).cast("double")), 2)
        .alias("pct_of_month_total"),
    ).orderBy("region", "order_month")


def customer_value(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("customer_id")
                .agg(F.countDistinct("order_id").alias("order_count"),
                     money_sum("net_revenue").cast("double").alias("lifetime_value"),
                     F.max("order_date").alias("last_order_date")))


def customer_value_quartiles(fact: DataFrame, tiles: int = DEFAULT_TILES) -> DataFrame:
    """NTILE(tiles) by lifetime value (1 = top), ties broken by customer id.

    One row per customer can be billions of rows, so the tile is computed by
    range partitioning + per-partition offsets, never in a single task.
    """
    cv = customer_value(fact)
    order = [F.col("lifetime_value").desc(), F.col("customer_id").asc()]
    return (distributed_ntile(cv, order, tiles, name="value_quartile")
            .select("customer_id", "order_count", "lifetime_value", "last_order_date",
                    "value_quartile")
            .orderBy(*order))


def return_rate_vs_avg(fact: DataFrame) -> DataFrame:
    """Return rate per category against the unweighted mean of category rates."""
    c = (fact.groupBy("category")
             .agg(F.count(F.lit(1)).alias("total_orders"),
                  F.sum("is_returned").cast("bigint").alias("returned_orders")))
    rate = ratio(F.col("returned_orders"), F.col("total_orders"))
    return c.select(
        "category", "total_orders", "returned_orders",
        half_away_round(ratio(F.lit(100.0) * F.col("returned_orders"), F.col("total_orders")), 2)
        .alias("return_rate_pct"),
        half_away_round(F.lit(100.0) * F.avg(rate).over(Window.partitionBy()), 2)
        .alias("company_avg_return_rate_pct"),
    ).orderBy(F.col("return_rate_pct").desc(), "category")


def channel_payment_mix(fact: DataFrame) -> DataFrame:
    """Revenue and orders per channel x payment method, with share of total revenue."""
    g = (fact.groupBy("channel", "payment_method")
             .agg(money_sum("net_revenue").alias("_rev"),
                  F.countDistinct("order_id").alias("orders")))
    rev = F.col("_rev").cast("double")
    total = F.sum("_rev").over(Window.partitionBy()).cast("double")
    return g.select(
        "channel", "payment_method", rev.alias("revenue"), "orders",
        half_away_round(ratio(F.lit(100.0) * rev, total), 2).alias("pct_of_total_revenue"),
    ).orderBy(F.col("revenue").desc(), "channel", "payment_method")
