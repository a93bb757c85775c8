"""The six analytical reports as SQL table functions, for users who write SQL.

``register_sql(spark, fact)`` names the fact ``fact_transactions`` and defines the functions in the session:

    SELECT * FROM top_skus_per_category(top_n => 5, category_name => 'PROMO');
    SELECT * FROM regional_cumulative('ASIA') WHERE order_month >= '1996-01';

A parameter that is NULL does not restrict.  Parameters become literals in the plan, so the filters they make reach the
scan.  Money is summed as decimals and rounded like the DataFrame forms in ``sales``; rows come in no order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import DEFAULT_TILES, DEFAULT_TOP_PER_CATEGORY

VIEW = "fact_transactions"
_REV = "sum(CAST(net_revenue AS DECIMAL(18, 2)))"


def _round(x: str) -> str:
    """Half away from zero to two digits, on the scaled double."""
    return f"round(CAST({x} AS DOUBLE) * 100, 0) / 100"


def _share(part: str, whole: str) -> str:
    return _round(f"try_divide(100.0D * {part}, {whole})")


# A total order over many values without one task for all: values fall into buckets by an order-preserving function
# (exponent and 12 bits below it), bucket counts give offsets, rows are counted inside their bucket only.
_BUCKET = ("CASE WHEN lifetime_value > 0 THEN 1 WHEN lifetime_value < 0 THEN -1 ELSE 0 END * "
           "CASE WHEN lifetime_value <> 0 THEN (floor(log2(abs(lifetime_value))) + 2000) * 16384 "
           "+ floor(abs(lifetime_value) / pow(2.0D, floor(log2(abs(lifetime_value)))) * 4096) ELSE 0 END")

_FUNCTIONS = {
    "monthly_revenue_mom": (
        "region_name STRING DEFAULT NULL",
        "order_month STRING, revenue DOUBLE, orders BIGINT, avg_order_value DOUBLE, revenue_change DOUBLE, "
        "mom_growth_pct DOUBLE",
        f"""WITH m AS (SELECT order_month, {_REV} AS rev, count(DISTINCT order_id) AS orders FROM {VIEW}
              WHERE region_name IS NULL OR region = region_name GROUP BY order_month),
            s AS (SELECT *, lag(rev) OVER (ORDER BY order_month) AS prev FROM m)
            SELECT order_month, CAST(rev AS DOUBLE), orders,
                   {_round("try_divide(CAST(rev AS DOUBLE), CAST(orders AS DOUBLE))")},
                   {_round("CAST(rev - prev AS DOUBLE)")},
                   {_share("CAST(rev - prev AS DOUBLE)", "CAST(prev AS DOUBLE)")} FROM s"""),
    "top_skus_per_category": (
        f"top_n INT DEFAULT {DEFAULT_TOP_PER_CATEGORY}, category_name STRING DEFAULT NULL",
        "category STRING, sku STRING, total_revenue DOUBLE, units_sold BIGINT, orders BIGINT, revenue_rank BIGINT",
        f"""WITH s AS (SELECT category, sku, CAST({_REV} AS DOUBLE) AS total_revenue,
                              CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT order_id) AS orders
                       FROM {VIEW} WHERE category_name IS NULL OR category = category_name GROUP BY category, sku),
            r AS (SELECT *, CAST(rank() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS BIGINT) AS place FROM s)
            SELECT category, sku, total_revenue, units_sold, orders, place FROM r WHERE place <= top_n"""),
    "regional_cumulative": (
        "region_name STRING DEFAULT NULL",
        "region STRING, order_month STRING, revenue DOUBLE, cumulative_revenue DOUBLE, pct_of_month_total DOUBLE",
        f"""WITH rm AS (SELECT region, order_month, {_REV} AS rev FROM {VIEW} GROUP BY region, order_month),
            w AS (SELECT region, order_month, rev, sum(rev) OVER (PARTITION BY region ORDER BY order_month) AS so_far,
                         sum(rev) OVER (PARTITION BY order_month) AS whole FROM rm)
            SELECT region, order_month, CAST(rev AS DOUBLE), CAST(so_far AS DOUBLE),
                   {_share("CAST(rev AS DOUBLE)", "CAST(whole AS DOUBLE)")}
            FROM w WHERE region_name IS NULL OR region = region_name"""),
    "customer_value_quartiles": (
        f"tiles INT DEFAULT {DEFAULT_TILES}, region_name STRING DEFAULT NULL",
        "customer_id BIGINT, order_count BIGINT, lifetime_value DOUBLE, last_order_date DATE, value_quartile BIGINT",
        f"""WITH cv AS (SELECT customer_id, count(DISTINCT order_id) AS order_count, CAST({_REV} AS DOUBLE) AS lifetime_value,
                               max(order_date) AS last_order_date FROM {VIEW}
                        WHERE region_name IS NULL OR region = region_name GROUP BY customer_id),
            tagged AS (SELECT *, {_BUCKET} AS bucket FROM cv),
            buckets AS (SELECT bucket AS b, coalesce(sum(cnt) OVER (ORDER BY bucket DESC
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(cnt) OVER () AS n
                        FROM (SELECT bucket, count(*) AS cnt FROM tagged GROUP BY bucket) c),
            placed AS (SELECT t.*, n, before + row_number() OVER (PARTITION BY bucket
                              ORDER BY lifetime_value DESC, customer_id) - 1 AS i
                       FROM tagged t JOIN buckets ON t.bucket <=> b),
            sized AS (SELECT *, n div tiles AS q, n % tiles AS big FROM placed)
            SELECT customer_id, order_count, lifetime_value, last_order_date,
                   CAST(CASE WHEN i < big * (q + 1) THEN i div (q + 1) + 1
                             ELSE big + (i - big * (q + 1)) div greatest(q, 1) + 1 END AS BIGINT) FROM sized"""),
    "return_rate_vs_avg": (
        "region_name STRING DEFAULT NULL",
        "category STRING, total_orders BIGINT, returned_orders BIGINT, return_rate_pct DOUBLE, "
        "company_avg_return_rate_pct DOUBLE",
        f"""WITH c AS (SELECT category, count(*) AS total, CAST(sum(is_returned) AS BIGINT) AS returned FROM {VIEW}
                       WHERE region_name IS NULL OR region = region_name GROUP BY category)
            SELECT category, total, returned, {_share("CAST(returned AS DOUBLE)", "CAST(total AS DOUBLE)")},
                   {_round("100.0D * avg(try_divide(CAST(returned AS DOUBLE), CAST(total AS DOUBLE))) OVER ()")} FROM c"""),
    "channel_payment_mix": (
        "region_name STRING DEFAULT NULL, first_day DATE DEFAULT NULL, last_day DATE DEFAULT NULL",
        "channel STRING, payment_method STRING, revenue DOUBLE, orders BIGINT, pct_of_total_revenue DOUBLE",
        f"""WITH g AS (SELECT channel, payment_method, {_REV} AS rev, count(DISTINCT order_id) AS orders FROM {VIEW}
                       WHERE (region_name IS NULL OR region = region_name)
                         AND (first_day IS NULL OR order_date >= first_day)
                         AND (last_day IS NULL OR order_date <= last_day) GROUP BY channel, payment_method)
            SELECT channel, payment_method, CAST(rev AS DOUBLE), orders,
                   {_share("CAST(rev AS DOUBLE)", "CAST(sum(rev) OVER () AS DOUBLE)")} FROM g"""),
}

NAMES = list(_FUNCTIONS)


def register_sql(spark: SparkSession, fact: DataFrame) -> list[str]:
    """Define the six table functions over ``fact`` in the session; returns their names."""
    fact.createOrReplaceTempView(VIEW)
    for name, (parameters, columns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
    return NAMES


def call(spark: SparkSession, name: str, arguments: str = "") -> DataFrame:
    """``SELECT * FROM name(arguments)``."""
    if name not in _FUNCTIONS:
        raise ValueError(f"no such report: {name}")
    return spark.sql(f"SELECT * FROM {name}({arguments})")
