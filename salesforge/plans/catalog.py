"""Registered queries: Spark callables ``(spark, sf_dir) -> DataFrame`` and their oracle SQL.

Every query reads the star tables in ``sf_dir`` (or the clean fact Spark
derives from them), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import etl, payload, quality, sales, sampling, smoothing, stats
from ..session import configure, fresh_dir, scratch_dir
from ..sources import csv_export, sinks, warehouse
from ..streaming import daily_ingest
from ..schema import DEFAULT_DRAW_SEED, HIGH_SEVERITY, MEDIUM_SEVERITY, RAW_COLUMNS, REVENUE_COLUMNS, WEEKDAYS
from ..sources.tables import raw_lines
from ..sources.warehouse import fact_table
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_table(spark, sf_dir)


def _raw_columns(**changed: str) -> str:
    return ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in RAW_COLUMNS)


_REPAIRED_QTY = _raw_columns(quantity="CASE WHEN quantity <= 0 THEN 1 ELSE quantity END")
_REPAIRED_REGION = _raw_columns(region="coalesce(region, 'Unknown')")


# ====================================================================== ETL
@register("etl_clean_fact", O.on_fact(f"SELECT {O.FACT_COLS} FROM fact"))
def q_etl_clean_fact(spark, sf_dir):
    return etl.clean_fact(raw_lines(spark, sf_dir))


@register("etl_quality_metrics", O.with_stage("dedup", """
SELECT (SELECT count(*) FROM raw) AS raw_rows,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM dedup) AS duplicates_removed,
       count_if(coalesce(unit_price <= 0, false)) AS invalid_price_rows,
       count_if(coalesce(quantity <= 0, false)) AS invalid_quantity_rows,
       count_if(region IS NULL) AS missing_region_rows,
       count(*) AS clean_rows,
       count_if(quantity IS NULL) AS null_quantity_rows,
       count_if(is_returned IS NULL) AS null_is_returned_rows
FROM dedup"""))
def q_etl_quality_metrics(spark, sf_dir):
    raw = raw_lines(spark, sf_dir)
    return etl.quality_metrics(raw, etl.dedup_lines(raw.drop(*REVENUE_COLUMNS)))


@register("dedup_lines", O.with_stage("dedup", f"SELECT {O.RAW_COLS} FROM dedup"))
def q_dedup_lines(spark, sf_dir):
    return etl.dedup_lines(raw_lines(spark, sf_dir)).select(*RAW_COLUMNS)


@register("impute_price_median", O.with_stage("imputed", f"SELECT {O.RAW_COLS} FROM imputed"))
def q_impute_price_median(spark, sf_dir):
    return (etl.dedup_lines(raw_lines(spark, sf_dir))
               .transform(etl.impute_price_median).select(*RAW_COLUMNS))


@register("fix_quantity", O.with_stage("dedup", f"SELECT {_REPAIRED_QTY} FROM dedup"))
def q_fix_quantity(spark, sf_dir):
    # the step on its own: over the deduplicated lines, no other repair needed
    return etl.dedup_lines(raw_lines(spark, sf_dir)).transform(etl.fix_quantity).select(*RAW_COLUMNS)


@register("recompute_revenue", O.with_stage("recomputed", f"SELECT {O.RAW_COLS} FROM recomputed"))
def q_recompute_revenue(spark, sf_dir):
    return (etl.dedup_lines(raw_lines(spark, sf_dir))
               .transform(etl.impute_price_median)
               .transform(etl.fix_quantity)
               .transform(etl.recompute_revenue).select(*RAW_COLUMNS))


@register("backfill_region", O.with_stage("dedup", f"SELECT {_REPAIRED_REGION} FROM dedup"))
def q_backfill_region(spark, sf_dir):
    return etl.dedup_lines(raw_lines(spark, sf_dir)).transform(etl.backfill_region).select(*RAW_COLUMNS)


@register("time_dimensions", O.on_fact(
    "SELECT order_id, customer_id, order_date, sku, order_year, order_month, order_quarter, "
    "day_of_week FROM fact"))
def q_time_dimensions(spark, sf_dir):
    # the date parts on their own: over the deduplicated lines, no other repair needed
    return (etl.dedup_lines(raw_lines(spark, sf_dir))
               .transform(etl.time_dimensions)
               .select("order_id", "customer_id", "order_date", "sku",
                       "order_year", "order_month", "order_quarter", "day_of_week"))


# ====================================================================== SQL layer
@register("monthly_revenue_mom", O.on_fact(f"""
SELECT order_month,
       CAST(rev AS DOUBLE) AS revenue,
       orders,
       {O.half_away("CAST(rev AS DOUBLE) / orders")} AS avg_order_value,
       {O.half_away("CAST(rev - lag(rev) OVER (ORDER BY order_month) AS DOUBLE)")} AS revenue_change,
       {O.half_away("100.0 * CAST(rev - lag(rev) OVER (ORDER BY order_month) AS DOUBLE)"
                    " / nullif(CAST(lag(rev) OVER (ORDER BY order_month) AS DOUBLE), 0)")} AS mom_growth_pct
FROM (SELECT order_month, {O.money_sum("net_revenue")} AS rev,
             count(DISTINCT order_id) AS orders
      FROM fact GROUP BY order_month) m"""))
def q_monthly_revenue_mom(spark, sf_dir):
    return sales.monthly_revenue_mom(_fact(spark, sf_dir))


@register("top_skus_per_category", O.on_fact("""
SELECT category, sku, total_revenue, units_sold, orders, revenue_rank FROM (
  SELECT *, rank() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS revenue_rank
  FROM (SELECT category, sku, CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT order_id) AS orders
        FROM fact GROUP BY category, sku) s) r
WHERE revenue_rank <= 3"""))
def q_top_skus_per_category(spark, sf_dir):
    return sales.top_skus_per_category(_fact(spark, sf_dir))


@register("regional_cumulative", O.on_fact(f"""
SELECT region, order_month, CAST(rev AS DOUBLE) AS revenue,
       CAST(sum(rev) OVER (PARTITION BY region ORDER BY order_month) AS DOUBLE) AS cumulative_revenue,
       {O.half_away("100.0 * CAST(rev AS DOUBLE) / nullif(CAST(sum(rev) OVER (PARTITION BY order_month) AS DOUBLE), 0)")}
         AS pct_of_month_total
FROM (SELECT region, order_month, {O.money_sum("net_revenue")} AS rev
      FROM fact GROUP BY region, order_month) t"""))
def q_regional_cumulative(spark, sf_dir):
    return sales.regional_cumulative(_fact(spark, sf_dir))


@register("customer_value_quartiles", O.on_fact("""
SELECT customer_id, order_count, lifetime_value, last_order_date,
       ntile(4) OVER (ORDER BY lifetime_value DESC, customer_id) AS value_quartile
FROM (SELECT customer_id, count(DISTINCT order_id) AS order_count,
             CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value,
             max(order_date) AS last_order_date
      FROM fact GROUP BY customer_id) c"""))
def q_customer_value_quartiles(spark, sf_dir):
    return sales.customer_value_quartiles(_fact(spark, sf_dir))


@register("return_rate_vs_avg", O.on_fact(f"""
SELECT category, total_orders, returned_orders,
       {O.half_away("100.0 * returned_orders / nullif(total_orders, 0)")} AS return_rate_pct,
       {O.half_away("100.0 * avg(CAST(returned_orders AS DOUBLE) / nullif(total_orders, 0)) OVER ()")}
         AS company_avg_return_rate_pct
FROM (SELECT category, count(*) AS total_orders, CAST(sum(is_returned) AS BIGINT) AS returned_orders
      FROM fact GROUP BY category) c"""))
def q_return_rate_vs_avg(spark, sf_dir):
    return sales.return_rate_vs_avg(_fact(spark, sf_dir))


@register("channel_payment_mix", O.on_fact(f"""
SELECT channel, payment_method, CAST(rev AS DOUBLE) AS revenue, orders,
       {O.half_away("100.0 * CAST(rev AS DOUBLE) / nullif(CAST(sum(rev) OVER () AS DOUBLE), 0)")}
         AS pct_of_total_revenue
FROM (SELECT channel, payment_method, {O.money_sum("net_revenue")} AS rev,
             count(DISTINCT order_id) AS orders
      FROM fact GROUP BY channel, payment_method) g"""))
def q_channel_payment_mix(spark, sf_dir):
    return sales.channel_payment_mix(_fact(spark, sf_dir))


# ====================================================================== payload
_REV = "CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue"
_AOV = "round_even(CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT order_id) * 100, 0) / 100"
_KPI_SELECT = f"""
SELECT CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS total_orders,
       count(*) AS total_records_analyzed,
       {_AOV} AS avg_order_value,
       round_even(100.0 * avg(is_returned) * 100, 0) / 100 AS return_rate_pct,
       count(DISTINCT customer_id) AS unique_customers
FROM fact"""
_WEEKDAYS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{d}', CAST({i + 1} AS BIGINT))" for i, d in enumerate(WEEKDAYS)) + ") t(day, day_index)"


def _money_label_sql(v: str) -> str:
    """The closest decimal to the exact binary value, the larger of two: printed with 25 digits, then rounded."""
    def fixed(x: str, digits: int) -> str:
        return f"CAST(round(CAST(printf('%.25f', CAST({x} AS DOUBLE)) AS DECIMAL(38, 25)), {digits}) AS DECIMAL(38, {digits}))"

    return (f"CASE WHEN {v} >= 1000000 THEN '$' || {fixed(f'{v} / 1000000.0', 2)} || 'M'"
            f" WHEN {v} >= 1000 THEN '$' || {fixed(f'{v} / 1000.0', 1)} || 'K'"
            f" ELSE '$' || {fixed(v, 0)} END")


@register("kpi_summary", O.on_fact(_KPI_SELECT))
def q_kpi_summary(spark, sf_dir):
    return payload.kpi_summary(_fact(spark, sf_dir))


@register("monthly_trend", O.on_fact(
    f"SELECT order_month AS month, {_REV} FROM fact WHERE order_month IS NOT NULL GROUP BY order_month"))
def q_monthly_trend(spark, sf_dir):
    return payload.monthly_trend(_fact(spark, sf_dir))


@register("region_category_revenue", O.on_fact(
    f"SELECT region, category, {_REV} FROM fact WHERE region IS NOT NULL AND category IS NOT NULL "
    "GROUP BY region, category"))
def q_region_category_revenue(spark, sf_dir):
    return payload.region_category_revenue(_fact(spark, sf_dir))


@register("region_drill_one", O.on_fact(
    f"SELECT region, category, {_REV} FROM fact WHERE category IS NOT NULL "
    "AND region = (SELECT min(region) FROM fact WHERE category IS NOT NULL) GROUP BY region, category"))
def q_region_drill_one(spark, sf_dir):
    return payload.region_drill_one(_fact(spark, sf_dir))


@register("region_list", O.on_fact(
    "SELECT region, region = min(region) OVER () AS is_default "
    "FROM (SELECT DISTINCT region FROM fact WHERE region IS NOT NULL) r"))
def q_region_list(spark, sf_dir):
    return payload.region_list(_fact(spark, sf_dir))


@register("top_skus_overall", O.on_fact(f"""
SELECT lpad(CAST(row_number() OVER (ORDER BY revenue DESC, category, sku) AS VARCHAR), 2, '0') AS rank,
       sku, category, revenue
FROM (SELECT category, sku, {_REV} FROM fact
      WHERE category IS NOT NULL AND sku IS NOT NULL GROUP BY category, sku) s
ORDER BY revenue DESC, category, sku LIMIT 10"""))
def q_top_skus_overall(spark, sf_dir):
    return payload.top_skus_overall(_fact(spark, sf_dir))


@register("channel_mix", O.on_fact(
    f"SELECT channel, {_REV} FROM fact WHERE channel IS NOT NULL GROUP BY channel"))
def q_channel_mix(spark, sf_dir):
    return payload.channel_mix(_fact(spark, sf_dir))


@register("region_totals", O.on_fact(
    f"SELECT region, {_REV} FROM fact WHERE region IS NOT NULL GROUP BY region"))
def q_region_totals(spark, sf_dir):
    return payload.region_totals(_fact(spark, sf_dir))


@register("day_of_week_revenue", O.on_fact(f"""
SELECT w.day, w.day_index, coalesce(d.revenue, 0.0) AS revenue
FROM ({_WEEKDAYS}) w
LEFT JOIN (SELECT day_of_week AS day, {_REV} FROM fact WHERE day_of_week IS NOT NULL
           GROUP BY day_of_week) d ON w.day = d.day"""))
def q_day_of_week_revenue(spark, sf_dir):
    return payload.day_of_week_revenue(_fact(spark, sf_dir))


_M = "CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2))"


@register("dashboard_payload", O.on_fact(f"""
SELECT to_json({{
  'kpi': (SELECT {{'total_revenue': CAST(total_revenue AS DECIMAL(18,2)),
                  'total_orders': total_orders,
                  'total_records_analyzed': total_records_analyzed,
                  'avg_order_value': CAST(avg_order_value AS DECIMAL(18,2)),
                  'return_rate_pct': return_rate_pct,
                  'unique_customers': unique_customers}} FROM k),
  'monthly_trend': (SELECT list({{'month': order_month, 'revenue': rev}} ORDER BY order_month)
                    FROM (SELECT order_month, {_M} AS rev FROM fact
                          WHERE order_month IS NOT NULL GROUP BY order_month) m),
  'region_drill': (SELECT map(list(region ORDER BY region), list(cats ORDER BY region))
                   FROM (SELECT region, list({{'category': category, 'revenue': rev}}
                                             ORDER BY rev DESC, category) AS cats
                         FROM (SELECT region, category, {_M} AS rev FROM fact
                               WHERE region IS NOT NULL AND category IS NOT NULL
                               GROUP BY region, category) rc GROUP BY region) r),
  'top_skus': (SELECT list({{'sku': sku, 'category': category, 'revenue': rev}}
                           ORDER BY rev DESC, category, sku)
               FROM (SELECT category, sku, {_M} AS rev FROM fact
                     WHERE category IS NOT NULL AND sku IS NOT NULL GROUP BY category, sku
                     ORDER BY rev DESC, category, sku LIMIT 10) t),
  'channel_mix': (SELECT list({{'channel': channel, 'revenue': rev}} ORDER BY channel)
                  FROM (SELECT channel, {_M} AS rev FROM fact WHERE channel IS NOT NULL
                        GROUP BY channel) c),
  'region_totals': (SELECT list({{'region': region, 'revenue': rev}} ORDER BY rev DESC, region)
                    FROM (SELECT region, {_M} AS rev FROM fact WHERE region IS NOT NULL
                          GROUP BY region) g),
  'day_of_week': (SELECT list({{'day': w.day, 'revenue': coalesce(d.rev, CAST(0 AS DECIMAL(18,2)))}}
                              ORDER BY w.day_index)
                  FROM ({_WEEKDAYS}) w
                  LEFT JOIN (SELECT day_of_week AS day, {_M} AS rev FROM fact
                             WHERE day_of_week IS NOT NULL GROUP BY day_of_week) d ON w.day = d.day),
  'manual_reporting_time_reduction_pct': 60
}}) AS payload""", extra_ctes=f"k AS ({_KPI_SELECT})"))
def q_dashboard_payload(spark, sf_dir):
    return payload.dashboard_payload(_fact(spark, sf_dir))


@register("payload_region_drill", O.on_fact(f"""
SELECT region, row_number() OVER (ORDER BY revenue DESC, category) - 1 AS position, category, revenue
FROM (SELECT region, category, {_REV} FROM fact WHERE category IS NOT NULL
      AND region = (SELECT min(region) FROM fact WHERE region IS NOT NULL AND category IS NOT NULL)
      GROUP BY region, category) r"""))
def q_payload_region_drill(spark, sf_dir):
    return payload.payload_region_drill(payload.dashboard_payload(_fact(spark, sf_dir)))


@register("payload_series", O.on_fact(f"""
SELECT 'kpi' AS series, CAST(pos AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS sub_pos, label,
       CAST(NULL AS VARCHAR) AS sub_label, value
FROM (SELECT * FROM (SELECT 0 AS pos, 'total_revenue' AS label, total_revenue AS value FROM k
       UNION ALL SELECT 1, 'total_orders', CAST(total_orders AS DOUBLE) FROM k
       UNION ALL SELECT 2, 'total_records_analyzed', CAST(total_records_analyzed AS DOUBLE) FROM k
       UNION ALL SELECT 3, 'avg_order_value', avg_order_value FROM k
       UNION ALL SELECT 4, 'return_rate_pct', return_rate_pct FROM k
       UNION ALL SELECT 5, 'unique_customers', CAST(unique_customers AS DOUBLE) FROM k) x) kk
UNION ALL
SELECT 'monthly_trend', row_number() OVER (ORDER BY order_month) - 1, NULL, order_month, NULL, revenue
FROM (SELECT order_month, {_REV} FROM fact WHERE order_month IS NOT NULL GROUP BY order_month) m
UNION ALL
SELECT 'region_drill',
       dense_rank() OVER (ORDER BY region) - 1,
       row_number() OVER (PARTITION BY region ORDER BY revenue DESC, category) - 1,
       region, category, revenue
FROM (SELECT region, category, {_REV} FROM fact WHERE region IS NOT NULL AND category IS NOT NULL
      GROUP BY region, category) rc
UNION ALL
SELECT 'top_skus', pos, NULL, sku, category, revenue FROM (
  SELECT row_number() OVER (ORDER BY revenue DESC, category, sku) - 1 AS pos, sku, category, revenue
  FROM (SELECT category, sku, {_REV} FROM fact WHERE category IS NOT NULL AND sku IS NOT NULL
        GROUP BY category, sku) s) t WHERE pos < 10
UNION ALL
SELECT 'channel_mix', row_number() OVER (ORDER BY channel) - 1, NULL, channel, NULL, revenue
FROM (SELECT channel, {_REV} FROM fact WHERE channel IS NOT NULL GROUP BY channel) c
UNION ALL
SELECT 'region_totals', row_number() OVER (ORDER BY revenue DESC, region) - 1, NULL, region, NULL, revenue
FROM (SELECT region, {_REV} FROM fact WHERE region IS NOT NULL GROUP BY region) r
UNION ALL
SELECT 'day_of_week', w.day_index - 1, NULL, w.day, NULL, coalesce(d.revenue, 0.0)
FROM ({_WEEKDAYS}) w
LEFT JOIN (SELECT day_of_week AS day, {_REV} FROM fact WHERE day_of_week IS NOT NULL
           GROUP BY day_of_week) d ON w.day = d.day
UNION ALL
SELECT 'manual_reporting_time_reduction_pct', 0, NULL, NULL, NULL, 60.0""",
    extra_ctes=f"k AS ({_KPI_SELECT})"))
def q_payload_series(spark, sf_dir):
    return payload.payload_series(payload.dashboard_payload(_fact(spark, sf_dir)))


@register("kpi_board", O.on_fact(f"""
SELECT CAST(position AS BIGINT) AS position, label, value FROM (
  SELECT 1 AS position, 'Total Net Revenue' AS label, {_money_label_sql("total_revenue")} AS value FROM k
  UNION ALL SELECT 2, 'Transactions Analyzed', format('{{:,}}', total_records_analyzed) || '+' FROM k
  UNION ALL SELECT 3, 'Avg Order Value', printf('$%.2f', avg_order_value) FROM k
  UNION ALL SELECT 4, 'Unique Customers', format('{{:,}}', unique_customers) FROM k
  UNION ALL SELECT 5, 'Manual Reporting Time Cut', '60%' FROM k) t""",
    extra_ctes=f"k AS ({_KPI_SELECT})"))
def q_kpi_board(spark, sf_dir):
    return payload.kpi_board(_fact(spark, sf_dir))


@register("money_label", O.on_fact(f"""
SELECT category, sku, revenue AS amount, {_money_label_sql("revenue")} AS label
FROM (SELECT category, sku, {_REV} FROM fact WHERE category IS NOT NULL AND sku IS NOT NULL
      GROUP BY category, sku) s"""))
def q_money_label(spark, sf_dir):
    return payload.money_labels(_fact(spark, sf_dir))


# ====================================================================== quality report
def _reason_case(u: str) -> str:
    """The draw written out: the running sums of the seven weights."""
    return f"""CASE WHEN {u} < CAST(0.27 AS DOUBLE) THEN 'Quality Defect - Item Damaged'
                WHEN {u} < CAST(0.45 AS DOUBLE) THEN 'Wrong Item Shipped'
                WHEN {u} < CAST(0.61 AS DOUBLE) THEN 'Size / Fit Issue'
                WHEN {u} < CAST(0.75 AS DOUBLE) THEN 'Damaged in Transit'
                WHEN {u} < CAST(0.85 AS DOUBLE) THEN 'Late Delivery - Order Cancelled'
                WHEN {u} < CAST(0.93 AS DOUBLE) THEN 'Packaging Failure'
                ELSE 'Customer Changed Mind' END"""


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


_U = (f"CAST(('0x' || substr(md5('{DEFAULT_DRAW_SEED}:' || concat_ws('|', order_id, customer_id, "
      "order_date, sku)), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0")
_ENRICHED = f"""
drawn AS (SELECT *, {_reason_case(_U)} AS defect_reason FROM fact WHERE is_returned = 1),
enriched AS (
  SELECT *, quantity AS adjustment_qty, net_revenue AS adjustment_value,
         CASE WHEN defect_reason IN ({_in(HIGH_SEVERITY)}) THEN 'High'
              WHEN defect_reason IN ({_in(MEDIUM_SEVERITY)}) THEN 'Medium' ELSE 'Low' END AS severity
  FROM drawn)"""
_PARETO = """
pareto AS (
  SELECT row_number() OVER (ORDER BY orders DESC, defect_reason) AS rank, defect_reason, orders,
         adjustment_value, pct_of_total,
         round_even(sum(pct_of_total) OVER (ORDER BY orders DESC, defect_reason
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 10, 0) / 10 AS cumulative_pct
  FROM (SELECT *, round_even(CAST(orders AS DOUBLE) / sum(orders) OVER () * 100.0 * 10, 0) / 10 AS pct_of_total
        FROM (SELECT defect_reason, count(order_id) AS orders,
                     CAST(sum(CAST(adjustment_value AS DECIMAL(18,2))) AS DOUBLE) AS adjustment_value
              FROM enriched GROUP BY defect_reason) g) p)"""


def _rate_sql(key: str) -> str:
    return (f"SELECT {key}, count(*) AS orders, CAST(sum(is_returned) AS BIGINT) AS returns, "
            f"round_even(avg(is_returned) * 100.0 * 100, 0) / 100 AS defect_rate_pct "
            f"FROM fact WHERE {key} IS NOT NULL GROUP BY {key}")


def _top_reason_sql(key: str) -> str:
    return (f"SELECT {key}, defect_reason AS top_defect_reason FROM ("
            f"SELECT {key}, defect_reason, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY n DESC, defect_reason) AS rk FROM (SELECT {key}, defect_reason, count(*) AS n "
            f"FROM enriched WHERE {key} IS NOT NULL GROUP BY {key}, defect_reason) c) t WHERE rk = 1")


def _report_select(key: str) -> str:
    return f"""
SELECT r.{key}, orders, returns, defect_rate_pct, top_defect_reason,
       (defect_rate_pct - min(defect_rate_pct) OVER ())
         / nullif(max(defect_rate_pct) OVER () - min(defect_rate_pct) OVER (), 0) AS rate_scale
FROM ({_rate_sql(key)}) r LEFT JOIN ({_top_reason_sql(key)}) t ON r.{key} = t.{key}"""


def _report_sql(key: str) -> str:
    return O.on_fact(_report_select(key), _ENRICHED)


@register("returned_lines", O.on_fact(f"SELECT {O.FACT_COLS} FROM fact WHERE is_returned = 1"))
def q_returned_lines(spark, sf_dir):
    return quality.returned_lines(_fact(spark, sf_dir))


@register("weighted_choice", O.on_fact(
    "SELECT order_id, customer_id, order_date, sku, defect_reason FROM enriched", _ENRICHED))
def q_weighted_choice(spark, sf_dir):
    return (quality.draw_defect_reason(quality.returned_lines(_fact(spark, sf_dir)))
                   .select("order_id", "customer_id", "order_date", "sku", "defect_reason"))


@register("defect_enriched", O.on_fact(
    f"SELECT {O.FACT_COLS}, defect_reason, adjustment_qty, adjustment_value, severity FROM enriched",
    _ENRICHED))
def q_defect_enriched(spark, sf_dir):
    return quality.defect_enriched(_fact(spark, sf_dir))


@register("defect_severity", O.on_fact(
    "SELECT order_id, customer_id, order_date, sku, defect_reason, severity FROM enriched", _ENRICHED))
def q_defect_severity(spark, sf_dir):
    return (quality.defect_enriched(_fact(spark, sf_dir))
                   .select("order_id", "customer_id", "order_date", "sku", "defect_reason", "severity"))


@register("defect_pareto", O.on_fact("SELECT * FROM pareto", _ENRICHED + "," + _PARETO))
def q_defect_pareto(spark, sf_dir):
    return quality.defect_pareto(quality.defect_enriched(_fact(spark, sf_dir)))


@register("defect_rate_by_category", O.on_fact(_rate_sql("category")))
def q_defect_rate_by_category(spark, sf_dir):
    return quality.defect_rate_by(_fact(spark, sf_dir), "category")


@register("defect_rate_by_region", O.on_fact(_rate_sql("region")))
def q_defect_rate_by_region(spark, sf_dir):
    return quality.defect_rate_by(_fact(spark, sf_dir), "region")


@register("top_defect_reason_by_category", O.on_fact(_top_reason_sql("category"), _ENRICHED))
def q_top_defect_reason_by_category(spark, sf_dir):
    return quality.top_defect_reason_by(quality.defect_enriched(_fact(spark, sf_dir)), "category")


@register("top_defect_reason_by_region", O.on_fact(_top_reason_sql("region"), _ENRICHED))
def q_top_defect_reason_by_region(spark, sf_dir):
    return quality.top_defect_reason_by(quality.defect_enriched(_fact(spark, sf_dir)), "region")


@register("report_by_category", _report_sql("category"))
def q_report_by_category(spark, sf_dir):
    return quality.report_by(_fact(spark, sf_dir), "category")


@register("report_by_region", _report_sql("region"))
def q_report_by_region(spark, sf_dir):
    return quality.report_by(_fact(spark, sf_dir), "region")


@register("report_adjustment_log", O.on_fact("""
SELECT order_id, order_date, region, category, sku, defect_reason, severity, adjustment_qty,
       adjustment_value, severity = 'High' AS is_high
FROM enriched ORDER BY order_date DESC, order_id, sku LIMIT 500""", _ENRICHED))
def q_report_adjustment_log(spark, sf_dir):
    return quality.adjustment_log(quality.defect_enriched(_fact(spark, sf_dir)))


_SUMMARY = """
SELECT CAST(position AS BIGINT) AS position, label, value FROM (
  SELECT 1 AS position, 'Total Orders' AS label, format('{:,}', (SELECT count(*) FROM fact)) AS value
  UNION ALL SELECT 2, 'Total Returns / Adjustments', format('{:,}', (SELECT count(*) FROM enriched))
  UNION ALL SELECT 3, 'Overall Return Rate',
    printf('%.2f%%', round_even(CAST((SELECT count(*) FROM enriched) AS DOUBLE)
                                / (SELECT count(*) FROM fact) * 100.0 * 100, 0) / 100)
  UNION ALL SELECT 4, 'Total Adjustment Value ($)',
    '$' || format('{:,}', CAST(round_even((SELECT coalesce(CAST(sum(CAST(adjustment_value AS DECIMAL(18,2)))
                                          AS DOUBLE), 0.0) FROM enriched), 0) AS BIGINT))
  UNION ALL SELECT 5, '#1 Root Cause', (SELECT defect_reason FROM pareto WHERE rank = 1)
  UNION ALL SELECT 6, '#1 Root Cause Share of Returns',
    (SELECT CAST(pct_of_total AS VARCHAR) || '%' FROM pareto WHERE rank = 1)) t"""


@register("report_summary", O.on_fact(_SUMMARY, _ENRICHED + "," + _PARETO))
def q_report_summary(spark, sf_dir):
    return quality.report_summary(_fact(spark, sf_dir))


# ====================================================================== statistics
def _r6(expr: str) -> str:
    return O.half_away(expr, 6)


def _q7_sql(src: str, value: str, probs: dict[str, float], group: str | None = None) -> str:
    """Type-7 quantiles by row positions (oracle only; the Spark side is distributed)."""
    part = f"PARTITION BY {group}" if group else ""
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    cols = []
    for name, p in probs.items():
        idx = f"((n - 1) * CAST({p!r} AS DOUBLE))"
        lo = f"max(CASE WHEN pos = floor({idx}) THEN v END)"
        hi = f"max(CASE WHEN pos = ceil({idx}) THEN v END)"
        h = f"max({idx} - floor({idx}))"
        cols.append(f"CASE WHEN {h} = 0 OR {lo} = {hi} THEN {lo} "
                    f"ELSE (1.0 - {h}) * {lo} + {h} * {hi} END AS {name}")
    return (f"SELECT {gsel}max(n) AS n, {', '.join(cols)} FROM ("
            f"SELECT {gsel}{value} AS v, row_number() OVER ({part} ORDER BY {value}) - 1 AS pos, "
            f"count(*) OVER ({part}) AS n FROM {src}) r {gby}")


_FENCES = f"""
logv AS (SELECT *, log10(net_revenue) AS y FROM fact WHERE net_revenue > 0),
qs AS ({_q7_sql("logv", "y", {"q1": 0.25, "med": 0.5, "q3": 0.75}, "category")}),
fences AS (SELECT category, n, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo_fence,
                  q3 + 1.5 * (q3 - q1) AS hi_fence FROM qs)"""


@register("order_value_stats", O.on_fact(f"""
SELECT m.n AS n, {_r6("m.s / m.n")} AS mean_order_value, {_r6("q.median")} AS median_order_value,
       {_r6("m.sd")} AS sd_order_value, {_r6("q.p90")} AS p90, {_r6("q.p99")} AS p99
FROM (SELECT count(*) AS n, CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS s,
             stddev_samp(net_revenue) AS sd FROM fact) m,
     ({_q7_sql("fact", "net_revenue", {"median": 0.5, "p90": 0.9, "p99": 0.99})}) q"""))
def q_order_value_stats(spark, sf_dir):
    return stats.order_value_stats(_fact(spark, sf_dir))


@register("boxplot_by_category", O.on_fact(f"""
SELECT f.category, f.n, a.lower_whisker, {_r6("pow(10.0, f.q1)")} AS q1,
       {_r6("pow(10.0, f.med)")} AS median, {_r6("pow(10.0, f.q3)")} AS q3, a.upper_whisker,
       a.n_outliers, coalesce(d.n_dropped, 0) AS n_dropped
FROM fences f
LEFT JOIN (SELECT l.category,
                  min(CASE WHEN y >= lo_fence AND y <= hi_fence THEN net_revenue END) AS lower_whisker,
                  max(CASE WHEN y >= lo_fence AND y <= hi_fence THEN net_revenue END) AS upper_whisker,
                  count_if(NOT (y >= lo_fence AND y <= hi_fence)) AS n_outliers
           FROM logv l LEFT JOIN fences f2 ON l.category IS NOT DISTINCT FROM f2.category GROUP BY l.category) a
  ON f.category IS NOT DISTINCT FROM a.category
LEFT JOIN (SELECT category, count(*) AS n_dropped FROM fact
           WHERE NOT coalesce(net_revenue > 0, false) GROUP BY category) d
  ON f.category IS NOT DISTINCT FROM d.category""",
    _FENCES))
def q_boxplot_by_category(spark, sf_dir):
    return stats.boxplot_by_category(_fact(spark, sf_dir))


@register("boxplot_outliers", O.on_fact("""
SELECT order_id, customer_id, order_date, sku, l.category, net_revenue,
       CASE WHEN y < lo_fence THEN 'low' ELSE 'high' END AS side
FROM logv l JOIN fences f ON l.category IS NOT DISTINCT FROM f.category
WHERE y < lo_fence OR y > hi_fence""", _FENCES))
def q_boxplot_outliers(spark, sf_dir):
    return stats.boxplot_outliers(_fact(spark, sf_dir))


_WEEKLY = """
SELECT order_date - CAST(dayofweek(order_date) AS INTEGER) AS week,
       CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM fact GROUP BY order_date - CAST(dayofweek(order_date) AS INTEGER)"""


@register("weekly_revenue", O.on_fact(_WEEKLY))
def q_weekly_revenue(spark, sf_dir):
    return stats.weekly_revenue(_fact(spark, sf_dir))


@register("loess_trend", O.on_fact("""
SELECT point, x0 AS x, DATE '1970-01-01' + CAST(floor(x0) AS INTEGER) AS week,
       round(CAST((t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2))
             / nullif(s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2), 0)
             AS DOUBLE) * 100, 0) / 100 AS fitted_revenue
FROM (SELECT point, x0, sum(wt) AS s0, sum(wt * dx) AS s1, sum(wt * (dx * dx)) AS s2,
             sum(wt * ((dx * dx) * dx)) AS s3, sum(wt * ((dx * dx) * (dx * dx))) AS s4,
             sum(wt * y) AS t0, sum(wt * y * dx) AS t1, sum(wt * y * (dx * dx)) AS t2
      FROM (SELECT point, x0, y, (x - x0) / h AS dx,
                   CASE WHEN abs((x - x0) / h) < 1
                        THEN (1.0 - abs((x - x0) / h) * abs((x - x0) / h) * abs((x - x0) / h))
                           * (1.0 - abs((x - x0) / h) * abs((x - x0) / h) * abs((x - x0) / h))
                           * (1.0 - abs((x - x0) / h) * abs((x - x0) / h) * abs((x - x0) / h))
                        ELSE 0.0 END AS wt
            FROM (SELECT d.*, max(CASE WHEN r = q THEN dd END) OVER (PARTITION BY point) AS h
                  FROM (SELECT g.point, g.x0, g.q, p.x, p.y, abs(p.x - g.x0) AS dd,
                               row_number() OVER (PARTITION BY g.point ORDER BY abs(p.x - g.x0), p.x) AS r
                        FROM grid g, pts p) d) e) w
      GROUP BY point, x0) m""", f"""
wk AS ({_WEEKLY}),
pts AS (SELECT CAST(week - DATE '1970-01-01' AS DOUBLE) AS x, revenue AS y FROM wk),
info AS (SELECT min(x) AS xmin, max(x) AS xmax, count(*) AS n FROM pts),
grid AS (SELECT CAST(i AS BIGINT) AS point,
                xmin + CAST(i AS DOUBLE) * ((xmax - xmin) / CAST(79 AS DOUBLE)) AS x0,
                least(CAST(floor(n * CAST(0.15 AS DOUBLE) + CAST(0.00001 AS DOUBLE)) AS BIGINT), n) AS q
         FROM info, range(80) t(i))"""))
def q_loess_trend(spark, sf_dir):
    return smoothing.loess_trend(stats.weekly_revenue(_fact(spark, sf_dir)))


@register("return_rate_by_discount", O.on_fact(
    "SELECT discount_pct, avg(is_returned) AS return_rate, count(*) AS n FROM fact GROUP BY discount_pct"))
def q_return_rate_by_discount(spark, sf_dir):
    return stats.return_rate_by_discount(_fact(spark, sf_dir))


# ====================================================================== sampling, I/O
_SAMPLE = f"""
SELECT {O.FACT_COLS} FROM fact
ORDER BY md5('1:' || concat_ws('|', order_id, customer_id, order_date, sku)),
         order_id, customer_id, order_date, sku
LIMIT 300"""


@register("sample_rows", O.on_fact(_SAMPLE))
def q_sample_rows(spark, sf_dir):
    return sampling.sample_rows(_fact(spark, sf_dir))


@register("union_all_lines", O.on_fact(
    f"SELECT {O.FACT_COLS} FROM fact UNION ALL SELECT * FROM ({_SAMPLE}) s"))
def q_union_all_lines(spark, sf_dir):
    return sampling.with_duplicates(_fact(spark, sf_dir))


@register("seasonal_multiplier", O.on_fact("""
SELECT order_date, CAST(dayofyear(order_date) AS INTEGER) AS day_of_year,
       CASE WHEN dayofyear(order_date) >= 320 OR dayofyear(order_date) <= 5 THEN 1.55
            WHEN dayofyear(order_date) BETWEEN 150 AND 175 THEN 1.25 ELSE 1.0 END::DOUBLE AS multiplier
FROM (SELECT DISTINCT order_date FROM fact WHERE order_date IS NOT NULL) d"""))
def q_seasonal_multiplier(spark, sf_dir):
    return sampling.seasonal_multipliers(_fact(spark, sf_dir))


@register("csv_ingest", O.with_stage("raw", f"SELECT {O.RAW_COLS} FROM raw"))
def q_csv_ingest(spark, sf_dir):
    return csv_export.csv_round_trip(raw_lines(spark, sf_dir), scratch_dir(spark, "raw_export_csv"))


@register("csv_defective_export", O.with_stage("raw", f"""
SELECT {_raw_columns(
    region="CASE WHEN order_id % 5 = 0 THEN NULL ELSE region END",
    unit_price="CASE WHEN order_id % 7 IN (1, 2) THEN NULL ELSE unit_price END",
    discount_pct="CASE WHEN order_id % 11 = 3 THEN NULL ELSE discount_pct END")},
       (CASE WHEN order_id % 7 = 2 THEN 1 ELSE 0 END) + (CASE WHEN order_id % 11 = 3 THEN 1 ELSE 0 END)
         AS unparsed_fields
FROM raw"""))
def q_csv_defective_export(spark, sf_dir):
    # numbers as 2.0, dates with a time, missing-value tokens in text and number columns, and fields that are no number
    raw = raw_lines(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    n = F.col("order_id").cast("bigint")
    dirty = raw.withColumns({
        "quantity": F.concat("quantity", F.lit(".0")),
        "order_date": F.concat("order_date", F.lit(" 00:00:00")),
        "region": F.when(n % 5 == 0, F.lit("N/A")).otherwise(F.col("region")),
        "unit_price": F.when(n % 7 == 1, F.lit("NaN")).when(n % 7 == 2, F.lit("abc")).otherwise(F.col("unit_price")),
        "discount_pct": F.when(n % 11 == 3, F.lit("1.5")).otherwise(F.col("discount_pct")),
    })
    path = csv_export.write_csv(dirty, scratch_dir(spark, "defective_export_csv"))
    return csv_export.read_csv_export(spark, path, count_unparsed=True)


@register("warehouse_load", O.on_fact(f"SELECT {O.FACT_COLS} FROM fact"))
def q_warehouse_load(spark, sf_dir):
    # a first load of the exports without their latest orders, then the full export replaces the whole table
    path = scratch_dir(spark, "warehouse_load")
    raw = raw_lines(spark, sf_dir)
    warehouse.load_fact(raw.where("order_date < '1996-01-01'"), path)
    warehouse.load_fact(raw, path)
    return warehouse.read_fact(spark, path)


_REPORTS = f"""
by_category AS ({_report_select("category")}),
by_region AS ({_report_select("region")}),
log AS (SELECT * FROM enriched ORDER BY order_date DESC, order_id, sku LIMIT 500)"""


@register("report_tables", O.on_fact(f"""
SELECT 'summary' AS "table", position AS row_number, label AS key, value AS text, CAST(NULL AS BIGINT) AS n1,
       CAST(NULL AS BIGINT) AS n2, CAST(NULL AS DOUBLE) AS v1, CAST(NULL AS DOUBLE) AS v2 FROM ({_SUMMARY}) s
UNION ALL SELECT 'root_cause_pareto', rank, defect_reason, NULL, orders, NULL, adjustment_value, cumulative_pct
FROM pareto
UNION ALL SELECT 'by_category', row_number() OVER (ORDER BY defect_rate_pct DESC, category), category,
       top_defect_reason, orders, returns, defect_rate_pct, rate_scale FROM by_category
UNION ALL SELECT 'by_region', row_number() OVER (ORDER BY defect_rate_pct DESC, region), region,
       top_defect_reason, orders, returns, defect_rate_pct, rate_scale FROM by_region
UNION ALL SELECT 'adjustment_log', row_number() OVER (ORDER BY order_date DESC, order_id, sku), sku,
       concat_ws('|', CAST(order_date AS VARCHAR), region, category, defect_reason, severity), order_id, adjustment_qty,
       adjustment_value, NULL FROM log""", ",".join([_ENRICHED, _PARETO, _REPORTS])))
def q_report_tables(spark, sf_dir):
    paths = sinks.write_report(quality.quality_report(_fact(spark, sf_dir)), scratch_dir(spark, "quality_report"))
    return sinks.read_report_rows(spark, paths)


@register("payload_file_series", ORACLE["payload_series"])
def q_payload_file_series(spark, sf_dir):
    path = sinks.write_payload_json(payload.dashboard_payload(_fact(spark, sf_dir)),
                                    scratch_dir(spark, "dashboard_payload"))
    text = spark.read.text(path).select(F.col("value").alias("payload"))
    return payload.payload_series(text)


@register("stream_daily_ingest", O.on_fact(f"SELECT {O.FACT_COLS} FROM fact"))
def q_stream_daily_ingest(spark, sf_dir):
    base = fresh_dir(spark, "daily_ingest")
    landing = daily_ingest.drop_exports(raw_lines(spark, sf_dir), f"{base}/landing")
    daily_ingest.run_daily_ingest(spark, landing, f"{base}/lines", f"{base}/checkpoint", max_files_per_trigger=40)
    # a second load: the same drops again under a new checkpoint add nothing
    daily_ingest.run_daily_ingest(spark, landing, f"{base}/lines", f"{base}/checkpoint-2")
    return daily_ingest.fact_from_lines(spark, f"{base}/lines")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw export -> clean fact -> monthly revenue with MoM growth, all in one plan."""
    configure(spark)
    return sales.monthly_revenue_mom(etl.clean_fact(raw_lines(spark, sf_dir)))


__all__ = ["QUERIES", "ORACLE", "flagship"]

from . import catalog_storage  # noqa: E402, F401  (registers further queries)
