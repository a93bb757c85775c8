"""Quality and inventory-adjustment root-cause report.

Returned lines get a defect reason drawn from a fixed, weighted taxonomy; the
report is a Pareto table of reasons, defect rates with the most frequent
reason per category and per region, a recent-adjustments log and a summary.

The draw is a hash of the line key (see ``functions.hashing``), so the
returned lines never need to be shuffled or ordered to be enriched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formatting import dollars_label, percent_label, thousands
from ..functions.hashing import hash_uniform, weighted_choice
from ..functions.money import money_sum, rint_round
from ..schema import (ADJUSTMENT_LOG_COLUMNS, DEFAULT_DRAW_SEED, DEFAULT_LOG_ROWS, DEFECT_REASONS, HIGH_SEVERITY,
                      LINE_KEY, MEDIUM_SEVERITY, REPORT_SUMMARY_LABELS, SEVERITY_HIGH, SEVERITY_LOW,
                      SEVERITY_MEDIUM)

def returned_lines(fact: DataFrame) -> DataFrame:
    """Lines flagged as returned (the filter is pushed into the Parquet scan)."""
    return fact.where(F.col("is_returned") == 1)


def draw_defect_reason(df: DataFrame, seed: int = DEFAULT_DRAW_SEED,
                       reasons: list[tuple[str, float]] | None = None) -> DataFrame:
    u = hash_uniform(seed, *LINE_KEY)
    return df.withColumn("defect_reason", weighted_choice(u, reasons or DEFECT_REASONS))


def severity(reason: Column) -> Column:
    return (F.when(reason.isin(*HIGH_SEVERITY), F.lit(SEVERITY_HIGH))
             .when(reason.isin(*MEDIUM_SEVERITY), F.lit(SEVERITY_MEDIUM))
             .otherwise(F.lit(SEVERITY_LOW)))


def defect_enriched(fact: DataFrame, seed: int = DEFAULT_DRAW_SEED) -> DataFrame:
    """Returned lines + defect_reason, adjustment_qty, adjustment_value, severity."""
    r = draw_defect_reason(returned_lines(fact), seed)
    return r.withColumns({
        "adjustment_qty": F.col("quantity"),
        "adjustment_value": F.col("net_revenue"),
        "severity": severity(F.col("defect_reason")),
    })


# ------------------------------------------------------------------ Pareto
def defect_pareto(enriched: DataFrame) -> DataFrame:
    """Reasons by number of returns: share of all returns and cumulative share.

    Shares are rounded to one digit first and the cumulative column sums the
    rounded shares in rank order, then rounds again, as the reference does.
    """
    g = (enriched.groupBy("defect_reason")
                 .agg(F.count("order_id").alias("orders"),
                      money_sum("adjustment_value").cast("double").alias("adjustment_value")))
    total = F.sum("orders").over(Window.partitionBy())
    order = [F.col("orders").desc(), F.col("defect_reason").asc()]
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (g.withColumn("pct_of_total",
                         rint_round(F.col("orders") / total * F.lit(100.0), 1))
             .withColumn("cumulative_pct", rint_round(F.sum("pct_of_total").over(running), 1))
             .withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
             .select("rank", "defect_reason", "orders", "adjustment_value",
                     "pct_of_total", "cumulative_pct")
             .orderBy("rank"))


# ------------------------------------------------------------------ by key
def with_reason(fact: DataFrame, seed: int = DEFAULT_DRAW_SEED) -> DataFrame:
    """All lines with the reason of the returned ones; lines that were kept have none."""
    u = hash_uniform(seed, *LINE_KEY)
    return fact.withColumn("defect_reason", F.when(F.col("is_returned") == 1, weighted_choice(u, DEFECT_REASONS)))


def defect_rate_by(fact: DataFrame, key: str) -> DataFrame:
    """orders, returns and defect rate (% of lines returned) per key, rate descending; null keys dropped."""
    return (fact.where(F.col(key).isNotNull())
                .groupBy(key)
                .agg(F.count(F.lit(1)).alias("orders"),
                     F.sum("is_returned").cast("bigint").alias("returns"),
                     F.avg("is_returned").alias("_rate"))
                .select(key, "orders", "returns",
                        rint_round(F.col("_rate") * F.lit(100.0), 2).alias("defect_rate_pct"))
                .orderBy(F.col("defect_rate_pct").desc(), key))


def top_defect_reason_by(enriched: DataFrame, key: str) -> DataFrame:
    """Most frequent reason per key, by key; ties go to the alphabetically first reason.

    Counts are per (key, reason) — a handful of rows per key — so the choice
    is made over an aggregate, whatever the size of the input.
    """
    c = (enriched.where(F.col(key).isNotNull())
                 .groupBy(key, "defect_reason").agg(F.count(F.lit(1)).alias("_n")))
    return (c.groupBy(key).agg(F.min(F.struct(-F.col("_n"), "defect_reason"))["defect_reason"]
                               .alias("top_defect_reason"))
             .orderBy(key))


def report_by(fact: DataFrame, key: str, seed: int = DEFAULT_DRAW_SEED) -> DataFrame:
    """Defect rate + top reason per key, rate descending, with a 0..1 colour-scale position.

    One scan: lines are counted by (key, reason), and a key's figures are folded from its few counts.
    """
    counts = (with_reason(fact, seed).where(F.col(key).isNotNull()).groupBy(key, "defect_reason")
              .agg(F.count(F.lit(1)).alias("_n"), F.count("is_returned").alias("_known"),
                   F.sum("is_returned").alias("_returns")))
    top = F.min(F.when(F.col("defect_reason").isNotNull(), F.struct(-F.col("_n"), "defect_reason")))
    rates = counts.groupBy(key).agg(
        F.sum("_n").alias("orders"), F.sum("_returns").cast("bigint").alias("returns"),
        rint_round(F.try_divide(F.sum("_returns").cast("double"), F.sum("_known").cast("double")) * F.lit(100.0), 2)
        .alias("defect_rate_pct"),
        top["defect_reason"].alias("top_defect_reason"))
    all_rows = Window.partitionBy()
    lo, hi = F.min("defect_rate_pct").over(all_rows), F.max("defect_rate_pct").over(all_rows)
    return (rates.withColumn("rate_scale", F.try_divide(F.col("defect_rate_pct") - lo, hi - lo))
                 .select(key, "orders", "returns", "defect_rate_pct", "top_defect_reason", "rate_scale")
                 .orderBy(F.col("defect_rate_pct").desc(), key))


# ------------------------------------------------------------------ log + summary
def adjustment_log(enriched: DataFrame, rows: int = DEFAULT_LOG_ROWS) -> DataFrame:
    """The most recent ``rows`` adjustments (date descending, then order id and sku)."""
    return (enriched.select(*ADJUSTMENT_LOG_COLUMNS)
                    .orderBy(F.col("order_date").desc(), F.col("order_id").asc(), F.col("sku").asc())
                    .limit(rows)
                    .withColumn("is_high", F.col("severity") == F.lit(SEVERITY_HIGH)))


def report_summary(fact: DataFrame, seed: int = DEFAULT_DRAW_SEED) -> DataFrame:
    """Six headline figures as (position, label, value) text, from one aggregate of eight rows (reason or none)."""
    by_reason = with_reason(fact, seed).groupBy("defect_reason").agg(
        F.count(F.lit(1)).alias("_n"), F.count("order_id").alias("_orders"), money_sum("net_revenue").alias("_value"))
    returned = F.col("defect_reason").isNotNull()
    row = by_reason.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum(F.when(returned, F.col("_n"))), F.lit(0)).alias("total_returns"),
        F.sum(F.when(returned, F.col("_value"))).cast("double").alias("adj_value"),
        F.sum(F.when(returned, F.col("_orders"))).alias("_all"),
        F.min(F.when(returned, F.struct((-F.col("_orders")).alias("less"), "defect_reason"))).alias("_top")).select(
        "total_orders", "total_returns", "adj_value", F.col("_top.defect_reason").alias("top_reason"),
        rint_round(F.try_divide(-F.col("_top.less").cast("double"), F.col("_all").cast("double"))
                   * F.lit(100.0), 1).alias("top_share"))
    rate = F.try_divide(F.col("total_returns").cast("double"), F.col("total_orders").cast("double"))

    def line(pos, label, value):
        return F.struct(F.lit(pos).cast("bigint").alias("position"), F.lit(label).alias("label"),
                        value.alias("value"))

    orders, returns, rate_l, value_l, top_l, share_l = REPORT_SUMMARY_LABELS
    return row.select(F.inline(F.array(
        line(1, orders, thousands(F.col("total_orders"))),
        line(2, returns, thousands(F.col("total_returns"))),
        line(3, rate_l, percent_label(rate, 2)),
        line(4, value_l, dollars_label(F.coalesce(F.col("adj_value"), F.lit(0.0)))),
        line(5, top_l, F.col("top_reason")),
        line(6, share_l, F.concat(F.col("top_share").cast("string"), F.lit("%"))),
    )))


def quality_report(fact: DataFrame, seed: int = DEFAULT_DRAW_SEED,
                   log_rows: int = DEFAULT_LOG_ROWS) -> dict[str, DataFrame]:
    """The five report tables, keyed by sheet name; each is one pass over the columns it needs."""
    enriched = defect_enriched(fact, seed)
    return {
        "summary": report_summary(fact, seed),
        "root_cause_pareto": defect_pareto(enriched),
        "by_category": report_by(fact, "category", seed),
        "by_region": report_by(fact, "region", seed),
        "adjustment_log": adjustment_log(enriched, log_rows),
    }
