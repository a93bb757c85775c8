"""Distribution statistics of the R layer: order value, log-scale boxplots,
weekly revenue and return rate by discount depth.

R semantics: ``quantile`` type 7, ``sd`` with n - 1, dplyr groups keep NA keys.
Figures whose last bits depend on summation order are rounded to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_start_sunday
from ..functions.money import half_away_round, money_sum
from ..plans.physical import one_row
from ..plans.quantiles import exact_quantiles, quantiles_of_histogram

STAT_DIGITS = 6
WHISKER_COEF = 1.5


def _r6(c: Column) -> Column:
    return half_away_round(c, STAT_DIGITS)


def order_value_stats(fact: DataFrame, probs: tuple[float, float] = (0.90, 0.99)) -> DataFrame:
    """n, mean, median, sd, p90, p99 of line net revenue (one row)."""
    p_hi, p_top = probs
    moments = fact.agg(F.count(F.lit(1)).alias("n"),
                       money_sum("net_revenue").cast("double").alias("_sum"),
                       F.stddev_samp("net_revenue").alias("sd"))
    q = exact_quantiles(fact, "net_revenue", {"median": 0.5, "p90": p_hi, "p99": p_top})
    row = one_row({"m": moments.select(F.struct("*")), "q": q.select(F.struct("median", "p90", "p99"))})
    return row.select(
        F.col("m.n").alias("n"),
        _r6(F.try_divide(F.col("m._sum"), F.col("m.n").cast("double"))).alias("mean_order_value"),
        _r6(F.col("q.median")).alias("median_order_value"),
        _r6(F.col("m.sd")).alias("sd_order_value"),
        _r6(F.col("q.p90")).alias("p90"),
        _r6(F.col("q.p99")).alias("p99"),
    )


def _value_counts(fact: DataFrame) -> DataFrame:
    """(category, net_revenue) -> count, and ``_y``: log10 of the positive amounts, all that a log scale shows."""
    return (fact.groupBy("category", "net_revenue").agg(F.count(F.lit(1)).alias("_cnt"))
                .withColumn("_y", F.when(F.col("net_revenue") > 0, F.log10("net_revenue"))))


def _fences(counts: DataFrame) -> DataFrame:
    q = quantiles_of_histogram(counts.where(F.col("_y").isNotNull()), "_y",
                               {"q1": 0.25, "med": 0.5, "q3": 0.75}, ["category"])
    iqr = F.col("q3") - F.col("q1")
    return q.select("category", "n", "q1", "med", "q3",
                    (F.col("q1") - F.lit(WHISKER_COEF) * iqr).alias("lo_fence"),
                    (F.col("q3") + F.lit(WHISKER_COEF) * iqr).alias("hi_fence"))


def boxplot_fences(fact: DataFrame) -> DataFrame:
    """Per category on log10(net revenue): quartiles and the 1.5 IQR fences (log units)."""
    return _fences(_value_counts(fact))


def boxplot_by_category(fact: DataFrame) -> DataFrame:
    """Five numbers per category, back on the dollar scale, plus outlier counts, by category name.

    Whiskers are the most extreme observed values inside the fences (reported
    as the original amounts); the box is 10^quartile of the log values.  All
    columns follow from one (category, net_revenue) -> count histogram; a
    missing category is a category of its own.
    """
    counts = _value_counts(fact)
    fences = _fences(counts).withColumnRenamed("category", "_c")
    inside = (F.col("_y") >= F.col("lo_fence")) & (F.col("_y") <= F.col("hi_fence"))

    def lines(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("_cnt"))), F.lit(0))

    return (counts.join(fences, F.col("category").eqNullSafe(F.col("_c")))
                  .groupBy("category").agg(
                      F.max("n").alias("n"),
                      F.min(F.when(inside, F.col("net_revenue"))).alias("lower_whisker"),
                      _r6(F.pow(F.lit(10.0), F.max("q1"))).alias("q1"),
                      _r6(F.pow(F.lit(10.0), F.max("med"))).alias("median"),
                      _r6(F.pow(F.lit(10.0), F.max("q3"))).alias("q3"),
                      F.max(F.when(inside, F.col("net_revenue"))).alias("upper_whisker"),
                      lines(~inside).alias("n_outliers"),
                      lines(F.col("_y").isNull()).alias("n_dropped"))
                  .orderBy("category"))


def boxplot_outliers(fact: DataFrame) -> DataFrame:
    """The lines drawn as outlier points, with the side of the box they fall on."""
    fences = boxplot_fences(fact).select(F.col("category").alias("_c"), "lo_fence", "hi_fence")
    y = fact.where(F.col("net_revenue") > 0).withColumn("_y", F.log10(F.col("net_revenue")))
    side = (F.when(F.col("_y") < F.col("lo_fence"), F.lit("low"))
             .when(F.col("_y") > F.col("hi_fence"), F.lit("high")))
    return (y.join(fences, F.col("category").eqNullSafe(F.col("_c")))
             .withColumn("side", side)
             .where(F.col("side").isNotNull())
             .select("order_id", "customer_id", "order_date", "sku", "category",
                     "net_revenue", "side"))


def weekly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per week, weeks starting on Sunday."""
    return (fact.groupBy(week_start_sunday("order_date").alias("week"))
                .agg(money_sum("net_revenue").cast("double").alias("revenue"))
                .orderBy("week"))


def return_rate_by_discount(fact: DataFrame) -> DataFrame:
    """Mean of the return flag and line count per discount level (no correlation coefficient)."""
    return (fact.groupBy("discount_pct")
                .agg(F.avg("is_returned").alias("return_rate"),
                     F.count(F.lit(1)).alias("n"))
                .orderBy("discount_pct"))
