"""Mergeable summaries kept by month: exact distinct counts as bitmaps, quantiles as KLL sketches.

Both are written once a month and merged for any period, so a longer period never reads the lines again, and neither
expands the rows for several distinct counts at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

DISTINCT_MEASURES = {"orders": "order_id", "customers": "customer_id"}
SKETCH_SIZE = 1600          # k of the sketch: rank error about 0.3 % with 99 % confidence
SKETCH_RANK_ERROR = 0.01    # what is promised
SKETCH_PROBS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


# ---------------------------------------------------------------- distinct counts
def distinct_bitmaps(fact: DataFrame, measures: dict[str, str] | None = None) -> DataFrame:
    """(measure, order_month, bucket, bits): the ids of each month as bitmaps of 32,768 ids.

    Partial aggregates build the bitmaps before the shuffle; a bucket's bitmap has 4 KB, however many rows it stands for.
    Ids are whole numbers; a missing id makes an empty bitmap, so that its month is known.
    """
    def one(name: str, column: str) -> DataFrame:
        value = F.col(column).cast("bigint")
        return (fact.groupBy("order_month", F.bitmap_bucket_number(value).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
                .select(F.lit(name).alias("measure"), "order_month", "bucket", "bits"))

    return reduce(DataFrame.union, [one(n, c) for n, c in (measures or DISTINCT_MEASURES).items()])


def distinct_counts(bitmaps: DataFrame, period: Column, grain: str,
                    measures: dict[str, str] | None = None) -> DataFrame:
    """(grain, period, one column a measure): exact distinct counts of any period from the months' bitmaps."""
    merged = (bitmaps.groupBy(period.alias("period"), "measure", "bucket")
              .agg(F.bitmap_or_agg("bits").alias("bits")))
    return (merged.groupBy("period")
            .agg(*[F.coalesce(F.sum(F.when(F.col("measure") == m, F.bitmap_count("bits"))), F.lit(0)).alias(m)
                   for m in (measures or DISTINCT_MEASURES)])
            .select(F.lit(grain).alias("grain"), "period", *(measures or DISTINCT_MEASURES)))


def quarter_of_month(month: Column) -> Column:
    """``1996-05`` -> ``1996Q2``."""
    return F.concat(F.substring(month, 1, 4), F.lit("Q"),
                    F.ceil(F.substring(month, 6, 2).cast("int") / 3).cast("string"))


def distinct_rollup(bitmaps: DataFrame) -> DataFrame:
    """Orders and customers by month, by quarter and over all time, all from the same stored bitmaps."""
    month = F.col("order_month")
    grains = {"month": month, "quarter": quarter_of_month(month), "all": F.lit("all")}
    return reduce(DataFrame.union, [distinct_counts(bitmaps, p, g) for g, p in grains.items()])


# ---------------------------------------------------------------- quantiles
def month_sketches(fact: DataFrame, value: str = "net_revenue", group: str = "category",
                   size: int = SKETCH_SIZE) -> DataFrame:
    """(group, order_month, sketch): a KLL sketch of each month's values; missing values and NaN are not counted."""
    v = F.col(value).cast("double")
    present = fact.where(v.isNotNull() & ~F.isnan(v))
    return present.groupBy(group, "order_month").agg(
        F.call_function("kll_sketch_agg_double", v, F.lit(size)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, group: str = "category", size: int = SKETCH_SIZE,
                     probs: dict[str, float] | None = None) -> DataFrame:
    """(group, one column a probability) from merged sketches; the values were not read."""
    merged = sketches.groupBy(group).agg(
        F.call_function("kll_merge_agg_double", F.col("sketch"), F.lit(size)).alias("sketch"))
    return merged.select(group, *[F.call_function("kll_sketch_get_quantile_double", "sketch", F.lit(p)).alias(n)
                                  for n, p in (probs or SKETCH_PROBS).items()])


def measured_rank_errors(fact: DataFrame, estimates: DataFrame, value: str = "net_revenue", group: str = "category",
                         probs: dict[str, float] | None = None) -> DataFrame:
    """(group, err_<name>): how far each estimate's true rank is from the asked one, as a share of the group's rows."""
    probs = probs or SKETCH_PROBS
    v = F.col(value).cast("double")
    est = estimates.select(F.col(group).alias("_g"), *[F.col(n).alias(f"_{n}") for n in probs])
    rows = fact.where(v.isNotNull() & ~F.isnan(v)).join(est, F.col(group).eqNullSafe(F.col("_g")))
    counts = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(v < F.col(f"_{n}")).alias(f"_lt_{n}") for n in probs],
        *[F.count_if(v <= F.col(f"_{n}")).alias(f"_le_{n}") for n in probs])
    return counts.select(group, *[
        F.greatest(F.lit(0.0), F.col(f"_lt_{n}") / F.col("_n") - p, p - F.col(f"_le_{n}") / F.col("_n")).alias(f"err_{n}")
        for n, p in probs.items()])


def sketched_and_exact(fact: DataFrame, sketches: DataFrame, value: str = "net_revenue",
                       group: str = "category") -> DataFrame:
    """(group, n, exact p50, p90, p99, within_bound): whether all merged estimates keep the promised rank error."""
    exact = exact_quantiles(fact, value, SKETCH_PROBS, [group])
    errors = measured_rank_errors(fact, sketch_quantiles(sketches, group), value, group)
    worst = F.greatest(*[F.col(f"err_{n}") for n in SKETCH_PROBS])
    errors = errors.select(F.col(group).alias("_g"), (worst <= SKETCH_RANK_ERROR).alias("within_bound"))
    return (exact.join(errors, F.col(group).eqNullSafe(F.col("_g")), "left")
            .select(group, "n", *SKETCH_PROBS, "within_bound"))
