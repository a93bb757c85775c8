"""Exact quantiles (R type 7) at scale.

Rows are first reduced to a (group, value) -> count histogram: partial
aggregation before the shuffle, so a hot value or group costs one row per
map task.  Cumulative counts over the sorted histogram are then built in two
levels.  Values fall into buckets by an order-preserving function of the value
alone (``value_bucket``: binary exponent and 12 bits below it); the counts of the
buckets give every bucket its offset, and inside a bucket the values are
counted up.  No step sorts or holds a whole group in one task, nothing is
cached and no job runs before the query does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEPS = 4096  # buckets for each power of two


def value_histogram(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """(group, value) -> count of the values that are present; NaN counts as missing."""
    groups = groups or []
    return (df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
              .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_cnt")))


def value_bucket(value: Column) -> Column:
    """A whole number that never decreases with the value: at most ``_STEPS`` for each power of two.

    It is never null in the plan either: else a join on it filters one use of a histogram and not the other, and the
    histogram is built twice.
    """
    v = value.cast("double")
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    place = (exponent + 2000) * (4 * _STEPS) + F.floor(size / F.pow(F.lit(2.0), exponent) * _STEPS)
    bucket = F.when(v > 0, place).when(v < 0, -place).otherwise(F.lit(0)).cast("bigint")
    return F.coalesce(bucket, F.lit(0).cast("bigint"))


def cumulative_counts(hist: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """Add ``_start`` / ``_end`` (0-based, end exclusive) positions and group size ``_n``."""
    groups = groups or []
    tagged = hist.withColumn("_bucket", value_bucket(F.col(value)))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (tagged.groupBy(*groups, "_bucket").agg(F.sum("_cnt").alias("_sum"))
               .select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_bucket").alias("_b"),
                       F.sum("_sum").over(before).alias("_off"), F.sum("_sum").over(whole).alias("_n")))
    inside = (Window.partitionBy(*groups, "_bucket").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = tagged.withColumn("_up", F.sum("_cnt").over(inside))
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups] + [F.col("_bucket") == F.col("_b")]
    return (local.join(buckets, same)
                 .withColumn("_end", F.coalesce("_off", F.lit(0)) + F.col("_up"))
                 .withColumn("_start", F.col("_end") - F.col("_cnt"))
                 .drop("_bucket", "_b", "_off", "_up", *[f"_g_{g}" for g in groups]))


def _at(pos: Column, value: str) -> Column:
    return F.max(F.when((F.col("_start") <= pos) & (pos < F.col("_end")), F.col(value)))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    groups: list[str] | None = None) -> DataFrame:
    """One row per group with a column per named probability (type 7 interpolation).

    q = x[lo] when h == 0 or x[lo] == x[hi], else (1 - h) * x[lo] + h * x[hi],
    with index (n - 1) * p, lo = floor, hi = ceil, h = index - lo.
    """
    groups = groups or []
    return quantiles_of_histogram(value_histogram(df, value, groups), value, probs, groups)


def quantiles_of_histogram(hist: DataFrame, value: str, probs: dict[str, float],
                           groups: list[str] | None = None) -> DataFrame:
    """``exact_quantiles`` from a (group, value) -> ``_cnt`` histogram."""
    groups = groups or []
    cum = cumulative_counts(hist, value, groups)
    aggs, finals = [], []
    for name, p in probs.items():
        idx = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(idx), F.ceil(idx)
        aggs += [_at(lo, value).alias(f"_{name}_lo"), _at(hi, value).alias(f"_{name}_hi"),
                 F.max(idx - lo).alias(f"_{name}_h")]
        xl, xh, h = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_h")
        finals.append(F.when((h == 0) | (xl == xh), xl)
                       .otherwise((F.lit(1.0) - h) * xl + h * xh).alias(name))
    out = cum.groupBy(*groups).agg(F.max("_n").alias("n"), *aggs)
    return out.select(*groups, "n", *finals)
