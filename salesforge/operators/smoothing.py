"""LOESS smoother of a weekly series (degree 2, tricube weights, span ``span``).

Direct local fit at ``points`` evenly spaced positions between the first and
last week.  Each position needs only its q = floor(n * span) nearest weeks,
which in sorted order lie inside the index window [i0 - q, i0 + q - 1] around
the position's insertion index i0.  That window is generated per position
(``sequence`` + ``explode``) and equi-joined to the indexed weeks, so the
work is points x 2q rows, never all pairs.

The fit solves the 3x3 weighted normal equations in closed form (Cramer's
rule) from nine moment sums, with x centred on the position and scaled by
the bandwidth h (the q-th nearest distance) to keep the system well
conditioned.  A position whose window has weight on two weeks only is fitted
by a line, on one week (or none: then the nearest) by their mean, so series of
one to a few weeks have a result.  Several series can be smoothed at once with ``series`` keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import epoch_days
from ..functions.money import half_away_round
from ..schema import DEFAULT_LOESS_POINTS, DEFAULT_LOESS_SPAN


def loess(series_df: DataFrame, x: str, y: str, span: float = DEFAULT_LOESS_SPAN,
          points: int = DEFAULT_LOESS_POINTS, series: list[str] | None = None) -> DataFrame:
    """Return (series..., point, x, fitted) for ``points`` grid positions per series."""
    keys = series or []
    by = Window.partitionBy(*keys)
    pts = (series_df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
                    .select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")))
    # index weeks in x order; the series is an aggregate (one row per week)
    idx = pts.withColumn("_i", F.row_number().over(by.orderBy("_x")) - 1)
    info = idx.groupBy(*keys).agg(F.min("_x").alias("_xmin"), F.max("_x").alias("_xmax"),
                                  F.count(F.lit(1)).alias("_n"))
    q = F.floor(F.col("_n") * F.lit(float(span)) + F.lit(1e-5)).cast("int")
    step = (F.col("_xmax") - F.col("_xmin")) / F.lit(float(max(points - 1, 1)))
    grid = (info.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
                .withColumn("x0", F.col("_xmin") + F.col("point").cast("double") * step)
                .withColumn("_q", F.greatest(F.least(q, F.col("_n").cast("int")), F.lit(1))))
    # insertion index of each grid position: weeks with x < x0 (running count over the union)
    marks = (idx.select(*keys, "_x", F.lit(1).alias("_w"), F.lit(None).cast("int").alias("point"))
                .unionByName(grid.select(*keys, F.col("x0").alias("_x"), F.lit(0).alias("_w"), "point")))
    run = by.orderBy("_x", F.col("_w").asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    i0 = (marks.withColumn("_i0", F.sum("_w").over(run))
               .where(F.col("_w") == 0).select(*keys, "point", "_i0"))
    cand = (grid.join(i0, [*keys, "point"])
                .withColumn("_i", F.explode(F.sequence(
                    F.greatest(F.col("_i0") - F.col("_q"), F.lit(0)),
                    F.least(F.col("_i0") + F.col("_q") - 1, F.col("_n").cast("int") - 1))))
                .join(idx, [*keys, "_i"])
                .withColumn("_d", F.abs(F.col("_x") - F.col("x0"))))
    per_point = Window.partitionBy(*keys, "point")
    h = F.element_at(F.array_sort(F.collect_list("_d").over(per_point)), F.col("_q"))
    w = cand.withColumn("_h", h)
    dx = F.coalesce(F.try_divide(F.col("_x") - F.col("x0"), F.col("_h")), F.lit(0.0))  # h = 0: only x = x0
    u = F.abs(dx)
    # integer powers by multiplication: exact IEEE steps, same in every engine
    one_minus = F.lit(1.0) - u * u * u
    tricube = F.when(u < 1, one_minus * one_minus * one_minus).otherwise(F.lit(0.0))
    # with no bandwidth, the weeks at the position itself count; with no week inside it, the nearest do
    none_inside = F.max(F.when(F.col("_d") < F.col("_h"), 1).otherwise(0)).over(per_point) == 0
    alone = none_inside & (F.col("_d") <= F.col("_h"))
    w = w.withColumn("_wt", F.when(none_inside, alone.cast("double")).when(F.col("_d") > F.col("_h"), F.lit(0.0))
                     .otherwise(tricube)).withColumn("_dx", dx)
    d1 = F.col("_dx")
    d2, wt, yv = d1 * d1, F.col("_wt"), F.col("_y")
    m = w.groupBy(*keys, "point", "x0").agg(
        F.count_distinct(F.when(wt > 0, F.col("_x"))).alias("_k"),
        F.sum(wt).alias("s0"), F.sum(wt * d1).alias("s1"), F.sum(wt * d2).alias("s2"),
        F.sum(wt * (d2 * d1)).alias("s3"), F.sum(wt * (d2 * d2)).alias("s4"),
        F.sum(wt * yv).alias("t0"), F.sum(wt * yv * d1).alias("t1"), F.sum(wt * yv * d2).alias("t2"))
    s0, s1, s2, s3, s4 = (F.col(f"s{k}") for k in range(5))
    t0, t1, t2 = (F.col(f"t{k}") for k in range(3))
    det = s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2)
    det_a = t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)
    return m.select(*keys, F.col("point").cast("bigint").alias("point"), "x0",
                    F.when(F.col("_k") >= 3, F.try_divide(det_a, det))
                     .when(F.col("_k") == 2, F.try_divide(t0 * s2 - s1 * t1, s0 * s2 - s1 * s1))
                     .otherwise(F.try_divide(t0, s0)).alias("fitted"))


def loess_trend(weekly: DataFrame, span: float = DEFAULT_LOESS_SPAN,
                points: int = DEFAULT_LOESS_POINTS) -> DataFrame:
    """Smoothed weekly revenue: (point, x = days since epoch, week date, fitted rounded to cents)."""
    s = weekly.select(epoch_days("week").alias("x"), "revenue")
    fit = loess(s, "x", "revenue", span, points)
    return fit.select("point", F.col("x0").alias("x"),
                      F.date_add(F.lit("1970-01-01").cast("date"), F.floor("x0").cast("int")).alias("week"),
                      half_away_round(F.col("fitted"), 2).alias("fitted_revenue"))
