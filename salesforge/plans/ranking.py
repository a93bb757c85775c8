"""Global ranking without a single-partition exchange.

``ntile`` / ``row_number`` over an ORDER BY with no PARTITION BY make Spark
move every row into one task.  Here the rows are range-partitioned on the
sort key (sampled boundaries, many tasks), sorted inside each partition, and
each row's global position is its position inside the partition plus the
number of rows in all earlier partitions.  The per-partition counts are a
table of at most ``numPartitions`` rows, so broadcasting it is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .physical import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index


def global_row_index(df: DataFrame, order: list[Column], num_partitions: int | None = None,
                     name: str = "row_index", keep_total: bool = False,
                     total_name: str = "row_total") -> DataFrame:
    """Append a 0-based global position under a *total* order ``order``.

    The ranged, sorted frame is checkpointed so partition ids and in-partition
    order are the same for the count and for the final projection, also after
    an executor is lost.
    """
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = materialize(ranged.sortWithinPartitions(*order))
    mono = F.monotonically_increasing_id()
    tagged = ranged.withColumns({
        "_pid": F.shiftright(mono, _LOCAL_BITS),
        "_local": mono.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
    })
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(Window.partitionBy()).alias(total_name))
    out = (tagged.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, F.col("_offset") + F.col("_local"))
                 .drop("_pid", "_local", "_offset"))
    return out if keep_total else out.drop(total_name)


def ntile_column(index: Column, total: Column, tiles: int) -> Column:
    """SQL ``NTILE(k)`` from a 0-based position: the first ``n % k`` tiles get one extra row."""
    q = F.floor(total / F.lit(tiles))
    r = total - q * tiles
    big = r * (q + 1)
    return (F.when(index < big, F.floor(index / (q + 1)) + 1)
             .otherwise(r + F.floor(F.try_divide(index - big, q)) + 1)).cast("bigint")


def distributed_ntile(df: DataFrame, order: list[Column], tiles: int,
                      name: str = "tile") -> DataFrame:
    """``ntile(tiles) over (order by ...)`` computed without a single partition."""
    indexed = global_row_index(df, order, name="_idx", keep_total=True, total_name="_n")
    return (indexed.withColumn(name, ntile_column(F.col("_idx"), F.col("_n"), tiles))
                   .drop("_idx", "_n"))
