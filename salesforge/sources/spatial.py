"""A space-filling layout of the fact: selective reads by region, category and date in any combination.

The month layout (``warehouse.write_fact``) prunes by month and, inside it, by the first sort column.  Here rows lie along
a Z curve over the ranks of date, region and category, so that a row group covers a small range of each of them and the
min/max statistics prune on all three alike.  Order and customer ids are found through Parquet Bloom filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranking import global_row_index
from ..schema import FACT_COLUMNS, FACT_SCHEMA

CURVE_COLUMNS = ("order_date", "region", "category")
BLOOM_COLUMNS = ("order_id", "customer_id")
CURVE_BITS = 12  # of each rank: 36 bits of key


def interleaved(ranks: list[Column], bits: int = CURVE_BITS) -> Column:
    """The Morton key: the bits of the ranks in turn, the first rank's bit lowest of each round."""
    def bit(rank: Column, i: int, place: int) -> Column:
        return F.call_function("shiftleft", F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("long"), F.lit(place))

    parts = [bit(r, i, i * len(ranks) + d) for i in range(bits) for d, r in enumerate(ranks)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def scaled_ranks(df: DataFrame, column: str, bits: int = CURVE_BITS) -> DataFrame:
    """(column, rank): the places of the distinct values in order, stretched over 2^bits."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    placed = global_row_index(values, [F.col(column)], name="_place", keep_total=True, total_name="_total")
    return placed.select(column, F.floor(F.col("_place") * (1 << bits) / F.col("_total")).cast("int")
                         .alias(f"_rank_{column}"))


def with_curve_key(df: DataFrame, columns: tuple[str, ...] = CURVE_COLUMNS, bits: int = CURVE_BITS) -> DataFrame:
    """``df`` with ``_curve``; a missing value counts as the first rank.

    The ranks (a row for each day, region or category) are broadcast: rows are not moved by a column with few values.
    """
    for c in columns:
        ranks = scaled_ranks(df, c, bits).withColumnRenamed(c, f"_value_{c}")
        df = df.join(F.broadcast(ranks), F.col(c) == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
    names = [f"_rank_{c}" for c in columns]
    return df.withColumn("_curve", interleaved([F.coalesce(n, F.lit(0)) for n in names], bits)).drop(*names)


def write_spatial(fact: DataFrame, path: str, files: int | None = None, rows_per_group: int | None = None,
                  expected_ids: int | None = None) -> str:
    """Parquet along the curve.  The planner sizes the files by bytes unless ``files`` is given.

    ``expected_ids`` sizes the Bloom filters of a row group; by default Parquet adapts them to what it holds.
    """
    keyed = with_curve_key(fact)
    order = ["_curve", "order_id"]  # the id splits a hot cell
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions(*order).drop("_curve").write.mode("overwrite")
    for c in BLOOM_COLUMNS:
        # a column chunk that is dictionary-encoded throughout gets no filter
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.enable.dictionary#{c}", "false"))
        if expected_ids:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(expected_ids))
    if not expected_ids:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", str(rows_per_group))
    writer.parquet(path)
    return path


def read_spatial(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(path).select(*FACT_COLUMNS)


def in_box(fact: DataFrame, region: str | None = None, category: str | None = None, first_day: str | None = None,
           last_day: str | None = None) -> DataFrame:
    """The rows of a region, category and date range; what is None is not restricted.  All tests reach the scan."""
    tests = [F.col(c) == v for c, v in (("region", region), ("category", category)) if v is not None]
    if first_day is not None:
        tests.append(F.col("order_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        tests.append(F.col("order_date") <= F.lit(last_day).cast("date"))
    return fact.where(reduce(lambda a, b: a & b, tests)) if tests else fact
