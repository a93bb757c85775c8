"""Seeded sampling and append (the generator's duplicate injection, re-aimed).

``sample_rows`` is exact-n and repeatable: rows are ordered by a hash of
(seed, key) and the first n are kept.  ``orderBy(...).limit(n)`` plans as
``TakeOrderedAndProject``: every task keeps its own n best rows, so only
n x tasks rows ever meet, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import seasonal_multiplier
from ..functions.hashing import key_text
from ..schema import DEFAULT_SAMPLE_ROWS, LINE_KEY

DEFAULT_SAMPLE_SEED = 1


def sample_rows(df: DataFrame, n: int = DEFAULT_SAMPLE_ROWS, seed: int = DEFAULT_SAMPLE_SEED,
                key: list[str] | None = None) -> DataFrame:
    """n rows without replacement, chosen by md5(seed ':' key); key must be unique."""
    key = key or LINE_KEY
    h = F.md5(F.concat(F.lit(f"{seed}:"), key_text(*key)))
    return df.orderBy(h, *key).limit(n)


def union_all_lines(lines: DataFrame, extra: DataFrame) -> DataFrame:
    """Append ``extra`` to ``lines`` by column name (UNION ALL, duplicates kept)."""
    return lines.unionByName(extra)


def with_duplicates(lines: DataFrame, n: int = DEFAULT_SAMPLE_ROWS,
                    seed: int = DEFAULT_SAMPLE_SEED) -> DataFrame:
    """The generator's step: append a seeded sample of ``n`` existing lines again."""
    return union_all_lines(lines, sample_rows(lines, n, seed))


def seasonal_multipliers(fact: DataFrame) -> DataFrame:
    """Seasonal price multiplier of every order date present in the data."""
    d = fact.select("order_date").where(F.col("order_date").isNotNull()).distinct()
    return d.select("order_date", F.dayofyear("order_date").alias("day_of_year"),
                    seasonal_multiplier("order_date").alias("multiplier"))
