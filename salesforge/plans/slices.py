"""Large jobs in slices: parts of the rows that are worked through one after the other.

A shuffle keeps its files until its job ends.  A load that moves all lines at once needs disk for all of them, several
times over; in slices, only one slice's shuffles lie on disk at a time (see ``session.shuffles_go``).  Rows of one key
are in one slice, so steps that work inside a key give the same rows as on the whole.  Every slice reads the input
again and keeps its share of the rows before anything is moved.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 512 << 20  # of input files for each slice
_UNKNOWN = 1 << 62  # sizes from here on say that the planner knows none


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files under ``df`` by the planner's statistics; inputs of unknown size count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        size = int(str(leaves.next().stats().sizeInBytes()))
        total += size if size < _UNKNOWN else 0
    return total


def sliced(df: DataFrame, key: str) -> list[DataFrame]:
    """``df`` in as many slices as its input needs, dealt by a hash of ``key``; a small one as it is."""
    n = math.ceil(input_bytes(df) / SLICE_BYTES)
    if n <= 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]
