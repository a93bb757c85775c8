"""Physical-plan helpers: lineage cuts and one-row folds.

``materialize`` runs a job while a plan is being built; it is used only where two
branches must see the same rows in the same partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's checkpoint dir.

    Used where two branches of a plan must see the same rows in the same
    partitions (e.g. range-partitioned ranking).  Survives executor loss:
    the data is re-read from shared storage, not recomputed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def one_row(frames: dict[str, DataFrame]) -> DataFrame:
    """Fold several one-row, one-column frames into a single row without a join.

    The frames are stacked with ``unionByName`` (each fills only its own column)
    and collapsed by a global aggregate that keeps the one non-null value per
    column.  Works for any column type, nested ones included.
    """
    parts = [df.select(F.col(df.columns[0]).alias(name)) for name, df in frames.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.first(n, ignorenulls=True).alias(n) for n in frames])
