"""Money arithmetic that is exact and partition-independent.

* Row-level rounding follows numpy's ``round(x, k)``: scale, round half-even on
  the binary product, unscale (``rint``).
* SQL ``ROUND`` is half away from zero on the scaled double (``round(x*10^k, 0)``).
* Sums of money are taken as ``decimal(18,2)`` (exact, any order), then cast to
  double at the edge, so results do not depend on partitioning.

Each helper has a DuckDB twin in ``salesforge.plans.oracle`` with the same
operation order, so both engines produce bit-identical doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rint_round(x, digits: int = 2) -> Column:
    """numpy-style round: rint(x * 10^k) / 10^k on doubles."""
    scale = float(10 ** digits)
    return F.rint(_c(x).cast("double") * F.lit(scale)) / F.lit(scale)


def half_away_round(x, digits: int = 2) -> Column:
    """SQL-style ROUND (half away from zero) applied to the scaled double."""
    scale = float(10 ** digits)
    return F.round(_c(x).cast("double") * F.lit(scale), 0) / F.lit(scale)


def to_money(x) -> Column:
    return _c(x).cast(MONEY)


def money_sum(x) -> Column:
    """Exact sum of a 2-digit money column; result stays decimal."""
    return F.sum(to_money(x))


def money_sum_double(x) -> Column:
    """Exact sum cast to double at the end (bit-identical across engines)."""
    return money_sum(x).cast("double")


def ratio(num, den) -> Column:
    """Null instead of an error (ANSI) or infinity when the denominator is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
