"""Text formatting of figures for report and page labels.

Numbers are rounded numerically first (half away from zero on the scaled
double), then printed with exactly that many decimals, so the text does not
depend on the printing library's own rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONEY_LABEL_FORMATS
from .money import rint_round


def thousands(x: Column) -> Column:
    """Integer with thousands separators: 59868 -> ``59,868``."""
    return F.format_number(x.cast("bigint"), 0)


def money_label(v: Column) -> Column:
    """Compact dollars: >= 1e6 -> ``$1.23M``; >= 1e3 -> ``$4.5K``; else ``$67``.

    Digits are cut as a browser's ``toFixed`` does: by the exact binary value, so 1450 gives ``$1.4K``.
    """
    v = v.cast("double")
    (t_m, f_m, d_m), (t_k, f_k, d_k), (_, f_u, d_u) = MONEY_LABEL_FORMATS
    return (F.when(v >= t_m, F.format_string(f_m, fixed_digits(v / F.lit(t_m), d_m)))
             .when(v >= t_k, F.format_string(f_k, fixed_digits(v / F.lit(t_k), d_k)))
             .otherwise(F.format_string(f_u, fixed_digits(v, d_u))))


def fixed_digits(x: Column, digits: int) -> Column:
    """The number with ``digits`` decimals that is closest to the exact value of ``x``; the larger of two.

    ``x * 10^digits`` is taken without error as a rounded product plus its exact rest (the factors are split so
    that all partial products are exact); only a product that ends in .5 needs the rest.
    """
    scale = F.lit(float(10 ** digits))
    product = x * scale
    spread = x * F.lit(134217729.0)  # 2^27 + 1: splits a double into two halves
    high = spread - (spread - x)
    rest = (high * scale - product) + (x - high) * scale
    low = F.floor(product).cast("double")
    half = product - low
    up = (half > 0.5) | ((half == 0.5) & (rest >= 0))
    return (low + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale


def percent_label(fraction: Column, digits: int = 2) -> Column:
    """Python ``f"{x:.2%}"``: 0.0259 -> ``2.59%`` (half-even, like Python's float formatting)."""
    return F.format_string(f"%.{digits}f%%", rint_round(fraction.cast("double") * F.lit(100.0), digits))


def dollars_label(v: Column) -> Column:
    """Python ``f"${x:,.0f}"``: 1234567.8 -> ``$1,234,568`` (half-even on the exact value)."""
    return F.concat(F.lit("$"), F.format_number(F.rint(v.cast("double")), 0))
