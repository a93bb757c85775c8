"""Seeded, order-free randomness: draws from a hash of the row key.

A draw depends only on (seed, key), never on row order or partitioning, so it
is repeatable after a re-partition, a retry or a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def key_text(*cols: str) -> Column:
    """Canonical text of a composite key: values joined by ``|`` (dates as yyyy-MM-dd)."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def hash_uniform(seed: int, *cols: str) -> Column:
    """u in [0, 1) from the first 32 bits of md5(seed ':' key)."""
    text = F.concat(F.lit(f"{seed}:"), key_text(*cols))
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(_TWO_POW_32)


def cumulative_thresholds(weights: list[float]) -> list[float]:
    """Upper bounds of each choice on [0, 1); weights are normalised, last bound is 1."""
    total = sum(weights)
    out, acc = [], 0.0
    for w in weights:
        acc += w
        out.append(round(acc / total, 12))
    out[-1] = 1.0
    return out


def weighted_choice(u: Column, choices: list[tuple[str, float]]) -> Column:
    """Pick ``choices[i]`` where u falls below the i-th cumulative weight."""
    bounds = cumulative_thresholds([w for _, w in choices])
    expr = None
    for (name, _), b in zip(choices[:-1], bounds[:-1]):
        expr = (F.when(u < F.lit(b), F.lit(name)) if expr is None
                else expr.when(u < F.lit(b), F.lit(name)))
    last = F.lit(choices[-1][0])
    return last if expr is None else expr.otherwise(last)
