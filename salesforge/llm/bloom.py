"""A blocked Bloom filter that Spark builds and numpy probes.

All bits of a key lie in one block of 512 bits, so a probe touches one cache line.  The filter never exceeds
``max_bytes``: that is the bound of what is collected and broadcast.  Beyond the bound it lets more keys pass by
mistake, which costs work but never a result, since every user joins exactly afterwards.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS = 8  # of 64 bits
PROBES = 6
BITS_PER_KEY = 14
MAX_BYTES = 32 * 2**20


def _positions(h: Column) -> list[Column]:
    """Bit positions in the block, from the upper half of the key's hash."""
    first = F.shiftright(h, 32).bitwiseAND(F.lit(511))
    step = F.shiftright(h, 41).bitwiseAND(F.lit(511)).bitwiseOR(F.lit(1))
    return [(first + step * i).bitwiseAND(F.lit(511)) for i in range(PROBES)]


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(h.bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(blocks)).cast("int")


def build(keys: DataFrame, hashed: str, n_keys: int, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """The filter of the 64-bit hashes in column ``hashed``, as an array (blocks, 8) of words.

    One map-side combined aggregate by block; at most ``max_bytes`` reach the driver.
    """
    blocks = max(1, min(math.ceil(n_keys * BITS_PER_KEY / 512), max_bytes // (8 * BLOCK_WORDS)))
    h = F.col(hashed)
    one = F.lit(1).cast("long")
    rows = keys.where(h.isNotNull()).select(_block(h, blocks).alias("b"),
                                            *[p.cast("int").alias(f"p{i}") for i, p in enumerate(_positions(h))])

    def word(w: int) -> Column:
        bits = [F.when(F.shiftright(f"p{i}", 6) == w, F.call_function("shiftleft", one, F.col(f"p{i}").bitwiseAND(63)))
                 .otherwise(F.lit(0).cast("long")) for i in range(PROBES)]
        return F.bit_or(reduce(lambda a, b: a.bitwiseOR(b), bits)).alias(f"w{w}")

    found = rows.groupBy("b").agg(*[word(w) for w in range(BLOCK_WORDS)]).toPandas()
    out = np.zeros((blocks, BLOCK_WORDS), np.int64)
    if len(found):
        out[found["b"].to_numpy()] = found[[f"w{w}" for w in range(BLOCK_WORDS)]].to_numpy(np.int64)
    return out.view(np.uint64)


def might_contain(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """For each 64-bit hash, whether the key may be in the filter."""
    h = hashed.astype(np.int64, copy=False).view(np.uint64)
    block = ((h & np.uint64(0xFFFFFFFF)) % np.uint64(len(bits))).astype(np.int64)
    first, step = (h >> np.uint64(32)) & np.uint64(511), ((h >> np.uint64(41)) & np.uint64(511)) | np.uint64(1)
    hit = np.ones(len(h), bool)
    for i in range(PROBES):
        p = (first + step * np.uint64(i)) & np.uint64(511)
        hit &= (bits[block, (p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return hit
