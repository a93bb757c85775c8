"""Exact top-k by integer inner product, with block-at-a-time pruning.

Terms are vector components.  Documents are put in an order that brings like vectors together (signs of fixed random
projections, then id) and cut into ranges of ``BLOCK`` documents.  A block keeps its forward index (the matrix of its
vectors) and, for each term, the largest and the smallest weight.  For a query, the sum over the terms of the best the
block could give bounds every score in it.  Blocks are scored in the order of that bound until it falls below the k-th
best score so far.  A query starts with the k-th best score inside its own block, so most blocks are never scored.

Queries and blocks meet in tiles, a bounded number of blocks and of queries each: every query meets every block's
bounds once, and no task holds more than a tile.  The best k of the tiles are merged by a window whose limit works
before the shuffle.

Defined results
* vectors that are null or hold a null or non-finite component take no part.  Null ids take no part.
* shorter vectors count as filled up with zeros.
* large components: products are exact at any size (floating point below 2^53, 64-bit integers below 2^62, else Python
  integers).  A score beyond 64 bits counts as the end of their range.
* rows that share an id are vectors of their own: each can be a query, and a candidate for the others.
* ties: the smaller id.  Fewer than k candidates: all of them.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import materialize

SCALE = 1024
TOP = 10
BLOCK = 256
BLOCKS_PER_TILE = (16, 256)  # fewest and most; in between, as many as give each core some tiles
QUERIES_PER_TILE = 2048
PROJECTIONS = 24
NOTHING = -(1 << 63)  # the score of a place that is not filled
LONG = (NOTHING + 1, (1 << 63) - 1)  # the range of scores
NO_ID = LONG[1]


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): the vectors that take part, floored to whole numbers (as doubles, which hold them exactly)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(F.lit(float(scale)) * x) < float("inf")))  # false for NaN

    def floored(x: Column) -> Column:  # beyond 2^52 a double is whole already
        y = F.lit(float(scale)) * x
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    whole = F.when(v.isNotNull() & F.coalesce(finite, F.lit(False)), F.transform(v, floored))
    return (table.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("v"))
            .where("id is not null and v is not null"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    width = max([0, *map(len, vectors)])
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


@pandas_udf(T.LongType())
def order_key(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Signs of fixed random projections as bits: like vectors get nearby keys."""
    for part in vectors:
        m = _matrix(part)
        planes = np.random.default_rng(7).standard_normal((m.shape[1], PROJECTIONS))
        yield pd.Series(((m @ planes > 0) @ (1 << np.arange(PROJECTIONS)[::-1])).astype(np.int64))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T exactly, cut to the range of scores."""
    width = min(a.shape[1], b.shape[1])  # the rest is zeros
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top_a, top_b = float(np.abs(a).max()), float(np.abs(b).max())
    if top_a * top_b * width < 2**53:
        return (a @ b.T).astype(np.int64)
    if top_a * top_b * width < 2**62 and max(top_a, top_b) < 2**62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    exact = [[[int(x) for x in row] for row in m] for m in (a, b)]
    return np.array([[max(LONG[0], min(LONG[1], sum(p * q for p, q in zip(x, y, strict=True)))) for y in exact[1]]
                     for x in exact[0]], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each row: highest score, then smallest id, then first row."""
    order = np.lexsort((rows, ids, ~scores), axis=-1)[:, :k]  # unlike the negative, ~ exists for every integer
    return tuple(np.take_along_axis(x, order, 1) for x in (scores, ids, rows))


_BLOCKS = ("rows binary, ids binary, width int, vectors binary, high binary, low binary, "
           "queries array<struct<row:long, id:long, place:int, least:long>>")


def _packed(m: np.ndarray) -> bytes:
    """A matrix of whole numbers, as 32-bit integers where they fit; the first byte tells which."""
    small = not m.size or np.abs(m).max() < 2**31
    return (b"i" + m.astype(np.int32).tobytes()) if small else (b"d" + m.astype(float).tobytes())


def _unpacked(data: bytes, rows: int) -> np.ndarray:
    m = np.frombuffer(data, np.int32 if data[:1] == b"i" else float, offset=1)
    return m.reshape(rows, -1) if m.size else np.zeros((rows, 0))


def _blocks(every: int, k: int, block: int):
    """A function from rows in order to blocks.  Ids divisible by ``every`` are queries."""
    def build(rows: pd.DataFrame) -> dict:
        ids, m = rows["id"].to_numpy(np.int64), _matrix(rows["v"])
        asked = np.flatnonzero(ids % every == 0)
        queries = []
        if len(asked):
            scores = _dot(m[asked], m)
            scores[np.arange(len(asked)), asked] = NOTHING
            scores = ~np.sort(~scores, axis=1)
            least = scores[:, k - 1] if scores.shape[1] >= k else np.full(len(asked), NOTHING)
            queries = [{"row": int(rows["row"].iloc[p]), "id": int(ids[p]), "place": int(p), "least": int(x)}
                       for p, x in zip(asked, least, strict=True)]
        return {"rows": rows["row"].to_numpy(np.int64).tobytes(), "ids": ids.tobytes(), "width": m.shape[1],
                "vectors": _packed(m), "high": m.max(0).tobytes(), "low": m.min(0).tobytes(), "queries": queries}

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for part in parts:
            held.append(part)
            n += len(part)
            if n >= block:
                rows = pd.concat(held, ignore_index=True)
                done = n - n % block
                yield pd.DataFrame([build(rows[i: i + block]) for i in range(0, done, block)])
                held, n = [rows[done:]], n - done
        if n:
            yield pd.DataFrame([build(pd.concat(held, ignore_index=True))])

    return cut


def _query_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for r in part.itertuples():
            m = _unpacked(r.vectors, len(r.ids) // 8)
            rows += [(q["row"], q["id"], q["least"], _packed(m[q["place"]])) for q in r.queries]
        yield pd.DataFrame(rows, columns=["row", "id", "least", "vector"]).astype(
            {"row": "int64", "id": "int64", "least": "int64"})


def search_tile(blocks: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k candidates in these blocks for each query, without those below the query's known k-th score."""
    asked = [_unpacked(v, 1) for v in queries["vector"]]
    width = int(max([0, *blocks["width"], *(v.shape[1] for v in asked)]))

    def padded(m: np.ndarray) -> np.ndarray:
        out = np.zeros((len(m), width))
        out[:, : m.shape[1]] = m
        return out

    q = np.concatenate([padded(v) for v in asked])
    q_ids, q_rows = queries["id"].to_numpy(np.int64), queries["row"].to_numpy(np.int64)
    least = queries["least"].to_numpy(np.int64)
    high, low = (np.concatenate([padded(np.frombuffer(x, float)[None, :]) for x in blocks[c]]) for c in ("high", "low"))
    bound = _dot(np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], 1), np.concatenate([high, low], 1))
    order = np.argsort(~bound, axis=1, kind="stable")
    ids, rows = ([np.frombuffer(x, np.int64) for x in blocks[c]] for c in ("ids", "rows"))
    best = np.full((len(q), k), NOTHING)
    best_ids, best_rows = np.full((len(q), k), NO_ID), np.full((len(q), k), NO_ID)
    going = np.arange(len(q))
    for turn in range(len(blocks)):
        floor = np.maximum(best[going, k - 1], least[going])
        going = going[bound[going, order[going, turn]] >= floor]
        if not len(going):
            break
        at = order[going, turn]
        for b in np.unique(at):
            some = going[at == b]
            scores = _dot(q[some], padded(_unpacked(blocks["vectors"].iloc[b], len(ids[b]))))
            cand, cand_rows = np.broadcast_to(ids[b], scores.shape), np.broadcast_to(rows[b], scores.shape)
            scores[cand_rows == q_rows[some, None]] = NOTHING
            best[some], best_ids[some], best_rows[some] = _best(
                np.concatenate([best[some], scores], 1), np.concatenate([best_ids[some], cand], 1),
                np.concatenate([best_rows[some], cand_rows], 1), k)
    row, col = np.nonzero((best > NOTHING) & (best >= least[:, None]))
    return pd.DataFrame({"query_row": q_rows[row], "query_id": q_ids[row], "vec_id": best_ids[row, col],
                         "vec_row": best_rows[row, col], "score": best[row, col]})


def top_k(table: DataFrame, every: int = 100, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose id is divisible by ``every``."""
    spark = table.sparkSession
    # numbered before the cut, so the numbers are those of the stored rows
    rows = materialize(integer_vectors(table, id_col, vector_col).withColumns(
        {"row": F.monotonically_increasing_id(), "key": order_key("v")}))
    order = ["key", "id", "row"]
    blocks = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "id", "v")
                         .mapInPandas(_blocks(every, k, block), _BLOCKS))
    queries = materialize(blocks.where(F.size("queries") > 0).mapInPandas(
        _query_rows, "row long, id long, least long, vector binary"))
    fewest, most = BLOCKS_PER_TILE
    n_blocks, n_queries = blocks.count(), queries.count()
    per_tile = min(most, max(fewest, n_blocks // (4 * spark.sparkContext.defaultParallelism)))
    tiles = max(1, math.ceil(n_blocks / per_tile))
    groups = max(1, math.ceil(n_queries / QUERIES_PER_TILE))

    def spread(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def dealt(n: int) -> Column:  # row numbers of a checkpoint are stable
        return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")

    left = blocks.withColumn("tile", dealt(tiles)).select("*", spread(groups, "part"))
    right = queries.withColumn("part", dealt(groups)).select("*", spread(tiles, "tile"))

    found_columns = "query_row long, query_id long, vec_id long, vec_row long, score long"

    def search(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if b.empty or q.empty:
            return pd.DataFrame({c.split()[0]: [] for c in found_columns.split(", ")}).astype("int64")
        return search_tile(b, q, k)

    found = (left.groupBy("tile", "part").cogroup(right.groupBy("tile", "part"))
             .applyInPandas(search, found_columns))
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
