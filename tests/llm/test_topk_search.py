import math
import random

import pytest

from salesforge.llm import topk_search as S

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string"


def _brute(rows, every, k):
    kept = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for at, (q, w) in enumerate(kept):
        if q % every == 0:
            scored = sorted((-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(w, x, strict=False)))), c)
                            for n, (c, x) in enumerate(kept) if n != at)
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def _rows():
    rng = random.Random(8)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centre)]) for i in range(600)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # one very common vector: all ties
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 6), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8),
             (None, [1.0] * 8), (2100, [1.0] * 3), (2200, []), (2300, [1e9] * 8), (700, [0.5] * 8), (700, [0.5] * 8),
             (701, [-3.0] * 8), (701, [3.0] * 8), (800, [200000.0, 0.0]), (2401, [200000.0, 1.0]), (2402, [-200000.5] * 8),
             (2403, [3e7, -2e7, 1.5])]
    return [(i, v, 1, 1, "x") for i, v in rows]


@pytest.mark.parametrize("block", [16, 256])
def test_equals_all_scores(spark, block):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [tuple(r) for r in df.collect()]  # as floats
    got = S.top_k(df.repartition(3), every=100, k=10, block=block).collect()
    assert sorted(map(tuple, got)) == _brute(rows, 100, 10)


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(0, [1.0], 1, 1, "x"), (1, [2.0], 1, 1, "x"), (2, [2.0], 1, 1, "x")], SCHEMA)
    assert sorted(map(tuple, S.top_k(df).collect())) == [(0, 1, 1, 2097152), (0, 2, 2, 2097152)]


def test_rows_of_one_id_and_large_components(spark):
    rows = [(100, [0.1, 0.0]), (1, [0.1, 0.0]), (1, [3.0, 0.0]), (100, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, S.top_k(df).collect())) == _brute(rows, 100, 10)
    rows = [(0, [200000.0, 0.0]), (1, [200000.0, 1.0]), (2, [1.0, 1.0]), (200, [1e30, 1.0]), (3, [-1e30, 5.0]),
            (4, [1e-9, -1e15]), (300, [0.0, 1e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (2, 256):
        assert sorted(map(tuple, S.top_k(df, block=block).collect())) == _brute(rows, 100, 10)


def test_blocks_are_skipped(monkeypatch):
    """A block whose bound is below the k-th score is not read."""
    import numpy as np
    import pandas as pd

    def block(vectors, ids):
        m = np.array(vectors, np.int64)
        return {"ids": np.array(ids).tobytes(), "rows": np.array(ids).tobytes(), "width": 2, "vectors": S._packed(m),
                "high": m.max(0).astype(float).tobytes(), "low": m.min(0).astype(float).tobytes()}

    blocks = pd.DataFrame([block([[9, 9], [8, 8]], [1, 2]), block([[1, 1], [0, 0]], [3, 4])])
    blocks.loc[1, "vectors"] = b"unreadable"
    queries = pd.DataFrame({"row": [0], "id": [0], "least": [S.NOTHING], "vector": [S._packed(np.array([1, 1]))]})
    assert S.search_tile(blocks, queries, 2)["vec_id"].tolist() == [1, 2]


def test_empty_table(spark):
    assert S.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
