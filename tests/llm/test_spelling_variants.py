import random
import re
import zlib
from collections import Counter

import pytest

from salesforge.llm import spelling_variants as V

SCHEMA = "doc_id long, text string, word string, n int, base string"


def _plain_words(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(x == y[:i] + y[i + 1:] for i in range(len(y)))


def _plain(rows):
    words = _plain_words(rows)
    out = {}
    for w, n in words.items():
        near = [v for v in words if _one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 10 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    for w in words:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (*out[w], root)
    return out


def _rows(seed, n=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(25)]

    def word():
        w = stems[min(int(rng.expovariate(0.25)), 24)]
        if rng.random() < 0.3:
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", "a", "bb", "É", "z"]) + w[i + 1:]
        return w.upper() if rng.random() < 0.05 else w

    return [(rng.choice([k, k, None, 7]), " ".join(word() for _ in range(rng.randint(0, 60))), "x", 1, "y")
            for k in range(n)]


@pytest.mark.parametrize("tile", [4, 1024])
def test_variants_equal_a_plain_search(spark, monkeypatch, tile):
    monkeypatch.setattr(V, "TILE", tile)
    monkeypatch.setattr(V.units, "__defaults__", (tile,))
    monkeypatch.setattr(V.near_words, "__defaults__", (V.MIN_LENGTH, tile))
    rows = _rows(3) + [(1, None, "x", 1, "y"), (2, "", "x", 1, "y"), (3, "short words 123", "x", 1, "y")] * 2
    got = {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"])
           for r in V.variants(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    want = _plain(rows)
    assert len(want) > 100 and any(v[0] for v in want.values()) and got == want


def test_forms_are_followed_to_the_last(spark):
    words = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl"]
    text = " ".join(w for k, w in enumerate(words) for _ in range(2 * 10**k if k < 4 else 0))
    docs = spark.createDataFrame([(None, text, "x", 1, "y")], SCHEMA)
    plain = _plain([(None, text)])
    got = {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"]) for r in V.variants(docs).collect()}
    assert got == plain and any(plain[v[0]][0] for v in plain.values() if v[0])  # at least one chain of two steps


def test_long_words_and_large_units(spark):
    long = "ab" * 3000
    rows = [(k, f"{long} {long[:-1]} {long}c {long[:10]}x{long[10:]} {'q' * 7} {'q' * 8}", "x", 1, "y") for k in range(3)]
    got = {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"])
           for r in V.variants(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == _plain(rows)


def test_empty_table(spark):
    assert V.variants(spark.createDataFrame([], SCHEMA)).count() == 0
