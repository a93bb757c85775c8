import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
from tokenizers import Tokenizer

from salesforge.llm import packing as K

SCHEMA = "doc_id long, text string, length string, sequence_id int"


def _naive(lengths, window):
    free, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(c, j) for j, c in enumerate(free) if c >= lengths[i]]
        if fits:
            c, j = min(fits)
        else:
            c, j = window, len(free)
            free.append(window)
        free[j] = c - lengths[i]
        out.append(j)
    return len(free), sorted(free)


def test_best_fit_decreasing_leaves_what_a_plain_search_leaves():
    rng = random.Random(2)
    for _ in range(50):
        window = rng.choice([7, 16, 100, 1024])
        lengths = np.array([rng.randint(1, window - 1) for _ in range(rng.randint(1, 200))])
        to, offset = K.best_fit_decreasing(lengths, window)
        n, free = _naive(lengths.tolist(), window)
        sums = np.bincount(to, weights=lengths)
        assert len(sums) == n and sorted(window - sums) == free
        for j in range(n):
            o = np.argsort(offset[to == j])
            assert (offset[to == j][o] == np.cumsum(lengths[to == j][o]) - lengths[to == j][o]).all()


def _docs():
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma é", "\n", "1234"]) for _ in range(n))
    rows = [(k, text(rng.randint(0, 400))) for k in range(40)] + [(100, text(5000)), (101, None), (102, ""), (None, "x"),
                                                                  (7, "same"), (7, "same"), (103, "<|endoftext|> 日本"),
                                                                  (104, "a<|endoftext|>b<|endoftext|><|endoftext|> c <|endoftext")]
    return [(*r, "x", 1) for r in rows]


def test_pieces_hold_each_id_once(spark):
    docs = _docs()
    got = K.pack_documents(spark.createDataFrame(docs, SCHEMA).repartition(3), with_ids=True).toPandas()
    tokenizer = Tokenizer.from_file(P.path(K.VOCABULARY))  # left at its defaults
    want = []
    for doc, text, *_ in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(doc, s, len(ids[s: s + 1024]), zlib.crc32(ids[s: s + 1024].tobytes()), len(ids))
                 for s in range(0, len(ids), 1024)]
    rows = [(None if pd.isna(d) else int(d), *map(int, r)) for d, *r in
            got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False)]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered["offset"] == ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= 1024
    assert (got["ids"].map(zlib.crc32) == got["ids_crc32"]).all()


def test_sequences_are_padded_but_at_powers_of_two(spark):
    packed = K.pack_documents(spark.createDataFrame([(1, "a b c", "x", 1)], SCHEMA), with_ids=True)
    (row,) = K.sequences(packed).collect()
    assert row["length"] == 4 == len(row["ids"]) and row["ids"][-1] == 0
    packed = K.pack_documents(spark.createDataFrame([(1, "a b c d", "x", 1)], SCHEMA), with_ids=True)
    (row,) = K.sequences(packed).collect()
    assert row["length"] == 5 and len(row["ids"]) == 1024


def test_empty_table(spark):
    assert K.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_of_many_lengths_have_the_tokenizers_ids():
    rng = random.Random(6)
    texts = ["".join(rng.choice("aeinrst  é日\n12") for _ in range(rng.randint(0, 400))) for _ in range(200)]
    texts += ["x" * n for n in (1, 2, 63, 64, 65, 66, 700)] + ["é" * 40, "a<|endoftext|>" * 3]
    tokenizer, encode = Tokenizer.from_file(P.path(K.VOCABULARY)), K.token_ids(P.path(K.VOCABULARY))
    for got in (encode(texts), encode(texts[::-1])[::-1]):  # the second time from the table
        for text, ids in zip(texts, got, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
