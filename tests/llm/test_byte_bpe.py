import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from salesforge.llm import byte_bpe as B
from salesforge.llm.common import word_pattern

SCHEMA = "doc_id long, text string, ids string, docs int"


@pytest.fixture(scope="module")
def reference():
    ranks = B.read_ranks(P.path(B.RANKS))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    rng = random.Random(5)
    letters = "aeinrst  é\n\t'sñß1290#$%  日本語😀\x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(60)]
    return [*texts, None, "", " ", "\n\n\n a", "it's we'll I'd <|endoftext|>", "x" * 700, "é" * 400, "áb", "\x00"]


def test_ids_and_bytes_equal_the_library(spark, reference):
    docs = [(k, t, "x", 1) for k, t in enumerate(_texts())] + [(3, "again", "x", 1), (3, "again", "x", 1),
                                                               (None, "no id", "x", 1)]
    got = [tuple(r) for r in B.digests(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()]
    want = []
    for doc, text, *_ in docs:
        ids = reference.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_encoded_documents_and_decoding(spark, reference):
    texts = [(1, "Hello wörld, it's 12"), (2, None)]
    got = {r["doc_id"]: bytes(r["ids"]) for r in B.encode_documents(
        spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert np.frombuffer(got[1], "<u4").tolist() == reference.encode_ordinary(texts[0][1]) and got[2] == b""
    ranks = B.read_ranks(P.path(B.RANKS))
    pieces = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    assert B.decode(got[1], pieces).decode() == texts[0][1]


def test_long_words_merge_alike(reference):
    rng = random.Random(3)
    ranks = B.read_ranks(P.path(B.RANKS))
    for _ in range(100):
        word = "".join(rng.choice("aeinrsté") for _ in range(rng.randint(1, 300))).encode()
        assert B.merge_long(word, ranks) == reference._encode_single_piece(word)


def test_pattern_for_latin_text_splits_alike():
    import regex

    latin, beyond = word_pattern(P.PATTERN)
    rng = random.Random(7)
    chars = [chr(c) for c in range(0x250)] + list("   \n\t'stlvemd" * 20)
    for _ in range(3000):
        text = "".join(rng.choice(chars) for _ in range(30))
        assert not beyond.search(text) and latin.findall(text) == regex.findall(P.PATTERN, text)
    assert beyond.search("日")


def test_empty_table(spark):
    assert B.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_are_merged_in_the_task_without_a_shuffle(spark, reference):
    from salesforge.llm import word_merges as W

    rng = random.Random(11)
    words = ["".join(rng.choice("aeinrst é日\n1") for _ in range(n)) for n in [*range(1, 70), 200] for _ in range(20)]
    table = B.word_ids(P.path(B.RANKS))
    got = table.encode([[w] for w in words] + [[], words])
    want = [np.array(reference._encode_single_piece(w.encode()), "<u4").tobytes() for w in words]
    assert got == [*want, b"", b"".join(want)]
    plans = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(B, "materialize", lambda df: plans.append(df._jdf.queryExecution().toString()) or df)
        B.digests(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Generate" not in plans[0]
    assert [*W.chunks_of(["x" * W.CHUNK_CHARS, "a", "b"])] == [(0, 1), (1, 3)]


def test_a_full_table_begins_anew(reference, monkeypatch):
    from salesforge.llm import word_merges as W

    monkeypatch.setattr(W, "CACHED_WORDS", 3)
    table = B.word_ids(P.path(B.RANKS))
    for text in ["a bc de fgh ijkl", "ijkl zz y", "a b", "", "a b ttt qqq rrr"]:
        words = B.splitter()(text)
        assert np.frombuffer(table.encode([words])[0], "<u4").tolist() == reference.encode_ordinary(text)
