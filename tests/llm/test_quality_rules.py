import random

import numpy as np

from salesforge.llm import quality_rules as Q
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_words string, c int, bad int"
LABELS = "doc_id long, quality int, toxic int, label_id int"


def _text(rng, n, junk=False):
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    if junk:
        words = [w + rng.choice(["%%%", "###"]) for w in words]
    return "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words)


def _docs():
    rng = random.Random(9)
    return [(i, _text(rng, rng.randint(60, 200), junk=i % 5 == 0), "x", 1, 1) for i in range(300)]


def test_counts_equal_brute_force():
    rng = random.Random(2)
    texts = ["", "a", "a b c a b c", "x x x x", "a\na\n\n \na\r\n", "# $%&|<>*\x1c\x85 é"]
    texts += ["".join(rng.choice("ab #\n\t\x0b\x1cé") for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    for text in texts:
        assert dict(zip(Q.COUNTS[:5], Q.text_counts(text)[:5], strict=True)) == brute.quality_counts(text), text


def test_learned_list_separates_junk(spark):
    docs = _docs()
    df = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0, 1) for i in range(0, 300, 2)], LABELS)
    rules = Q.fit(df, labels)
    assert rules and len(rules) <= Q.MAX_RULES
    got = {r["doc_id"]: r for r in Q.judge(df, rules).collect()}
    for i, text, *_ in docs:
        counts = brute.quality_counts(text)
        assert {c: got[i][c] for c in counts} == counts and got[i]["base_failed"] == brute.base_failed(counts)
        assert got[i]["kept"] == (i % 5 != 0)
    kept = Q.filter_documents(df, rules)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i in got if i % 5}


def test_no_rule_without_two_classes(spark):
    df = spark.createDataFrame(_docs()[:20], SCHEMA)
    for rows in ([], [(i, 1, 0, 1) for i in range(20)], [(None, 0, 0, 1), (1, None, 0, 1), (2, 0, 0, 1), (2, 1, 0, 1)]):
        assert Q.fit(df, spark.createDataFrame(rows, LABELS)) == []
    assert Q.judge(df, []).where("not kept").count() == 0


def test_nulls_repeated_rows_and_empty_table(spark):
    long = _text(random.Random(1), 80)
    df = spark.createDataFrame([(1, None, "x", 1, 1), (2, "", "x", 1, 1), (None, long, "x", 1, 1), (3, long, "x", 1, 1),
                                (3, long, "x", 1, 1)], SCHEMA)
    got = sorted(((r["doc_id"], r["kept"], r["base_failed"]) for r in Q.judge(df, []).collect()), key=repr)
    assert got == sorted([(1, False, True), (2, False, True), (None, True, False), (3, True, False),
                          (3, True, False)], key=repr)
    assert Q.filter_documents(df, []).count() == 3
    assert Q.judge(df.limit(0), []).count() == 0


def test_conjunction_is_grown_and_pruned():
    rng = np.random.default_rng(3)
    x = rng.random((4000, len(Q.FEATURES)))
    bad = (x[:, 2] > 0.6) & (x[:, 4] <= 0.3)  # needs both terms
    rules = Q.learn(x, bad, np.arange(4000))
    hit = np.zeros(4000, bool)
    for r in rules:
        hit |= Q._covers(r, x)
    assert (hit == bad).mean() > 0.97 and any(len(r) > 1 for r in rules)


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2, 0, 1) for i in range(100)], LABELS)
    assert Q.labelled_sample(labels, 10).count() == 10
