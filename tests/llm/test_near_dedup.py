import random

from salesforge.llm import near_dedup as N
from salesforge.llm.components import connected_components
from tests.llm import brute

SCHEMA = "doc_id long, text string, node string, n int, value int, root int"


def _docs():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    new = lambda n: [word() for _ in range(n)]
    texts = []

    def near(base, edits):
        out = list(base)
        for _ in range(edits):
            out[rng.randrange(len(out))] = word()
        return out

    for size in (6, 30, 120, 260, 900):  # around the sketch size, and whole sets
        base = new(size)
        texts += [base] + [near(base, rng.randint(0, max(1, size // 25))) for _ in range(12)]
    chain = new(200)
    for _ in range(8):  # a chain: its ends are not similar
        texts.append(chain)
        chain = near(chain, 2)
    passage = new(60)
    texts += [new(rng.randint(0, 60)) + passage + new(rng.randint(0, 60)) for _ in range(60)]  # a common passage
    texts += [new(rng.randint(1, 8)) for _ in range(20)]
    rng.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


def _rows(docs):
    return [(i, t, "x", 1, 1, 1) for i, t in docs]


def test_components_equal_brute_force(spark):
    docs = _docs() | {500: None, 501: "", 502: " \n\t", 503: "One two\x0bthree", 504: "one TWO three", 505: "É a b",
                      506: "é a b", 507: "one two three four"}
    got = {r["doc_id"]: r for r in N.near_duplicates(spark.createDataFrame(_rows(docs.items()), SCHEMA)).collect()}
    want = brute.components(docs)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(brute.shingles(t)) for i, t in docs.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_repeated_rows_null_ids_and_kept_columns(spark):
    rows = [(1, "a b c d e f", "x", 1, 1, 1)] * 2 + [(2, "a b c d e f", "x", 1, 1, 1), (None, "a b c d e f", "x", 1, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, N.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True)], key=repr)
    kept = N.keep_one(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 1, None]


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(3)
    long, short = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (500, 14))
    near = [*short[:13], "other"]
    rows = [(5, " ".join(long), "x", 1, 1, 1), (5, " ".join(short), "x", 1, 1, 1), (9, " ".join(near), "x", 1, 1, 1),
            (3, " ".join(long[:-1]), "x", 1, 1, 1)]
    for order in (rows, rows[::-1]):
        got = N.near_duplicates(spark.createDataFrame(order, SCHEMA).coalesce(1))
        assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == [
            (3, 495, 3), (5, 10, 5), (5, 496, 3), (9, 10, 5)]


def test_words_are_hashed_alike_wherever_they_stand():
    words = ["a", "b", "Ab", "aB", "é", "x" * 50, "y" * (N.BLOCK - 1), "z" * N.BLOCK, "z" * (N.BLOCK + 7), "\x00", "\x00\x00"]
    alone = [N.word_hashes(w.encode()).tolist() for w in words]
    assert all(len(h) == 1 for h in alone) and alone[2] == alone[3] and len({h[0] for h in alone}) == len(words) - 1
    rng = random.Random(6)
    for _ in range(20):
        picked = [rng.randrange(len(words)) for _ in range(rng.randint(0, 12))]
        text = "".join(rng.choice([" ", "\n", "\t \r", "\x0b\x0c"]) + words[k] for k in picked) + rng.choice(["", "  "])
        assert N.word_hashes(text.encode()).tolist() == [alone[k][0] for k in picked]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert N.near_duplicates(df).count() == 0 and N.keep_one(df).count() == 0


def test_bound_of_shared_values():
    assert N.shared_at_least(192) <= 144 and N.shared_at_least(4) == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3), (70, 60), (60, 65)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 60)} | {60: 60, 65: 60, 70: 60}
    assert got == want


def test_a_task_has_one_python_worker(spark, monkeypatch):
    plans, whole = [], N.materialize

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df)

    monkeypatch.setattr(N, "materialize", noted)
    docs = _docs()
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(
        spark.createDataFrame(_rows(docs.items()), SCHEMA)).collect()}
    assert got == brute.components(docs)
    assert any("MapInArrow" in p for p in plans)
    assert not any("MapInArrow" in p and "ArrowEvalPython" in p for p in plans)
