import hashlib
import random

import numpy as np
import pandas as pd

from salesforge.llm import pii
from tests.llm import brute

SCHEMA = "doc_id long, text string, base string, slots int"


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a.@-+ 1234567890123() 5_é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == brute.base_spans(text), text


def test_long_runs_are_linear():
    assert pii.base_spans("a" * 300_000 + " @ " + "1" * 300_000 + "." * 9) == []


def _rows(spark):
    phones = [f"+1 212 555 01{k:02d}" for k in range(6)]
    docs = [(k, f"Hello there, please call me at {p} or write.", "x", 1) for k, p in enumerate(phones)]
    docs += [
        (10, "Hello there, please call me at 5550199123 or write.", "x", 1),  # found by its context only
        (11, "The river is 5550199124 years old.", "x", 1),  # a number in another context
        (12, None, "x", 1), (13, "", "x", 1), (None, "mail a.b@c.org", "x", 1),
        (14, "é 1.2.3.4, 4111111111111111 x@y.zz", "x", 1), (14, "é 1.2.3.4, 4111111111111111 x@y.zz", "x", 1),
    ]
    return spark.createDataFrame(docs, SCHEMA), docs


def test_entities_and_discovery(spark):
    df, docs = _rows(spark)
    got = pii.entities(df).collect()
    assert len(got) == len(docs)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text, *_ in docs:
        want, r = brute.base_spans(text), by_id[doc_id]
        assert [r[f"n_{k}"] for k in brute.KINDS] == [sum(s[0] == k for s in want) for k in brute.KINDS]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        if doc_id != 10:
            assert r["spans"] == joined and r["n_found"] == 0
    text = docs[6][1]
    assert by_id[10]["spans"] == f"phone:{text.index('555')}:{text.index('555') + 10}"


def test_mask_keeps_columns_and_rows(spark):
    df, docs = _rows(spark)
    got = pii.mask(df).collect()
    assert len(got) == len(docs) and list(got[0].asDict()) == ["doc_id", "text", "base", "slots"]
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[10] == "Hello there, please call me at [PHONE] or write."
    assert text[14] == "é [IP], [CARD] [EMAIL]" and text[None] == "mail [EMAIL]"
    assert text[12] is None and text[13] == "" and text[11] == docs[7][1]


def test_empty_table(spark):
    assert pii.entities(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pii.mask(spark.createDataFrame([], SCHEMA)).count() == 0


def _spans(spark, texts, schema="doc_id long, text string"):
    return {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in pii.entities(
        spark.createDataFrame(list(enumerate(texts)), schema)).collect()}


def test_whatever_fills_a_slot_is_an_instance(spark):
    """No digits, several tokens, a wide gap, a long value: the context alone finds them."""
    long = "x" * 100 + "(at)corp.example"
    texts = [f"please write to user{k}@corp.example now" for k in range(12)]
    texts += [f"you may call me at +1 212 555 01{k:02d} today" for k in range(6)]
    texts += ["please write to jane(at)corp.example now", "you may call me at (555) 123 4567 today",
              f"please write to{' ' * 200}bob(at)corp.example now", f"please write to {long} now"]
    got = _spans(spark, texts)

    def span(doc, kind, value):
        at = texts[doc].index(value)
        return [f"{kind}:{at}:{at + len(value)}"]

    assert got[18] == span(18, "email", "jane(at)corp.example") and got[19] == span(19, "phone", "(555) 123 4567")
    assert got[20] == span(20, "email", "bob(at)corp.example") and got[21] == span(21, "email", long)


def test_a_context_with_many_other_fillers_finds_nothing(spark):
    texts = [f"please write to user{k}@corp.example now" for k in range(6)]
    texts += [f"please write to {w} now" for w in ("me", "him", "her", "them", "us")]
    got = _spans(spark, texts)
    assert all(not got[k] for k in range(6, 11))


def test_neighbours_in_one_word_are_linear():
    text = "a@b.co," * 30_000
    found = pii.base_spans(text)
    assert len(found) == 30_000 and len(pii.seeds(text, found)) == 30_000


def test_an_instance_is_weighed_by_all_its_places(spark):
    """2024 is in a confident context once and in plain ones often; 5550199123 the other way round."""
    texts = [f"you may call me at +1 212 555 01{k:02d} today" for k in range(30)]
    texts += ["you may call me at 2024 today"] + [f"it was in 2024 that word{k} began" for k in range(5)]
    texts += ["you may call me at 5550199123 today"] * 5 + ["ask for 5550199123 there"]
    got = _spans(spark, texts)
    assert got[30] == ["phone:19:23"] and all(not got[k] for k in range(31, 36))
    assert all(got[k] == ["phone:19:29"] for k in range(36, 41)) and got[41] == ["phone:8:18"]
    text = {r["doc_id"]: r["text"] for r in pii.mask(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert text[31] == texts[31] and text[41] == "ask for [PHONE] there"


def test_rounds_go_on_to_the_end_of_a_chain(spark):
    """Each pattern has too few seeds without the instance that the pattern before it finds."""
    texts, last = [], 3
    for k in range(last + 1):
        n, a = (3 if k == 0 else 2), f"{chr(97 + k)}x"
        texts += [f"{a}one {a}two +1 212 555 {k:02d}{j:02d} {a}end" for j in range(n)]
        texts += [f"{a}one {a}two ident{chr(97 + j)} {a}end" for j in (k - 1, k) if j >= 0]
    assert _spans(spark, texts)[len(texts) - 1] == ["phone:12:18"]


def _random_corpus(seed, n=500):
    """Seeds in contexts of their own, with a few others that fill them, and in contexts that anything fills."""
    rng = random.Random(seed)
    words = ["the", "of", "call", "mail", "to", "at", "2024", "ask", "5550199"]
    phones = [*(f"+1 212 555 0{k}" for k in range(100, 112)), "555 01 99", "5550000"]
    emails = [*(f"u{k}@x.org" for k in range(12)), "jane(at)x", "kim(at)x"]

    def text():
        out = [rng.choice(words) for _ in range(rng.randint(3, 25))]
        for _ in range(rng.randint(0, 2)):
            before, values = rng.choice([(["reach", "me"], phones), (["my", "number"], emails), ([rng.choice(words)], phones)])
            at = rng.randrange(len(out) + 1)
            out[at:at] = [*before, rng.choice(values), rng.choice(["now", "please", rng.choice(words)])]
        return " ".join(out)

    return [text() for _ in range(n)]


def test_leaving_common_patterns_out_changes_nothing(spark):
    from pyspark.sql import functions as F
    common = 0
    for seed in (1, 2):
        docs = spark.createDataFrame(list(enumerate(_random_corpus(seed))), "doc_id long, text string").repartition(4)
        keyed = pii._keyed(docs, "doc_id", "text")
        scanned = pii.scan(keyed)
        found = [sorted(map(str, pii.discover(keyed, scanned, limited).collect())) for limited in (True, False)]
        assert found[0] == found[1] and found[0]
        edges = scanned.select(F.explode("seeds").alias("s")).select(
            F.explode("s.patterns").alias("pattern"), "s.kind", "s.value").distinct()
        fillers = pii._pattern_fillers(keyed, pii._supported(edges))
        common += fillers.where("value is null").count()
    assert common


def test_verdict_column(spark):
    df, docs = _rows(spark)
    got = {r["doc_id"]: r["has_pii"] for r in pii.entities(df).collect()}
    assert got == {d: bool(brute.base_spans(t)) or d == 10 for d, t, *_ in docs}


def test_a_task_leaves_no_words_in_its_worker(spark):
    docs = spark.createDataFrame([(k, f"mail to user{k}@example.org or call {k}") for k in range(50)],
                                 "doc_id long, text string").repartition(1)

    def held(parts):
        for part in parts:
            yield part
        yield pd.DataFrame({"n": [len(pii._words)]})

    values = spark.createDataFrame([("call",)], "value string")
    assert pii._slots(pii._keyed(docs, "doc_id", "text"), None, values).count() == 50
    left = spark.range(0, 8, 1, 8).where("id < 0").withColumnRenamed("id", "n").mapInPandas(held, "n long").collect()
    assert {r["n"] for r in left} == {0}


def test_the_look_up_holds_little_of_a_long_input():
    import tracemalloc

    values = np.zeros((1, 8), np.uint64)
    tracemalloc.start()
    try:
        for k in range(40):
            pii.slots_at([" ".join(f"w{k}x{j}" for j in range(5000))], None, values)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        pii._give_back()
    assert peak < 16 << 20


def test_no_rows_need_no_python_worker(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "mail to user@example.org now")], "doc_id long, text string")
    keyed = pii._keyed(docs, "doc_id", "text")
    scanned = pii.scan(keyed)

    def refuse(*args, **kwargs):
        raise AssertionError("rows of the driver are read by Python workers of another kind")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert pii.discover(keyed, scanned).count() == 0
    none = pii._no_rows(spark, "value string, wide boolean, patterns array<string>, n long")
    assert none.count() == 0 and none.schema.simpleString() == (
        "struct<value:string,wide:boolean,patterns:array<string>,n:bigint>")


def test_patterns_that_are_common_in_a_share_are_not_looked_for_again(spark, monkeypatch):
    monkeypatch.setattr(pii, "SHARE_BYTES", -1)
    asked, plain = [], pii._pattern_fillers

    def noted(docs, patterns):
        asked.append({r[0] for r in patterns.select("pattern").collect()})
        return plain(docs, patterns)

    monkeypatch.setattr(pii, "_pattern_fillers", noted)
    # each task sees one filler or two of the first pattern, far below its limit; the second has one filler in all
    texts = [f"they said w{k:03d}x today" for k in range(600)] + ["write to zed9 now"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(300)
    patterns = spark.createDataFrame([("they said", 4), ("write to", 4)], "pattern string, limit long")
    found, common = pii._fillers_of(pii._keyed(docs, "doc_id", "text"), patterns)
    assert [sorted(x) for x in asked][0] == ["they said", "write to"]
    assert len(asked) == 3 and all(x == {"write to"} for x in asked[1:])
    assert [tuple(r) for r in common.distinct().collect()] == [("they said", 4)]
    assert {tuple(r) for r in found.collect()} == {("write to", "zed9", True, True)}
