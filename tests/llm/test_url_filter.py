import random
import re

import numpy as np

from salesforge.llm import bloom
from salesforge.llm import url_filter as U

SCHEMA = "page_id long, url string, host int, rule int, cut int"


def _judge(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), verdict, h + p) for h, p, verdict in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = ["http://a.net/x", "https://NET/", "http://net", "http://xnet/", "http://example.net/en/1?x#y", "x", None, "",
        "http://www.example.net/enx", "http://example.com/de/://a.net/", "ftp://b.example.com/de/?q", "://org/fr/",
        "http://u@a.org/fr/x", "http://a.org:80/fr/", "http://a.net?x/", "http://É.NET/ü", "http://a.\nnet/x",
        "http://.net/", "http://a..net/x", "//net/x", "http:///x"]


def test_rules_of_the_query(spark):
    rows = [(i, u, 1, 1, 1) for i, u in enumerate([*URLS, *URLS[:3]])] + [(None, "http://a.net/", 1, 1, 1)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA), U.rule_table(spark)).collect()
    want = [(i, *_judge(u, U.RULES)) for i, u, *_ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_many_rules_equal_a_plain_search(spark):
    rng = random.Random(6)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 4)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(300))}
                 .values())
    rows = [(i, f"http://{host()}{path()}", 1, 1, 1) for i in range(500)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA), U.rule_table(spark, rules), max_filter_bytes=64).collect()
    assert sorted(map(tuple, got)) == sorted((i, *_judge(u, rules)) for i, u, *_ in rows)


def test_contradictory_and_empty_lists(spark):
    df = spark.createDataFrame([(1, "http://a.net/", 1, 1, 1)], SCHEMA)
    both = U.rule_table(spark, [("net", "/", "allow"), ("net", "/", "block")])
    assert [tuple(r) for r in U.judge(df, both).collect()] == [(1, "a.net", "/", "net/", "block")]
    assert [tuple(r) for r in U.judge(df, U.rule_table(spark, [])).collect()] == [(1, "a.net", "/", None, "allow")]
    assert U.judge(df.limit(0), U.rule_table(spark)).count() == 0


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS h")
    bits = bloom.build(keys, "h", 5000)
    inside = np.array([r[0] for r in keys.collect()])
    outside = np.array([r[0] for r in spark.range(10_000, 20_000).selectExpr("xxhash64(id)").collect()])
    assert bloom.might_contain(bits, inside).all() and bloom.might_contain(bits, outside).mean() < 0.05
    assert bloom.build(keys, "h", 5000, max_bytes=128).nbytes == 128
