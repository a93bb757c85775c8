"""URL filter: a blocked Bloom filter of the listed canonical URLs passes possible hits to an exact hash join.

A listed entry is a host (it stands for all its subdomains) and the beginning of a path.  A url is turned into
its keys: every suffix of its host at a label border, with every beginning of its path that is as long as some
listed path.  Keys that the filter lets through are joined with the list on host and path, which removes false
positives; the longest entry wins.  The verdict depends on host and path only, so distinct pairs are judged once, and a
host with a third of all pages costs one row a path.  The filter has a fixed bound of bytes; the list itself
may be of any size and is joined, not broadcast by hand.

Defined results
* null url or one without ``://``: host and path empty, no rule, the default verdict.
* an entry listed with both verdicts blocks.  Equally long entries: the longer host, then block.
* repeated rows and repeated or null ids: every row gets its verdict; extra columns are not read.
* an empty list lets everything through with the default verdict.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from . import bloom

# The rules of the registered query.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
DEFAULT_VERDICT = "allow"  # of urls that are not listed

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, _URL, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, _URL, 2)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id",
          max_filter_bytes: int = bloom.MAX_BYTES, default: str = DEFAULT_VERDICT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row; rules: host, path, verdict."""
    spark = pages.sparkSession
    listed = rules.groupBy("host", "path").agg(F.max("verdict").alias("listed"))  # 'block' sorts after 'allow'
    listed = listed.withColumn("h", F.xxhash64("host", "path"))
    n = listed.count()
    bits = spark.sparkContext.broadcast(bloom.build(listed, "h", n, max_filter_bytes))
    # as many as there are different lengths of paths, not paths
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())

    @pandas_udf(T.BooleanType())
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(bloom.might_contain(bits.value, hashes.to_numpy(np.int64)))

    host, path = canonical(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths or [0])), lambda n: n <= F.length("path"))
    keys = (urls.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("key_host"))
            .select("*", F.explode(fitting).alias("cut"))
            .select("host", "path", "key_host", F.expr("substring(path, 1, cut)").alias("key_path")))
    hits = keys.where(maybe(F.xxhash64("key_host", "key_path")))
    fits = hits.join(listed, (F.col("key_host") == listed["host"]) & (F.col("key_path") == listed["path"])).select(
        hits["host"], hits["path"], "key_host", "key_path", "listed")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("key_host") + F.length("key_path")).alias("long"), F.length("key_host").alias("host_long"),
        "listed", F.concat("key_host", "key_path").alias("rule"))).alias("b"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("b.rule").alias("rule"),
        F.coalesce("b.listed", F.lit(default)).alias("verdict"))


def rule_table(spark, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")
