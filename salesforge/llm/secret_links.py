"""Secrets: exact base patterns, and weak parts of credentials that are reported only beside their complements.

1. Every whole text is searched for the base patterns and for *parts* of credentials: identifiers (access keys, labelled
   account names), secrets (base secrets, labelled or random-looking tokens) and endpoints (urls, labelled hosts).  Base
   spans are strong parts; all others are weak and mean nothing by themselves.
2. Spark joins the parts as intervals: two parts meet if they lie in one scope (a stretch without a blank line) and start
   at most ``REACH`` code points apart.  Starts fall into bins as wide as the reach; a bin keeps only the first and last
   part of each role, which is enough to tell for its neighbours exactly whether a partner is in reach.  So the join
   makes at most 18 rows a candidate, however many parts a text holds, and no pairs.
3. A weak part is reported if both other roles are in reach, or if it is an identifier or a secret and a strong one of the
   other of these two is.

Defined results
* null text: as the empty text, no spans.  Offsets are code points, ends exclusive; the span of a labelled part is its value.
* a weak part that overlaps a base span, or a random-looking token inside an endpoint, is no part.
* repeated rows get the same result each; null ids are handled like any id; very long texts are searched whole.
* ties: of partners at one distance the one that starts first.
* extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import concat_spans, materialize, text_or_empty

# The base kinds in their order, and their patterns.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

ROLES = ["identifier", "secret", "endpoint"]
ROLE_OF = {"assign": "secret", "access": "identifier", "hex": "secret"}
REACH = 240

_LABEL = r"""["']?\x20*[:=]\x20*["']?"""
LABELLED = {
    "identifier": re.compile(r"(?<![A-Za-z0-9])(?ai:client[_-]?id|(?:access[_-]?)?key[_-]?id|account(?:[_-]?(?:id|name))?|"
                             rf"user(?:[_-]?(?:id|name))?|login){_LABEL}([A-Za-z0-9@._+/-]{{3,}})"),
    "secret": re.compile(rf"(?<![A-Za-z0-9])(?ai:pwd|pass(?:phrase)?|private[_-]?key|auth|credential|pin){_LABEL}"
                         r"([A-Za-z0-9+/_.=!@#$%^&*-]{4,})"),
    "endpoint": re.compile(rf"(?<![A-Za-z0-9])(?ai:host(?:name)?|server|endpoint|region|bucket){_LABEL}"
                           r"([A-Za-z0-9][A-Za-z0-9._:/-]{2,})"),
}
URL = re.compile(r"(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9+.-]{1,20}://[A-Za-z0-9][^\x00-\x20\"'<>]*")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
MIN_BITS = 3.0  # Shannon entropy of a random-looking token's characters
_BLANK = re.compile(r"\n[\x20\t\r]*(?=\n)")

_PART = "role: string, strong: boolean, scope: long, start: long, end: long"
_SPAN = "kind: string, start: long, end: long"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end): leftmost non-overlapping matches a kind, failing ones dropped, by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in (ASSIGN.finditer(text) if "=" in text or ":" in text else ())
           if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def looks_random(token: str) -> bool:
    """Upper-case and lower-case letters and digits, with enough entropy."""
    if not (any(map(str.isdigit, token)) and any(map(str.isupper, token)) and any(map(str.islower, token))):
        return False
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values()) >= MIN_BITS


def parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, bool, int, int, int]]:
    """(role, strong, scope, start, end) of all parts, if the text holds more than one role of which one is an identifier.

    Nothing can be reported in other texts.  A scope is named after the place where it begins.
    """
    weak: dict[str, list[tuple[int, int]]] = {r: [] for r in ROLES}
    if "=" in text or ":" in text:
        for role, pattern in LABELLED.items():
            weak[role] = [m.span(1) for m in pattern.finditer(text)]
    if "://" in text:
        weak["endpoint"] += [m.span() for m in URL.finditer(text)]
    if not weak["identifier"] and not any(k == "access" for k, *_ in base):
        return []
    weak["endpoint"] = sorted(set(weak["endpoint"]))
    inside = _Cover(weak["endpoint"])
    weak["secret"] += [m.span() for m in TOKEN.finditer(text) if not inside.meets(*m.span()) and looks_random(m[0])]
    strong = _Cover([(a, b) for _, a, b in base])
    found = {(ROLE_OF[k], True, a, b) for k, a, b in base}
    found |= {(r, False, a, b) for r, spans in weak.items() for a, b in spans if not strong.meets(a, b)}
    if len({r for r, *_ in found}) < 2:
        return []
    blanks = [0, *(m.end() for m in _BLANK.finditer(text))]
    return sorted((r, s, blanks[bisect_right(blanks, a) - 1], a, b) for r, s, a, b in found)


class _Cover:
    """Tells whether a span meets any of the given ones."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends, last = [], [], 0
        for a, b in sorted(spans):
            last = max(last, b)
            self.starts.append(a)
            self.ends.append(last)  # the furthest end so far

    def meets(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, end - 1)
        return k > 0 and self.ends[k - 1] > start


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, parts) for every row: the base spans and the parts of credentials as arrays of structs."""
    def search(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in pages:
            base = [base_spans(t) for t in page["text"]]
            yield pd.DataFrame({
                "doc_id": page["doc_id"],
                "base": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans] for spans in base],
                "parts": [[dict(zip(("role", "strong", "scope", "start", "end"), p, strict=True)) for p in parts(t, spans)]
                          for t, spans in zip(page["text"], base, strict=True)]})

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"),
                       text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    found = rows.mapInPandas(search, f"doc_id string, base array<struct<{_SPAN}>>, parts array<struct<{_PART}>>")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def linked(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, role, start, end, partners): the weak parts of ``rows`` (key, parts) that are reported.

    ``partners`` holds the nearest part of each other role as (kind, start, end).
    """
    spread = rows.select("key", F.explode("parts").alias("p")).select("key", "p.*")
    spread = spread.withColumn("bin", F.floor(F.col("start") / reach))
    at = F.struct("start", "end")
    ends = (spread.groupBy("key", "scope", "bin", F.col("role").alias("other"), F.col("strong").alias("sure"))
            .agg(F.min(at).alias("first"), F.max(at).alias("last")))
    weak = (spread.where(~F.col("strong")).drop("strong")
            .withColumn("bin", F.explode(F.array(*[F.col("bin") + d for d in (-1, 0, 1)]))))
    away = {c: F.abs(F.col(f"{c}.start") - F.col("start")) for c in ("first", "last")}
    nearest = F.when(away["last"] < away["first"], F.col("last")).otherwise(F.col("first"))
    met = (weak.join(ends, ["key", "scope", "bin"]).where("role <> other")
           .withColumn("partner", nearest)
           .withColumn("away", F.abs(F.col("partner.start") - F.col("start"))).where(F.col("away") <= reach))

    def of(role: str, value: Column) -> Column:
        return F.when(F.col("other") == role, value)

    partner = F.struct("away", F.col("other").alias("kind"), "partner.start", "partner.end")
    seen = met.groupBy("key", "role", "start", "end").agg(
        *[F.min(of(r, partner)).alias(f"near_{r}") for r in ROLES],
        *[F.coalesce(F.bool_or(of(r, F.col("sure"))), F.lit(False)).alias(f"sure_{r}") for r in ROLES])
    others = {r: [x for x in ROLES if x != r] for r in ROLES}
    both = F.lit(False)
    for r, (x, y) in others.items():
        both |= (F.col("role") == r) & F.col(f"near_{x}").isNotNull() & F.col(f"near_{y}").isNotNull()
    backed = (((F.col("role") == "secret") & F.col("sure_identifier"))
              | ((F.col("role") == "identifier") & F.col("sure_secret")))
    partners = F.transform(F.array_compact(F.array(*[F.col(f"near_{r}") for r in ROLES])),
                           lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    return seen.where(both | backed).select("key", "role", "start", "end", partners.alias("partners"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, base, links) for every row: base spans, and the reported weak parts with their partners."""
    # numbered before the cut, so the numbers are those of the stored rows
    rows = materialize(scan(docs, id_col, text_col).withColumn("key", F.monotonically_increasing_id()))
    link = F.struct("start", F.col("role").alias("kind"), "end", "partners")
    links = (linked(rows.where(F.size("parts") > 0), reach).groupBy("key")  # at most the parts of one text
             .agg(F.sort_array(F.collect_list(link)).alias("links")))
    return rows.join(links, "key", "left").select(
        "doc_id", "base", F.coalesce("links", F.array().cast(links.schema["links"].dataType)).alias("links"))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of ``secrets``."""
    kinds = F.array(*[F.lit(k) for k in KINDS + ROLES])

    def ordered(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"),
                                                      F.array_position(kinds, s["kind"]).alias("place"),
                                                      s["end"].alias("end"), s["kind"].alias("kind")))
        return concat_spans(F.array_sort(keyed))

    weak = F.transform("links", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                   s["end"].alias("end")))
    counts = [F.size(F.array_remove(F.transform("base", lambda s: s["kind"] == F.lit(k)), False)).cast("long")
              .alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(ordered(F.col("base")), 256).alias("base_sha256"),
                        ordered(F.concat("base", weak)).alias("spans"), F.size("links").cast("long").alias("n_linked"))

