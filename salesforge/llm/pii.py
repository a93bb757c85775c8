"""Personal data: exact base patterns, and bootstrapped contextual extraction of identifiers they do not cover.

The first pass over every whole text finds the base entities (the seeds) with the words around them.  A *pattern* is
such a context; an *instance* is whatever fills its slot: any token, and for phones and cards also a run of number
tokens.  Neither digits nor a length are asked of it, the pattern's confidence over all its fillers decides.  Seeds
induce patterns; Spark scores the bipartite pattern-instance graph in rounds:

    confidence(pattern, kind) = sum of its instances' weights / number of its instances     (enough distinct support)
    slot(place, kind)         = 1 - product(1 - confidence) over the confident ones of a place's patterns, else 0
    score(instance, kind)     = mean of slot over all places of the instance in the corpus
    weight(instance, pattern) = 1 for a seed, else the same mean over the places outside the pattern, if ``ACCEPT``

So a value that is seen once in a confident context and mostly in plain ones supports nothing.  Instances whose score
reaches ``ACCEPT`` are new identifiers wherever they stand; any other filler only where its context is confident.
The contexts of weighty instances are further patterns in the next round; rounds end when one adds no pattern, no
identifier and no weighty instance.  A round reads the texts at most twice: for the fillers of the new patterns, and for
the places of new fillers of confident ones.  Only slots that pass a Bloom filter of those patterns or values leave a
task, and are joined exactly afterwards; where no pattern has the support, no round runs.  Aggregates are combined before
the shuffle and no pairs are made, so a very common context is one row a score.

A pattern that s values support cannot be confident with more than s / ``CONFIDENT`` distinct fillers, since no weight is
above 1.  So a task that has seen more of them reports the pattern as common and emits no further filler of it; a common
pattern is not confident, and is looked at again when its support has grown.  The result is that of all fillers.

Defined results
* null text: as the empty text, no spans.  Offsets are code points, ends exclusive.
* spans of one kind never overlap; a discovered span overlaps no base span and has the kind of its patterns.  Of two
  kinds the better score wins, then the order of ``KINDS``.
* repeated rows get the same result each; null ids are handled like any id.
* extra columns are kept by ``mask``; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..plans.slices import input_bytes
from . import bloom
from .common import concat_spans, materialize, scratch_column, text_or_empty

# The kinds in their order and the base patterns.  They are written so that a search is linear in the
# text: a run of characters that a match can begin with is tried from its first character only, since all others would
# fail, or match, in the same way.
KINDS = ["email", "ip", "card", "phone"]
EMAIL_AFTER = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MIN_SUPPORT = 3  # distinct instances with weight that a pattern needs
CONFIDENT = 0.7
ACCEPT = 0.7
RUN_DIGITS = 19  # of the longest card: a run of number tokens with more is not one number
WHOLE_DIGITS = 8  # of the shortest phone: a token with as many is a number by itself
LONG_WORD = 64  # longer words stand in a pattern as a digest
CACHED_WORDS = 1 << 15  # in each worker; the frequent ones are soon there again
CHUNK = 1 << 17  # code points of text that are looked through at once

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]+")
_WORD = re.compile(r"\S+")
_STRIP = "\"'()[]{}<>,;:!?.*#$%&=|"
_NUMBER = r"\(?\+?[0-9](?:[0-9()./-]*[0-9)-])?"
_HEAD = re.compile(f"[{re.escape(_STRIP)}]*{_NUMBER}")  # the first of a run of number tokens, one inside, the last
_INNER = re.compile(_NUMBER)
_TAIL = re.compile(f"{_NUMBER}[{re.escape(_STRIP)}]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base entities: leftmost non-overlapping matches a kind, failing ones dropped."""
    out: list[tuple[str, int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := EMAIL_AFTER.match(text, at)):
            out.append(("email", start, done := m.end()))
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(m[0].count, "0123456789")) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _normal(word: str) -> str:
    return _DIGIT.sub("0", word.lower())


def _short(word: str) -> str:
    return word if len(word) <= LONG_WORD else f"#{hashlib.blake2b(word.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


class Words:
    """The words of a text with their places, and the contexts of its spans."""

    def __init__(self, text: str):
        self.text = text
        self.starts, self.ends = [], []
        for m in _WORD.finditer(text):
            self.starts.append(m.start())
            self.ends.append(m.end())
        self.normal: dict[int, str] = {}

    def word(self, k: int) -> str:
        if k not in self.normal:
            self.normal[k] = _normal(self.text[self.starts[k]: self.ends[k]])
        return self.normal[k]

    def contexts(self, start: int, end: int, left: int = 0, right: int | None = None) -> list[str]:
        """The lexical patterns around a span: two words before it ("a b"), and one word on each side ("b _ c").

        Digits are 0.  What is attached to the span, up to ``left`` and ``right``, counts as a word.
        """
        i, j = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        right = len(self.text) if right is None else right
        before = [_normal(w)] if (w := self.text[max(self.starts[i], left): start]) else []
        before = [*map(self.word, range(max(0, i - 2 + len(before)), i)), *before]
        after = _normal(self.text[end: min(self.ends[j], right)].lstrip(_STRIP))
        if not after and right >= self.ends[j] and j + 1 < len(self.starts):
            after = self.word(j + 1)
        after = after.strip(_STRIP)
        out = []
        if len(before) == 2:
            out.append(f"{_short(before[0])} {_short(before[1])}")
        if before and after:
            out.append(f"{_short(before[-1])} _ {_short(after)}")
        return out

    def token(self, k: int, last: int | None = None) -> tuple[int, int]:
        """The span of word k (up to word ``last``) without the punctuation around it."""
        start, end = self.starts[k], self.ends[k if last is None else last]
        first = start
        while start < end and self.text[start] in _STRIP:
            start += 1
        while end > start and self.text[end - 1] in _STRIP:
            end -= 1
        if start > first and self.text[start - 1] == "(" and 0 <= (at := self.text.find(")", start, end)) and (
                self.text.find("(", start, at) < 0):
            start -= 1  # its bracket closes inside
        return start, end

    def run(self, k: int) -> tuple[int, int] | None:
        """The first and the last word of the run of number tokens around word k, if it is one of several."""
        def digits(x: int) -> int:
            return sum(map(self.text[self.starts[x]: self.ends[x]].count, "0123456789"))

        def joined(x: int) -> bool:  # words x and x + 1
            if not (0 <= x and x + 1 < len(self.starts) and self.starts[x + 1] - self.ends[x] == 1
                    and self.text[self.ends[x]] == " "):
                return False
            a, b = (self.starts[x], self.ends[x]), (self.starts[x + 1], self.ends[x + 1])
            return (max(a[1] - a[0], b[1] - b[0]) <= LONG_WORD and _HEAD.fullmatch(self.text, *a) is not None
                    and _TAIL.fullmatch(self.text, *b) is not None and max(digits(x), digits(x + 1)) < WHOLE_DIGITS)

        first = last = k
        n = digits(k)
        while n <= RUN_DIGITS and joined(first - 1) and (first == k or _INNER.fullmatch(
                self.text, self.starts[first], self.ends[first])):
            first -= 1
            n += digits(first)
        while n <= RUN_DIGITS and joined(last) and (last == first or _INNER.fullmatch(
                self.text, self.starts[last], self.ends[last])):
            last += 1
            n += digits(last)
        return (first, last) if first < last and n <= RUN_DIGITS else None


def seeds(text: str, found: list[tuple[str, int, int]]) -> list[dict]:
    """The base entities of a text with their patterns.  A neighbour in the same word is no part of a pattern."""
    if not found:
        return []
    words, starts, ends = Words(text), sorted(s for _, s, _ in found), sorted(e for _, _, e in found)
    out = []
    for kind, s, e in found:
        left, right = bisect_right(ends, s), bisect_left(starts, e)
        out.append({"kind": kind, "value": text[s:e].lower(), "patterns": words.contexts(
            s, e, ends[left - 1] if left else 0, starts[right] if right < len(starts) else None)})
    return out


def fillers(text: str, hits: list[int]) -> list[dict]:
    """The slots that begin at these words and touch no base span.

    ``wide``: it can be a phone or card, ``narrow``: an email or ip (single tokens only).  Of a run of number tokens, only
    the run as a whole is wide; ``unit`` is where it begins.
    """
    words, out = Words(text), []
    taken = sorted((s, e) for _, s, e in base_spans(text))
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else []
    starts = [s for s, _ in taken]

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)  # spans that begin before the slot's end
        return start < end and not (before and reach[before - 1] > start)

    def slot(start: int, end: int, unit: int, wide: bool, narrow: bool) -> None:
        out.append({"unit": unit, "start": start, "end": end, "value": text[start:end].lower(), "wide": wide,
                    "narrow": narrow, "patterns": words.contexts(start, end)})

    for k in hits:
        start, end = words.token(k)
        run = words.run(k) if words.text[words.starts[k]: words.ends[k]].strip(_STRIP)[:1] in _RUN_START else None
        if run and free(*(whole := words.token(*run))):
            if k == run[0]:
                slot(*whole, whole[0], True, False)
            if free(start, end):
                slot(start, end, whole[0], False, True)
        elif free(start, end):
            slot(start, end, start, True, True)
    return out


_RUN_START = frozenset("+0123456789")
_OPEN, _NUMERIC = 1, 2  # flags in the lowest bits of a value's hash: punctuation first, may be in a run
_FLAGS = 3


def _hash(word: str) -> int:
    try:
        return xxhash.xxh3_64_intdigest(word)  # of its UTF-8
    except UnicodeEncodeError:
        return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def _flagged(word: str, bare: str, hashed: int) -> int:
    return (hashed & ~_FLAGS) | _OPEN * (word[:1] in _STRIP) | _NUMERIC * (bare[:1] in _RUN_START)


def _value_hash(word: str) -> int:
    bare = word.strip(_STRIP)
    return _flagged(word, bare, _hash(bare))


class _WordTable(dict):
    """Numbers of lower-cased words, with three hashes of each: as a value, as the word before a slot and behind it."""

    def __init__(self) -> None:
        self.value, self.before, self.after = (np.empty(CACHED_WORDS, np.uint64) for _ in range(3))
        self.long = False

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self)
        if i == len(self.value):
            self.value, self.before, self.after = (
                np.concatenate([x, np.empty_like(x)]) for x in (self.value, self.before, self.after))
        bare = word.strip(_STRIP)
        h = _hash(bare)
        self.value[i] = _flagged(word, bare, h)
        if len(word) <= LONG_WORD and not _DIGIT.search(bare):  # stands in patterns as it is
            self.before[i], self.after[i] = h if len(bare) == len(word) else _hash(word), h
            return i
        normal = _DIGIT.sub("0", word)
        self.before[i], self.after[i] = _hash(_short(normal)), _hash(_short(normal.strip(_STRIP)))
        self.long |= len(word) > LONG_WORD
        return i

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of these words; they hold until the next call, which may begin anew."""
        if len(self) >= CACHED_WORDS or self.long:  # long words are not kept
            self.clear()
            self.long = False
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _give_back() -> None:
    """At a task's end: a worker stays for later tasks, also of other operators, and would keep the table beside theirs."""
    _words.clear()
    pa.default_memory_pool().release_unused()


_words = _WordTable()
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _key(first: np.ndarray, second: np.ndarray, around: bool) -> np.ndarray:
    h = first * _FACTORS[2 * around] + second * _FACTORS[2 * around + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(32)
    return h.view(np.int64)


def pattern_keys(patterns: list[str]) -> np.ndarray:
    """The hash of each pattern, as ``slots_at`` computes it from a text's words."""
    parts = [p.split(" ") for p in patterns]
    around = np.array([len(p) == 3 for p in parts], bool)
    first, second = (np.array([_hash(p[i]) for p in parts], np.uint64) for i in (0, -1))
    return np.where(around, _key(first, second, True), _key(first, second, False))


def value_keys(values: list[str]) -> np.ndarray:
    return (np.array([_value_hash(v) for v in values], np.uint64) & ~np.uint64(_FLAGS)).view(np.int64)


@pandas_udf(T.LongType())
def pattern_key(patterns: pd.Series) -> pd.Series:
    return pd.Series(pattern_keys(list(patterns)), dtype="int64")


@pandas_udf(T.LongType())
def value_key(values: pd.Series) -> pd.Series:
    return pd.Series(value_keys(list(values)), dtype="int64")


def slots_at(texts: list[str], patterns: Callable | None, values: np.ndarray | None) -> list[list[dict]]:
    """The slots of each text that may have one of the patterns (a test of their keys) or values (a Bloom filter)."""
    words = [t.lower().split() for t in texts]
    at = _words.numbers([w for ws in words for w in ws])
    v = _words.value[at]
    number = (v & np.uint64(_NUMERIC)) != 0
    hit = (v & np.uint64(_OPEN)) != 0
    hit[:-1] |= number[:-1] & number[1:]  # may begin a run
    if values is not None:
        hit |= bloom.might_contain(values, (v & ~np.uint64(_FLAGS)).view(np.int64))
    if patterns is not None:
        b, a = _words.before[at], _words.after[at]
        hit[2:] |= patterns(_key(b[:-2], b[1:-1], False))
        hit[1:-1] |= patterns(_key(b[:-2], a[2:], True))
    out, at = [], 0
    for text, ws in zip(texts, words, strict=True):
        k = np.flatnonzero(hit[at: at + len(ws)])
        out.append(fillers(text, k.tolist()) if len(k) else [])
        at += len(ws)
    found = [s for own in out for s in own]  # again with the patterns as they are
    if not found:
        return out
    keep = np.zeros(len(found), bool)
    if values is not None:
        keep |= bloom.might_contain(values, value_keys([s["value"] for s in found]))
    if patterns is not None:
        of = np.repeat(np.arange(len(found)), [len(s["patterns"]) for s in found])
        np.logical_or.at(keep, of, patterns(pattern_keys([p for s in found for p in s["patterns"]])))
    kept = iter(keep.tolist())
    return [[s for s in own if next(kept)] for own in out]


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                   T.StructField("end", T.IntegerType())]))
_SEEDS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType()),
                                   T.StructField("patterns", T.ArrayType(T.StringType()))]))
_SLOTS = T.ArrayType(T.StructType([
    T.StructField("unit", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("value", T.StringType()), T.StructField("wide", T.BooleanType()),
    T.StructField("narrow", T.BooleanType()), T.StructField("patterns", T.ArrayType(T.StringType()))]))


@pandas_udf(T.StructType([T.StructField("base", _SPANS), T.StructField("seeds", _SEEDS)]))
def scan_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Base spans of each text, and the same as seeds with their patterns."""
    for part in texts:
        base, own = [], []
        for text in part:
            found = base_spans(text)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            own.append(seeds(text, found))
        yield pd.DataFrame({"base": base, "seeds": own})
    _give_back()


scan_udf = scan_udf.asNondeterministic()


@pandas_udf(T.StringType())
def mask_udf(texts: pd.Series, found: pd.Series) -> pd.Series:
    """The texts with base and discovered spans replaced by their kind."""
    out = []
    for text, more in zip(texts, found, strict=True):
        spans = base_spans(text) + [(x["kind"], x["start"], x["end"]) for x in (more if more is not None else [])]
        parts, at = [], 0
        for start, end, kind in sorted((s, e, k) for k, s, e in spans):
            if start >= at:
                parts += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        out.append("".join([*parts, text[at:]]))
    return pd.Series(out)


def _filter_of(keys: DataFrame | None, column: str, key: Callable) -> np.ndarray | None:
    if keys is None:
        return None
    hashed = materialize(keys.select(key(column).alias("h")))
    return bloom.build(hashed, "h", hashed.count())


_COMMON_STATE = 2_000_000  # fillers that a task remembers


class _Fillers:
    """What a task has emitted: each filler of a pattern once, and none any more of patterns that are common.

    ``asked`` is a Bloom filter of all patterns, ``limits`` has one for each power of two: patterns whose limit is below
    it.  A pattern that passes by mistake has a higher limit than its own, which costs rows and no result.
    """

    def __init__(self, asked: np.ndarray, limits: list[tuple[int, np.ndarray]]):
        self.asked, self.limits = asked, limits
        self.seen: dict[int, tuple[set[int], set[int]]] = {}
        self.size = 0
        self.common: set[int] = set()
        self.sorted = np.empty(0, np.int64)

    def limit_of(self, keys: np.ndarray) -> np.ndarray:
        """The limit of each pattern key, 0 for patterns that are not asked for."""
        out = np.zeros(len(keys), np.int64)
        for limit, bits in self.limits:  # ascending
            out[bloom.might_contain(bits, keys)] = limit
        return out

    def open(self, keys: np.ndarray) -> np.ndarray:
        """Whether fillers of these patterns are still asked for."""
        if len(self.common) != len(self.sorted):
            self.sorted = np.sort(np.fromiter(self.common, np.int64, len(self.common)))
        wanted = bloom.might_contain(self.asked, keys)
        if len(self.sorted):
            some = keys[wanted]
            at = np.searchsorted(self.sorted, some)
            wanted[wanted] = self.sorted.take(at, mode="clip") != some
        return wanted

    def add(self, slots: list[dict]) -> Iterator[tuple]:
        """(pattern, value, wide, narrow) of fillers that are new here; a pattern that becomes common has no value."""
        patterns = [p for s in slots for p in s["patterns"]]
        if not patterns:
            return
        keys = pattern_keys(patterns)
        limits = iter(zip(keys.tolist(), self.limit_of(keys).tolist(), strict=True))
        for s in slots:
            h = hash(s["value"])
            for pattern in s["patterns"]:
                key, limit = next(limits)
                if not limit or key in self.common:
                    continue
                wide, narrow = self.seen.setdefault(key, (set(), set()))
                new = (s["wide"] and h not in wide) or (s["narrow"] and h not in narrow)
                if not new:
                    continue
                wide |= {h} if s["wide"] else set()
                narrow |= {h} if s["narrow"] else set()
                self.size += 1
                if min(len(wide), len(narrow)) > limit:
                    self.common.add(key)
                    del self.seen[key]
                    yield pattern, None, True, True
                else:
                    yield pattern, s["value"], s["wide"], s["narrow"]
        if self.size > _COMMON_STATE:  # forgetting only makes a task emit a filler again
            self.seen, self.size = {}, 0


def _pattern_limits(patterns: DataFrame) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """A Bloom filter of the patterns (pattern, limit), and (upper bound, filter) for each power of two of the limits."""
    keyed = materialize(patterns.select(pattern_key("pattern").alias("h"),
                                        F.ceil(F.log2(F.col("limit") + 1)).cast("int").alias("power")))
    sizes = {r["power"]: r["count"] for r in keyed.groupBy("power").count().collect()}  # at most 64 rows
    limits = [(1 << p, bloom.build(keyed.where(F.col("power") == p), "h", n, bloom.MAX_BYTES // len(sizes)))
              for p, n in sorted(sizes.items())]
    return bloom.build(keyed, "h", sum(sizes.values())), limits


def _pattern_fillers(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, value, wide, narrow, limit): the fillers of ``patterns`` (pattern, limit); of a common one a null value."""
    limits = docs.sparkSession.sparkContext.broadcast(_pattern_limits(patterns))

    def collect(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = _Fillers(*limits.value)
        for part in parts:
            held, size, rows = [], 0, []
            for text in [*part["text"], None]:
                if text is not None:
                    held.append(text)
                    size += len(text)
                if held and (text is None or size >= CHUNK):
                    for slots in slots_at(held, found.open, None):
                        rows += found.add(slots)
                    held, size = [], 0
            yield pd.DataFrame(rows, columns=["pattern", "value", "wide", "narrow"])
        _give_back()

    return docs.select("text").mapInPandas(
        collect, "pattern string, value string, wide boolean, narrow boolean").join(patterns, "pattern")


# Of inputs beyond this, the fillers are gathered in growing shares of the texts: up to these 64ths of them.
SHARE_BYTES = 64 << 20
_SHARES, _PARTS = (1, 8, 64), 64


def _fillers_of(docs: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, value, wide, narrow), fillers of ``patterns`` (pattern, limit), and (pattern, limit) of the common ones.

    A pattern that has more fillers than its limit in a share of the texts has them in all texts: its fillers are left out,
    and no later share looks for them.  A limit grows with the corpus, so a task by itself seldom finds out.
    """
    share, before, common = F.pmod("text_hash", F.lit(_PARTS)), 0, []
    edges, asked = _no_rows(docs.sparkSession, "pattern string, value string, wide boolean, narrow boolean"), patterns
    for upto in _SHARES if input_bytes(docs) > SHARE_BYTES else (_PARTS,):
        some = docs.where((share >= before) & (share < upto)) if (before, upto) != (0, _PARTS) else docs
        filled = materialize(_pattern_fillers(some, asked))
        rows = edges.union(filled.where(F.col("value").isNotNull()).select("pattern", "value", "wide", "narrow"))
        gone = filled.where(F.col("value").isNull()).select("pattern", "limit").distinct()
        if upto < _PARTS:
            rows = materialize(rows.groupBy("pattern", "value").agg(
                F.max("wide").alias("wide"), F.max("narrow").alias("narrow")))
            over = (rows.groupBy("pattern").agg(F.least(F.count_if("wide"), F.count_if("narrow")).alias("n"))
                    .join(asked, "pattern").where("n > limit").select("pattern", "limit"))
            gone = materialize(gone.union(over).distinct())
            asked, before = materialize(asked.join(gone, "pattern", "left_anti")), upto
        common.append(gone)
        edges = rows.join(gone, "pattern", "left_anti")
        if upto < _PARTS and asked.isEmpty():
            break
    return edges, reduce(DataFrame.union, common)


def _slots(docs: DataFrame, patterns: DataFrame | None, values: DataFrame | None) -> DataFrame:
    """(id, text_hash, slot columns) of the slots that may have one of the patterns or of the values."""
    bits = docs.sparkSession.sparkContext.broadcast(
        (_filter_of(patterns, "pattern", pattern_key), _filter_of(values, "value", value_key)))

    @pandas_udf(_SLOTS)
    def look(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        patterns, values = bits.value
        tests = (None if patterns is None else partial(bloom.might_contain, patterns)), values
        for part in parts:
            texts, out, held, size = list(part), [], [], 0
            for text in texts:
                held.append(text)
                size += len(text)
                if size >= CHUNK:
                    out += slots_at(held, *tests)
                    held, size = [], 0
            yield pd.Series(out + slots_at(held, *tests), dtype=object)
        _give_back()

    return docs.select("id", "text_hash", F.explode(look.asNondeterministic()("text")).alias("s")).select(
        "id", "text_hash", "s.*")


# Phones and cards can be runs of tokens, the other kinds single tokens only.
_FITS = "(wide and kind in ('phone', 'card')) or (narrow and kind in ('email', 'ip'))"


def _supported(edges: DataFrame, limited: bool = True) -> DataFrame:
    """(pattern, limit): patterns that enough distinct values of a kind support; edges: (pattern, kind, value), distinct.

    ``limit``: how many distinct fillers a confident one can have at most.
    """
    most = edges.groupBy("pattern", "kind").count().where(F.col("count") >= MIN_SUPPORT).groupBy("pattern").agg(
        F.max("count").alias("n"))
    limit = F.floor(F.col("n") / CONFIDENT) if limited else F.lit(1 << 40)
    return most.select("pattern", limit.cast("long").alias("limit"))


def _confident(edges: DataFrame, weights: DataFrame) -> DataFrame:
    """(pattern, kind, conf) of the confident patterns; edges: all their fillers; weights: (pattern, kind, value, weight)."""
    sizes = edges.groupBy("pattern").agg(F.count_if("wide").alias("n_wide"), F.count_if("narrow").alias("n_narrow"))
    n = F.when(F.col("kind").isin("phone", "card"), F.col("n_wide")).otherwise(F.col("n_narrow"))
    return materialize(
        edges.join(weights, ["pattern", "value"]).where(_FITS).groupBy("pattern", "kind")
        .agg(F.sum("weight").alias("sum"), F.count("*").alias("support")).where(F.col("support") >= MIN_SUPPORT)
        .join(sizes, "pattern").withColumn("conf", F.col("sum") / n).where(F.col("conf") >= CONFIDENT)
        .select("pattern", "kind", "conf"))


def _weigh(places: DataFrame, conf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(value, kind, score) of the accepted instances, and (pattern, kind, value, weight) of the weighty ones.

    places: (value, wide, narrow, patterns, n), all places of the instances, equal ones counted.
    """
    each = places.withColumn("pattern", F.explode("patterns"))
    scored = materialize(each.join(conf, "pattern").where(_FITS).groupBy("value", "wide", "narrow", "patterns", "kind")
                         .agg((F.first("n") * (1 - F.product(1 - F.col("conf")))).alias("s")))
    totals = places.groupBy("value").agg(F.sum("n").alias("n"))
    sums = materialize(scored.groupBy("value", "kind").agg(F.sum("s").alias("s")).join(totals, "value"))
    accepted = sums.select("value", "kind", (F.col("s") / F.col("n")).alias("score")).where(F.col("score") >= ACCEPT)
    inside = scored.select("value", "kind", "s", F.explode("patterns").alias("pattern")).groupBy(
        "value", "kind", "pattern").agg(F.sum("s").alias("s_in"))
    weights = (sums.join(each.groupBy("value", "pattern").agg(F.sum("n").alias("n_in")), "value")
               .join(inside, ["value", "kind", "pattern"], "left").where("n > n_in")
               .withColumn("weight", (F.col("s") - F.coalesce("s_in", F.lit(0.0))) / (F.col("n") - F.col("n_in")))
               .where(F.col("weight") >= ACCEPT).select("pattern", "kind", "value", "weight"))
    return materialize(accepted), materialize(weights)


def _no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame that the JVM makes: ``createDataFrame`` would start Python workers of another kind to read none."""
    fields = (f.strip().split(" ") for f in schema.split(","))
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])


def _scores(docs: DataFrame, seed_edges: DataFrame, limited: bool = True) -> tuple[DataFrame, DataFrame]:
    """What all rounds find: (pattern, kind, score) confident and (value, kind, score) accepted.

    seed_edges: (pattern, kind, value), distinct.  Weights and confidences never fall, so these sets only grow.
    ``limited``: leave the fillers of common patterns out, which changes nothing but the work.
    """
    spark = docs.sparkSession
    sown = seed_edges.withColumn("weight", F.lit(1.0))
    conf = _no_rows(spark, "pattern string, kind string, conf double")
    accepted = _no_rows(spark, "value string, kind string, score double")
    edges = _no_rows(spark, "pattern string, value string, wide boolean, narrow boolean")
    places = _no_rows(spark, "value string, wide boolean, narrow boolean, patterns array<string>, n long")
    known = _no_rows(spark, "pattern string, limit long")  # the limit up to which fillers were asked for
    weights, tried = sown, seed_edges.select("value").distinct()
    new = materialize(_supported(seed_edges, limited))
    before = now = (0, 0, 0)
    while not new.isEmpty() or before != now:
        if not new.isEmpty():
            filled, common = _fillers_of(docs, new)
            seeded = seed_edges.join(new, "pattern").select("pattern", "value", F.lit(True).alias("wide"),
                                                            F.lit(True).alias("narrow"))
            rows = filled.union(seeded)
            edges = materialize(edges.union(rows.join(common, "pattern", "left_anti").groupBy("pattern", "value").agg(
                F.max("wide").alias("wide"), F.max("narrow").alias("narrow"))))
            whole = new.join(common, "pattern", "left_anti").select("pattern", F.lit(1 << 62).alias("limit"))
            known = materialize(known.join(new, "pattern", "left_anti").union(whole).union(common))
        conf = _confident(edges, weights)
        values = materialize(edges.join(conf, "pattern").where(_FITS).select("value").distinct()
                             .join(tried, "value", "left_anti"))
        if not values.isEmpty():
            places = materialize(places.union(_slots(docs, None, values).join(values, "value").groupBy(
                "value", "wide", "narrow", "patterns").agg(F.count("*").alias("n"))))
            tried = materialize(tried.union(values))
        accepted, grown = _weigh(places, conf)
        weights = sown.union(grown)
        more = known.select("pattern", F.col("limit").alias("asked"))
        new = materialize(_supported(weights, limited).join(more, "pattern", "left")
                          .where(F.col("asked").isNull() | (F.col("asked") < F.col("limit"))).drop("asked"))
        before, now = now, (conf.count(), accepted.count(), grown.count())
    return conf.withColumnRenamed("conf", "score"), accepted


def discover(docs: DataFrame, scanned: DataFrame, limited: bool = True) -> DataFrame:
    """(id, text_hash, found): discovered spans of each text that has any; docs: id, text_hash, text; scanned: ``scan``."""
    seed_edges = materialize(scanned.select(F.explode("seeds").alias("s"))
                             .select(F.explode("s.patterns").alias("pattern"), "s.kind", "s.value").distinct())
    conf, accepted = _scores(docs, seed_edges, limited)
    if conf.isEmpty():
        return docs.limit(0).select("id", "text_hash", F.array().cast(_SPANS).alias("found"))
    slots = materialize(_slots(docs, conf.select("pattern").distinct(), accepted.select("value").distinct()))
    place = ["id", "text_hash", "unit", "start", "end", "wide"]
    here = (slots.withColumn("pattern", F.explode("patterns")).join(conf, "pattern").where(_FITS)
            .groupBy(*place, "kind").agg((1 - F.product(1 - F.col("score"))).alias("score")))
    anywhere = slots.join(accepted, "value").where(_FITS).select(*place, "kind", "score")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = here.union(anywhere).groupBy(*place).agg(F.max_by("kind", F.struct("score", -rank)).alias("kind"))
    # a found run (the only wide slot of its unit) goes before the tokens in it
    run = F.max("wide").over(Window.partitionBy("id", "text_hash", "unit"))
    return (best.withColumn("run", run).where(F.col("wide") | ~F.col("run")).groupBy("id", "text_hash")
            .agg(F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("found")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, text) of every row."""
    text = text_or_empty(F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def scan(keyed: DataFrame) -> DataFrame:
    """(id, text_hash, base, seeds) of every row of ``_keyed``, cut from its lineage."""
    return materialize(keyed.select("id", "text_hash", scan_udf("text").alias("s"))
                       .select("id", "text_hash", "s.base", "s.seeds"))


def _in_order(spans: Column) -> Column:
    rank = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans, lambda s: F.struct(
        F.array_position(rank, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(
        F.element_at(rank, s["k"].cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found, has_pii) for every row."""
    keyed = _keyed(docs, id_col, text_col)
    scanned = scan(keyed)
    found = discover(keyed, scanned)
    rows = scanned.select("id", "text_hash", "base").join(
        found.select(F.col("id").alias("id_"), F.col("text_hash").alias("hash_"), "found"),
        F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")), "left")
    more = F.coalesce("found", F.array().cast(_SPANS))
    return rows.select(
        F.col("id").alias("doc_id"),
        *[F.size(F.array_remove(F.transform("base", lambda s: s["kind"] != F.lit(k)), True)).cast("long")
          .alias(f"n_{k}") for k in KINDS],
        F.sha2(concat_spans(_in_order(F.col("base"))), 256).alias("base_sha256"),
        concat_spans(_in_order(F.concat("base", more))).alias("spans"),
        F.size(more).cast("long").alias("n_found"), (F.size("base") + F.size(more) > 0).alias("has_pii"))


# A table of discovered spans up to this many rows and spans is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 50_000
BROADCAST_SPANS = 500_000


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``chars_col`` gets the new length."""
    keyed = _keyed(docs, id_col, text_col)
    found = materialize(discover(keyed, scan(keyed)))
    i, h, f = (scratch_column(docs, x) for x in ("id", "hash", "found"))
    found = found.select(F.col("id").alias(i), F.col("text_hash").alias(h), F.col("found").alias(f))
    rows, spans = found.agg(F.count("*"), F.coalesce(F.sum(F.size(f)), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and spans <= BROADCAST_SPANS:
        found = F.broadcast(found)
    text = text_or_empty(F.col(f"`{text_col}`"))
    rows = docs.join(found, F.col(f"`{id_col}`").eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(h)), "left")
    new = scratch_column(rows, "masked")
    rows = rows.withColumn(new, mask_udf(text, F.col(f)))
    columns = {text_col: F.when(F.col(f"`{text_col}`").isNotNull(), F.col(new))}
    if chars_col:
        columns[chars_col] = F.when(F.col(new) == text, F.col(f"`{chars_col}`")).otherwise(
            F.length(new).cast("long"))
    return rows.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
