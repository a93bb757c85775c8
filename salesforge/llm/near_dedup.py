"""Near-duplicates by bottom-k sketches from one hash function.

1. Every whole text becomes its set of hashed word shingles; the k smallest hashes are its sketch.  Equal sets are
   collapsed to one node first, so groups of copies cost one row.
2. Retained values that two nodes or more share form inverted lists.  A sketch of size m of a pair above the threshold
   shares at least c values with its partner (exact for small sets, else a binomial bound with error 1e-12),
   so ordering each sketch by list length and keeping the m - c + 1 rarest values loses no pair:
   a passage that many documents share stays out of the lists, unless it is most of a document.
3. Star links: each list pairs its members with its most central member only (linear in the list).
   Union-sketch estimates drop hopeless pairs, exact Jaccard on the full sets decides.
4. What is left: pairs in a list whose members are still in different components.  They are all tried, so no link that
   could join two components is lost; pairs inside a component could not change the result and are never emitted.

Defined results
* null or empty text, text without words: empty set, linked with nothing, its own component, kept.
* fewer words than a shingle: the whole sequence is the one shingle.
* null id: counted, linked with nothing, component null, kept.
* repeated rows: each gets the same result.  Rows that share an id but not the text are documents of their own.
* ties: the smallest id represents a component.  Extra columns are not read.  Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from . import bloom
from .common import materialize, scratch_column, scratch_folder, text_or_empty
from .components import connected_components

WORDS = 5
PERCENT = 75
K = 192
MISS = 1e-12
HEAD = 48  # earlier values of a node that are looked at to emit a pair once
BLOCK = 1 << 18  # bytes of text that are hashed at once; longer words are hashed by themselves
ROWS, VALUES = 500, 1 << 20  # of a batch that leaves a task

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTORS = [np.uint64(x) for x in (  # odd numbers, one for each place of a word in a shingle
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_ROLL = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2^64


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _byte_values() -> np.ndarray:
    """A well mixed number for each byte: A-Z as a-z, nothing for white space."""
    values = _mix(np.frombuffer(_LOWER, np.uint8).astype(np.uint64) + np.uint64(1))
    values[_WHITE] = 0
    return values


_VALUES = _byte_values()
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``_ROLL`` and of its inverse, modulo 2^64."""
    if not _POWERS:
        for base in (_ROLL, pow(_ROLL, -1, 1 << 64)):
            steps = np.full(BLOCK, np.uint64(base))
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased: a rolling hash over the bytes, cut at white space.

    Nothing is kept between texts.  A word of ``BLOCK`` bytes or more is hashed as a whole.
    """
    powers, inverse = _powers()
    text, out, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(text):
        part = text[at: at + BLOCK]
        white = _WHITE[part]
        if len(part) == BLOCK:
            gaps = np.flatnonzero(white)
            if not len(gaps):
                end = at + BLOCK
                while end < len(text) and not (stop := np.flatnonzero(_WHITE[text[end: end + BLOCK]])).size:
                    end = min(end + BLOCK, len(text))
                else:
                    end += int(stop[0]) if end < len(text) else 0
                word = data[at:end].translate(_LOWER)
                out.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
                at = end
                continue
            part, white = part[: gaps[-1] + 1], white[: gaps[-1] + 1]
        starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
        if len(starts):
            sums = np.add.reduceat(_VALUES[part] * powers[: len(part)], starts)
            out.append(_mix(sums * inverse[starts]))
        at += len(part)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: str | bytes, size: int = WORDS) -> np.ndarray:
    """The sorted distinct 63-bit hashes of the text's shingles of ``size`` words, A-Z lower-cased."""
    h = word_hashes(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text)
    if not len(h):
        return np.empty(0, np.int64)
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), np.uint64)  # shorter sequences differ by their length
    for i in range(min(size, len(h))):
        out += h[i: i + n] * _FACTORS[i % len(_FACTORS)] * np.uint64(2 * (i // len(_FACTORS)) + 1)
    return np.unique((_mix(out) >> np.uint64(1)).view(np.int64))  # as signed numbers they keep their order


def _digest(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches (id, text as bytes) with their shingle sets, bounded by rows and values."""
    for batch in batches:
        sets, first, values = [], 0, 0
        for i, text in enumerate(batch.column("text")):
            sets.append(shingle_set(text.as_py()))
            values += len(sets[-1])
            if len(sets) == ROWS or values >= VALUES:
                yield batch.slice(first, len(sets)), sets
                sets, first, values = [], i + 1, 0
        if sets:
            yield batch.slice(first, len(sets)), sets


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_digest, sets), pa.binary()),
             _lists([s[:K] for s in sets])], ["id", "n", "digest", "sketch"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(map(_digest, sets), pa.binary()), _lists(sets)],
                                         ["id", "digest", "set"])


def shared_at_least(k: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """The largest c such that fewer than c of k draws hit with probability ``miss`` at most, at percent/100 each."""
    p, total = percent / 100, 0.0
    for c in range(k + 1):
        total += math.comb(k, c) * p**c * (1 - p) ** (k - c)
        if total > miss:
            return c
    return k


@pandas_udf(T.BooleanType())
def maybe_udf(sa: pd.Series, sb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    """Union-sketch test of a pair: too few of the union's smallest values in both sketches rules it out.

    A row holds two sketches, so batches are bounded.
    """
    least = shared_at_least(K)
    out = np.empty(len(sa), bool)
    for i, (a, b, n, m) in enumerate(zip(sa, sb, na, nb, strict=True)):
        both = np.intersect1d(a, b, assume_unique=True)
        if n <= K and m <= K:  # whole sets
            out[i] = 100 * len(both) >= PERCENT * (len(a) + len(b) - len(both))
        else:
            union = np.union1d(a, b)[:K]
            shared = np.searchsorted(both, union[-1], side="right")
            out[i] = shared >= min(least, math.ceil(PERCENT / 100 * len(union)))
    return pd.Series(out)


def _similar(x: Column, y: Column) -> Column:
    """The exact test on full sets, in the JVM: they have no bound, so they stay out of Arrow batches."""
    both = F.size(F.array_intersect(x, y)).cast("long")  # 100 * both >= PERCENT * (x + y - both)
    return (100 + PERCENT) * both >= PERCENT * (F.size(x) + F.size(y)).cast("long")


def _can_link(n_a: Column, n_b: Column, after_a: Column, after_b: Column) -> Column:
    """False where the sizes, or the values that are left in both sketches, rule the pair out.

    Holds for the pair's rarest shared value, so a pair above the threshold passes in at least one list.
    """
    whole = F.ceil((n_a + n_b) * PERCENT / (100 + PERCENT))  # shared by whole sets
    need = F.when((n_a <= K) & (n_b <= K), whole).otherwise(F.least(whole, F.lit(shared_at_least(K))))
    return ((100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b))
            & (F.least(after_a, after_b) + 1 >= need))


def _prefixes(nodes: DataFrame) -> DataFrame:
    """(node, n, own, others, prefix): the rarest retained values that others share, enough to meet every partner.

    ``own``: how many retained values no other node has; central nodes of a group have few.  ``others``: how many
    others share; ``prefix``: the rarest of them, in order.
    """
    values = nodes.select(F.explode("sketch").alias("value"))
    shared = materialize(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"))
    bits = nodes.sparkSession.sparkContext.broadcast(bloom.build(shared, "value", shared.count()))

    @pandas_udf(T.ArrayType(T.LongType()))
    def maybe_shared(sketches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in sketches:  # values of one node only go before they are shuffled
            arrays = [np.asarray(s, np.int64) for s in part]
            hit = bloom.might_contain(bits.value, np.concatenate(arrays) if arrays else np.empty(0, np.int64))
            cuts = np.cumsum([len(a) for a in arrays])[:-1] if arrays else []
            yield pd.Series([a[h] for a, h in zip(arrays, np.split(hit, cuts), strict=True)])

    rows = nodes.select("node", "n", F.size("sketch").alias("m"), F.explode(maybe_shared("sketch")).alias("value"))
    # a set of at most PERCENT % of K has partners with whole sketches only, so its bound is exact
    exact = F.ceil(F.col("m") * PERCENT / 100)
    need = F.when(F.col("n") * 100 <= K * PERCENT, exact).otherwise(F.least(exact, F.lit(shared_at_least(K))))
    lists = rows.join(shared, "value").groupBy("node").agg(
        F.first("n").alias("n"), F.first("m").alias("m"),
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("found"))  # at most K values a node
    own = F.col("m") - F.size("found")
    take = F.greatest(F.col("m") - need + 1 - own, F.lit(0)).cast("int")
    return materialize(lists.select("node", "n", own.alias("own"), F.size("found").alias("others"),
                                    F.transform(F.slice("found", F.lit(1), take), lambda f: f["value"]).alias("prefix"))
                       .where(F.size("prefix") > 0))


def _postings(prefixes: DataFrame) -> DataFrame:
    """(value, place, node, n, own, after), a row for each prefix value.

    ``after``: how many of the node's shared values are as common as this one or more so; no more can be shared with a
    partner besides the pair's rarest shared value.
    """
    return (prefixes.select("node", "n", "own", "others", F.posexplode("prefix").alias("place", "value"))
            .select("value", "place", "node", "n", "own", (F.col("others") - F.col("place") - 1).alias("after")))


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar, by estimate and then by the full sets."""
    sk = nodes.select("node", "sketch", "n")
    near = (pairs.join(sk.select(F.col("node").alias("v"), F.col("sketch").alias("sb"), F.col("n").alias("nb")), "v")
            .join(sk.select(F.col("node").alias("u"), F.col("sketch").alias("sa"), F.col("n").alias("na")), "u")
            .where(maybe_udf("sa", "sb", "na", "nb")).select("u", "v", "na", "nb"))
    near = materialize(near)
    # sets that are their own sketch are verified already
    small = near.where((F.col("na") <= K) & (F.col("nb") <= K)).select("u", "v")
    large = near.where((F.col("na") > K) | (F.col("nb") > K)).select("u", "v")
    wanted = materialize(large.select(F.explode(F.array("u", "v")).alias("node")).distinct()
                         .join(nodes.select("node", "id", "digest"), "node"))
    n_wanted = wanted.count()
    if not n_wanted:
        return small
    bits = nodes.sparkSession.sparkContext.broadcast(
        bloom.build(wanted.select(F.xxhash64("id").alias("h")), "h", n_wanted))

    def wanted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one Python worker a task: a filter by itself would be a second one beside it, which stays for later tasks
        return _whole_sets(b.filter(pa.array(bloom.might_contain(bits.value, b.column("h").to_numpy()))) for b in batches)

    sets = (docs.where(F.col("id").isNotNull()).withColumn("h", F.xxhash64("id"))
            .mapInArrow(wanted_sets, "id long, digest binary, set array<long>")
            .join(wanted, ["id", "digest"]).dropDuplicates(["node"]).select("node", "set"))
    sets = materialize(sets)
    return small.union(
        large.join(sets.select(F.col("node").alias("v"), F.col("set").alias("y")), "v")
        .join(sets.select(F.col("node").alias("u"), F.col("set").alias("x")), "u")
        .where(_similar(F.col("x"), F.col("y"))).select("u", "v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    with scratch_folder(docs.sparkSession, "sketches") as folder:  # of all rows: they go once the nodes have theirs
        docs.mapInArrow(_sketched, "id long, n long, digest binary, sketch array<long>").write.parquet(folder)
        rows = docs.sparkSession.read.parquet(folder)
        base = materialize(rows.select("id", "n", "digest"))
        # a node is a distinct set; its number is that of its stored row
        nodes = materialize(rows.where("n > 0 and id is not null").groupBy("digest").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
            .withColumn("node", F.monotonically_increasing_id()))
    prefixes = _prefixes(nodes)
    postings = _postings(prefixes)

    centre = postings.groupBy("value").agg(F.min(F.struct("own", "n", "node", "after")).alias("c"))
    stars = (postings.join(centre, "value").where("node <> c.node")
             .where(_can_link(*map(F.col, ("n", "c.n", "after", "c.after"))))
             .select(F.greatest("node", "c.node").alias("v"), F.least("node", "c.node").alias("u")).distinct())
    stars = materialize(stars)
    links = materialize(_verified(docs, nodes, stars))
    roots = connected_components(links)

    placed = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    placed = materialize(placed.join(mixed.select("value"), "value"))
    # a pair that meets in an earlier value of both is emitted there
    met = placed.join(prefixes.select("node", "prefix"), "node").withColumn(
        "before", F.slice("prefix", F.lit(1), F.least("place", F.lit(HEAD))))
    a, b = (met.select("value", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "after", "before", "root")])
            for side in "ab")
    rest = (a.join(b, "value").where("root_a < root_b")
            .where(_can_link(*map(F.col, ("n_a", "n_b", "after_a", "after_b"))))
            .where(~F.arrays_overlap("before_a", "before_b"))
            .select(F.least("node_a", "node_b").alias("u"), F.greatest("node_a", "node_b").alias("v")).distinct()
            .join(stars, ["u", "v"], "left_anti"))
    more = materialize(_verified(docs, nodes, materialize(rest)))
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    rooted = nodes.select("digest", "id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    groups = rooted.select("digest", "root").join(least, "root").select("digest", "component_id")
    return base.join(groups, "digest", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each component its smallest id stays, with all its columns.

    Only documents that a Bloom filter of the ids to drop cannot rule out are joined, so most texts are not shuffled.
    """
    gone = scratch_column(docs, "gone")
    drop = materialize(near_duplicates(docs, id_col, text_col).where("not kept")
                       .select(F.col("doc_id").alias(gone)).distinct())
    n_drop = drop.count()
    bits = docs.sparkSession.sparkContext.broadcast(
        bloom.build(drop.select(F.xxhash64(gone).alias("h")), "h", n_drop))

    @pandas_udf(T.BooleanType())
    def maybe_gone(hashes: pd.Series) -> pd.Series:
        return pd.Series(bloom.might_contain(bits.value, hashes.to_numpy(np.int64)))

    doc_id = F.col(f"`{id_col}`").cast("long")
    maybe = doc_id.isNotNull() & maybe_gone(F.xxhash64(doc_id))
    return docs.where(~maybe).union(docs.where(maybe).join(drop, doc_id == F.col(gone), "left_anti"))
