"""Spelling variants: words that differ by one edit, and the frequent form that each of them most likely stands for.

1. Tasks count the words of whole texts and send (word, n) partial sums.
2. Words meet in blocks: a block holds the words of one length and the next one (the adjacent length) that share half of
   their letters in place.  One edit leaves the first or the last half of the shorter word untouched, so every near pair
   meets; a pair that shares both halves is taken in the first one only.
3. In a block, the NumPy product of the letter-count matrix with itself (the Gram matrix) gives all squared distances.
   One edit moves them by 2 at most.  The few pairs that pass are verified letter by letter.
4. A block beyond ``TILE`` words is cut into tiles by a hash, and each pair of tiles is a unit of its own, so one task never
   holds more than two tiles.  Units report sums a word, not pairs.
5. Forms are followed to the last one by pointer doubling; n grows tenfold with each step, so few rounds do.

Defined results
* null or empty text, text without a long enough run: no words.
* null id: its words are hashed with an empty id.  Repeated rows count again.
* very long texts: counted whole; a task holds the distinct words of one text and ``HELD`` sums.
* ties: of near words with the same n the smallest in code-point order is the form.
* extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH = 7
MIN_COUNT = 2
DAMAGE = 31  # one run in so many loses a letter
RATIO = 10   # a form is so many times as frequent
HELD = 200_000
TILE = 1024
TILE_CHARS = 1 << 18
PACK = 512   # rows of small units that share one product

_LETTERS = 26 + 64  # a-z and the accented block
_LETTER_OF = np.full(256, _LETTERS)
_LETTER_OF[ord("a"): ord("z") + 1] = np.arange(26)
_LETTER_OF[0xC0:0x100] = 26 + np.arange(64)


def damaged(doc: str, run: str) -> str:
    """The lower-cased run, without one letter where the hash of the id and the run says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts with ``min_length`` letters or more that occur ``min_count`` times or more."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        for part in parts:
            for doc, text in zip(part["id"], part["text"], strict=True):
                lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for run, n in Counter(RUN.findall(lower)).items():
                    if len(run) >= min_length:
                        word = damaged(doc, run)
                        if len(word) >= min_length:
                            held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
                    held = {}
        yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())}).astype({"word": object, "n": "int64"})

    rows = docs.select(text_or_empty(F.col(f"`{id_col}`").cast("string")).alias("id"),
                       text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    return (rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def blocks(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(base, half, side, word, n): each word in the blocks of its own length (side 0) and of the length below (side 1).

    ``half`` starts with ``h`` or ``t``: the first ``base // 2`` letters or the other ones, counted from the end.
    """
    length = F.length("word")

    def member(side: int, from_start: bool) -> Column:
        base = length - side
        head = F.floor(base / 2).cast("int")
        half = (F.concat(F.lit("h"), F.substring("word", F.lit(1), head)) if from_start
                else F.concat(F.lit("t"), F.substring("word", length - (base - head) + 1, base - head)))
        return F.struct(base.alias("base"), half.alias("half"), F.lit(side).alias("side"))

    members = F.array(*[member(side, start) for side in (0, 1) for start in (True, False)])
    return (words.select("word", "n", F.explode(members).alias("m")).select("m.*", "word", "n")
            .where(F.col("base") >= min_length))


def units(members: DataFrame, tile: int = TILE) -> DataFrame:
    """(base, half, i, j, part, side, word, n): blocks, the large ones as pairs of tiles i <= j.

    Blocks without a pair are left out.
    """
    sizes = (members.groupBy("base", "half").agg(F.count("*").alias("size"), F.min("side").alias("least"))
             .where("size > 1 and least = 0"))
    held = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_CHARS) / (F.col("base") + 1))))
    sizes = sizes.select("base", "half", F.ceil(F.col("size") / held).cast("int").alias("tiles"))
    placed = members.join(sizes, ["base", "half"]).withColumn("own", F.expr("int(pmod(xxhash64(word), tiles))"))
    return (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("base", "half", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).cast("int").alias("part"), "side", "word", "n"))


def _letters(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words as a matrix (0 behind the end), and the counts of each letter."""
    words = words.astype("U")
    codes = words.view(np.uint32).reshape(len(words), -1)
    at = np.where(codes == 0, _LETTERS, _LETTER_OF[codes & 0xFF]) + (_LETTERS + 1) * np.arange(len(words))[:, None]
    counts = np.bincount(at.ravel(), minlength=len(words) * (_LETTERS + 1)).reshape(len(words), -1)
    return codes, counts[:, :_LETTERS].astype(np.float32)


def _gram_candidates(counts: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): rows ``a`` of ``base`` and all rows ``b`` whose letter counts are at a squared distance of 2 at most."""
    squares = (counts * counts).sum(1)
    distance = squares[base, None] + squares[None, :] - 2 * (counts[base] @ counts.T)
    a, b = np.nonzero(distance <= 2)
    return base[a], b


def _one_edit(codes: np.ndarray, a: np.ndarray, b: np.ndarray, base: np.ndarray, longer: np.ndarray,
              from_start: np.ndarray) -> np.ndarray:
    """Whether word b is word a with one letter replaced, or inserted where ``longer``.

    Pairs that share their first halves are left to the block of first halves.
    """
    x, y = codes[a], codes[b]
    width = x.shape[1]
    inside = np.arange(width) < base[:, None]
    same = (x == y) | ~inside
    prefix = np.minimum(np.logical_and.accumulate(same, axis=1).sum(1), base)  # equal letters from the start
    shifted = np.ones_like(same)
    shifted[:, :-1] = x[:, :-1] == y[:, 1:]
    shifted |= ~inside
    suffix = np.logical_and.accumulate(shifted[:, ::-1], axis=1).sum(1) - (width - base)  # and to the end of both
    near = np.where(longer, prefix + suffix >= base, (~same).sum(1) == 1)
    return near & (from_start | (prefix < base // 2))


def _near_in(pack: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, best_n, best) over the near pairs inside the units of ``pack``."""
    words, n = pack["word"].to_numpy(), pack["n"].to_numpy(np.int64)
    side, unit = pack["side"].to_numpy(), pack["unit"].to_numpy()
    base, part = pack["base"].to_numpy(np.int64), pack["part"].to_numpy()
    whole, from_start = pack["whole"].to_numpy(bool), pack["from_start"].to_numpy(bool)
    codes, counts = _letters(words)
    a, b = _gram_candidates(counts, np.flatnonzero(side == 0))
    keep = ((unit[a] == unit[b]) & (whole[a] | (part[a] != part[b]))
            & ((side[b] == 1) | (a < b)))  # pairs of one length once
    a, b = a[keep], b[keep]
    step = max(1, (1 << 22) // codes.shape[1])
    near = [_one_edit(codes, a[k: k + step], b[k: k + step], base[a[k: k + step]], side[b[k: k + step]] == 1,
                      from_start[a[k: k + step]]) for k in range(0, len(a), step)]
    hit = np.concatenate(near) if near else np.empty(0, bool)
    a, b = a[hit], b[hit]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    place = np.empty(len(words), np.int64)
    place[np.argsort(words.astype("U"), kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[target], -n[target], source))
    source, target = source[order], target[order]
    at, first, n_near = np.unique(source, return_index=True, return_counts=True)
    best = target[first]
    return pd.DataFrame({"word": words[at], "n_near": n_near.astype(np.int64), "best_n": n[best], "best": words[best]})


def _packs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Whole units of ``rows`` (in order), small ones of like length together."""
    unit = rows["unit"].to_numpy()
    starts = np.flatnonzero(np.diff(unit, prepend=unit[0] - 1)) if len(unit) else np.empty(0, int)
    base = rows["base"].to_numpy()
    begin = 0
    for k, start in enumerate(starts):
        end = starts[k + 1] if k + 1 < len(starts) else len(unit)
        if start > begin and (end - begin > PACK or (end - begin) * base[start] > TILE_CHARS or base[start] > base[begin] + 4):
            yield rows.iloc[begin:start]
            begin = start
    if begin < len(unit):
        yield rows.iloc[begin:]


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): for words with near words, their count, and the most frequent of them."""
    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for part in parts:
            rows = part if rest is None else pd.concat([rest, part], ignore_index=True)
            keys = rows[["base", "half", "i", "j"]]
            rows["unit"] = (keys != keys.shift()).any(axis=1).cumsum()
            rows["whole"], rows["from_start"] = rows["i"] == rows["j"], rows["half"].str.startswith("h")
            last = rows["unit"] == rows["unit"].iloc[-1]
            rest = rows.loc[last, part.columns]
            for pack in _packs(rows.loc[~last]):
                yield _near_in(pack)
        if rest is not None:
            yield _near_in(rest.assign(unit=1, whole=rest["i"] == rest["j"],
                                       from_start=rest["half"].str.startswith("h")))

    key = ["base", "half", "i", "j"]
    # by length first, so that small units of one length share a product
    rows = units(blocks(words, min_length), tile).repartition(*key).sortWithinPartitions(*key)
    partial = rows.mapInPandas(scan, "word string, n_near long, best_n long, best string")
    return (partial.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                        F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: the last of the chain of forms."""
    roots = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(roots.join(ahead, "root", "left"))
        roots = stepped.select("word", F.coalesce("next", "root").alias("root"))
        if stepped.where(F.col("next").isNotNull()).isEmpty():
            return roots


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the corpus."""
    words = materialize(count_words(docs, id_col, text_col, min_length, min_count))
    near = near_words(words, min_length)
    has_form = F.col("best_n") >= ratio * F.col("n")
    judged = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")))
    roots = last_forms(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
