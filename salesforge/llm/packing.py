"""Best-fit decreasing packing of tokenised documents into windows of a fixed length.

A document is its token ids and one closing id.  It is first cut into full windows, which need no packing; what remains
(at most one piece a document, shorter than a window) is packed.  The remainders are dealt evenly to groups of about
``PIECES_PER_GROUP`` by their row number, whatever their ids; each group is packed by itself in decreasing length.  A
segment tree over the remaining capacity finds the tightest open window.  Only lengths are shuffled, never ids.

Defined results
* null text: as the empty text, one piece that holds the closing id only.
* repeated rows and repeated or null ids: every row is packed as a document of its own.
* ties: equal lengths keep their order in the group; of equally tight windows the one that got its last piece latest.
* extra columns are not read; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty, word_pattern
from .word_merges import RankedPairs, WordIds, chunks_of

WINDOW = 1024
CLOSING_ID = 0
VOCABULARY = "byte_bpe_50k.json"
PIECES_PER_GROUP = 8192


def byte_characters() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte: itself where it is printable Latin-1, else the
    next one from 256 on."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in itself]
    return {b: chr(b) for b in itself} | {b: chr(256 + k) for k, b in enumerate(others)}


@lru_cache(1)
def _vocabulary(path: str) -> tuple[dict, RankedPairs, Callable[[bytes], list[int]]]:
    """(added tokens with their ids, the ranked merges, the model's ids of a word that is too long for them)."""
    import json
    import os

    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    tokens, model = content.get("added_tokens") or [], content["model"]
    if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    if any(model.get(flag) for flag in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError("the vocabulary is not one of plain merges")
    added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in tokens if t["content"]}
    ids, characters = model["vocab"], byte_characters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left, right, made = np.array([(ids[a], ids[b], ids[a + b]) for a, b in merges], np.int64).reshape(-1, 3).T
    pairs = RankedPairs([ids[characters[b]] for b in range(256)], left, right, np.arange(len(merges)), made)
    plain = Tokenizer.from_file(path).model

    def ids_of_word(word: bytes) -> list[int]:  # the model alone: a word is split already
        return [t.id for t in plain.tokenize(word.decode("latin-1").translate(characters))]

    return added, pairs, ids_of_word


def token_ids(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to the ids of each as little-endian unsigned 32-bit integers.

    The tokenizer works on each word of its own pattern separately: the distinct words are merged together.  Added tokens
    of the vocabulary that stand in a text are cut out first, the longest where several begin, as the tokenizer does.
    """
    import regex

    added, pairs, ids_of_word = _vocabulary(path)
    words = WordIds(pairs, ids_of_word)
    latin, beyond = word_pattern(public_tokenizers.PATTERN)
    full = regex.compile(public_tokenizers.PATTERN)
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def split(text: str) -> list[str]:
        return (full if beyond.search(text) else latin).findall(text)

    def encode(texts: list[str]) -> list[bytes]:
        if not any(t in text for text in texts for t in added):
            return words.encode([split(text) for text in texts])
        parts = [cut.split(text) for text in texts]
        plain = iter(words.encode([split(p) for own in parts for p in own if p not in added]))
        return [b"".join([added[p] if p in added else next(plain) for p in own]) for own in parts]

    return encode


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           vocabulary: str | None = None, closing_id: int = CLOSING_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document cut into full windows and a remainder."""
    closing = np.array([closing_id], "<u4").tobytes()

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = token_ids(vocabulary or public_tokenizers.path(VOCABULARY))
        for part in parts:
            rows, encoded = [], (ids for begin, end in chunks_of(part["text"])
                                 for ids in encode(part["text"].iloc[begin:end].tolist()))
            for doc, ids in zip(part["doc_id"], encoded, strict=True):
                ids += closing
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start: 4 * (start + window)]
                    rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), total, *([piece] if with_ids else [])))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       text_or_empty(F.col(f"`{text_col}`")).alias("text")).mapInPandas(cut, schema)


class CapacityTree:
    """A segment tree over remaining capacities 0 .. size - 1; each leaf holds the open windows with that capacity."""

    def __init__(self, size: int):
        self.base = 1 << (size - 1).bit_length()
        self.open = [0] * (2 * self.base)  # windows below each node
        self.at: list[list[int]] = [[] for _ in range(size)]

    def _add(self, capacity: int, n: int) -> None:
        node = self.base + capacity
        while node:
            self.open[node] += n
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.at[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The tightest window with capacity ``least`` or more, removed: (window, its capacity)."""
        if least >= len(self.at):
            return None
        node = self.base + least
        while not self.open[node]:  # up to the first right neighbour that has a window
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.base:  # down, leftmost
            node = 2 * node + (not self.open[2 * node])
        capacity = node - self.base
        self._add(capacity, -1)
        return self.at[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) of each piece."""
    tree, n = CapacityTree(window), 0
    to, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        found = tree.take(size)
        number, capacity = found or (n, window)
        n += found is None
        to[i], offset[i] = number, window - capacity
        tree.put(capacity - size, number)
    return to, offset


def pack(cut: DataFrame, window: int = WINDOW, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """The pieces with their sequence and offset.  Full windows have odd sequence ids, packed ones even."""
    cut = materialize(cut)
    full = cut.where(F.col("length") == window).withColumns(
        {"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("long")})
    rest = cut.where(F.col("length") < window)
    groups = max(1, math.ceil(rest.count() / per_group))

    def fill(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        to, offset = best_fit_decreasing(part["length"].to_numpy(), window)
        return part.drop(columns="group").assign(sequence_id=2 * ((int(key[0]) << 32) + to), offset=offset)

    # row numbers of a checkpoint are stable; they deal the rows evenly, also those of one id
    dealt = rest.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.groupBy("group").applyInPandas(fill, f"{schema}, sequence_id long, offset long").union(full)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    return pack(pieces(docs, id_col, text_col, **options), options.get("window", WINDOW))


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = CLOSING_ID) -> DataFrame:
    """(sequence_id, length, ids): the filled windows of ``pack_documents(..., with_ids=True)``.

    Sequences are padded to the window, except where their length is a power of two.
    """
    def join(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(part.sort_values("offset")["ids"]), "<u4").astype(np.int32)
        pad = 0 if len(ids) & (len(ids) - 1) == 0 else window - len(ids)
        return pd.DataFrame({"sequence_id": [key[0]], "length": [len(ids)],
                             "ids": [np.concatenate([ids, np.full(pad, pad_id, np.int32)])]})

    return packed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, length long, ids array<int>")
