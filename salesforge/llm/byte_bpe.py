"""Byte-level BPE encoding and decoding by the ranks of a tiktoken file.

A text is split by the tokenizer's pattern; every match is merged separately.  The merges of a word are a fold over its
bytes: each step joins the leftmost adjacent pair of lowest rank and renews the two ranks beside it.  A task takes its
texts in chunks, numbers their distinct words and folds all new ones together as rows of a matrix (``word_merges``); the ids
are then put in the places of the numbers.  A word is folded once as long as the task's bounded table holds it.  Nothing is
shuffled, collected or broadcast, so no disk is taken beside the result.  Decoding concatenates the bytes of the ids.

Defined results
* null text: as the empty text: no ids.  Special tokens in a text are ordinary text.
* a match that is longer than the widest matrix is merged by ``merge_long`` with a heap: the fold is quadratic in the
  word's length.
* repeated rows and repeated or null ids: every row is encoded by itself; extra columns are not read.
* very long texts: encoded whole; a task holds the words of one chunk, which is one text if that is longer.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty, word_pattern
from .word_merges import RankedPairs, WordIds, chunks_of

RANKS = "byte_bpe_multi_50k.tiktoken"


@lru_cache(2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(1)
def splitter() -> Callable[[str], list[str]]:
    import regex

    latin, beyond = word_pattern(public_tokenizers.PATTERN)
    full = regex.compile(public_tokenizers.PATTERN)
    return lambda text: (full if beyond.search(text) else latin).findall(text)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap and linked neighbours, for words that are too long for the fold."""
    n = len(word)
    start, after, before = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(word[start[i]: end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[start[i]: end[i]]] for i in range(n) if alive[i]]


@lru_cache(1)
def ranked_pairs(path: str) -> RankedPairs:
    """Every way to cut a token into two tokens, with the token's rank."""
    ranks = read_ranks(path)
    cuts = [(left, right, rank) for token, rank in ranks.items() for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None]
    left, right, rank = np.array(cuts, np.int64).reshape(-1, 3).T
    return RankedPairs([ranks[bytes([b])] for b in range(256)], left, right, rank, np.arange(max(ranks.values()) + 1))


def word_ids(path: str) -> WordIds:
    """An empty table of words for the ranks of a file.  A match that is a token itself has that id."""
    ranks = read_ranks(path)
    return WordIds(ranked_pairs(path), lambda word: merge_long(word, ranks), ranks)


def _encoded(parts: Iterator[pd.DataFrame], path: str) -> Iterator[tuple[pd.Series, list[bytes]]]:
    """(doc_ids, ids) of the texts of a task, chunk by chunk."""
    split, words = splitter(), word_ids(path)
    for part in parts:
        for begin, end in chunks_of(part["text"]):
            yield part["doc_id"].iloc[begin:end], words.encode([split(t) for t in part["text"].iloc[begin:end]])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       text_or_empty(F.col(f"`{text_col}`")).alias("text"))


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, as little-endian unsigned 32-bit integers."""
    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own, ids in _encoded(parts, path or public_tokenizers.path(RANKS)):
            yield pd.DataFrame({"doc_id": own.astype("Int64").array, "ids": ids})

    return materialize(_texts(docs, id_col, text_col).mapInPandas(encode, "doc_id long, ids binary"))


def decode(ids: bytes, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids alone."""
    def digest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = read_ranks(path or public_tokenizers.path(RANKS))
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        for own, ids in _encoded(parts, path or public_tokenizers.path(RANKS)):
            yield pd.DataFrame({
                "doc_id": own.astype("Int64").array,
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(decode(i, pieces)).hexdigest() for i in ids]})

    return materialize(_texts(docs, id_col, text_col).mapInPandas(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
