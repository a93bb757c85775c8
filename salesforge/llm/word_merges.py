"""Ranked byte-pair merges of many words at once.

Words of similar length are rows of a matrix of ids.  Each step finds in every row the leftmost adjacent pair of lowest
rank, puts the joined id in its place and renews the two ranks beside it; rows without a ranked pair leave.  So the work
of a step is a few array operations over all words, and every distinct word of a ``WordIds`` table is merged once.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np

WIDTHS = [4, 6, 8, 10, 12, 16, 24, 32, 64]  # of the matrices, in bytes; longer words are merged one by one
CACHED_WORDS = 200_000  # the table begins anew when it has more at the start of a call
CHUNK_CHARS = 2_000_000  # of texts that are taken together
_NONE = 2**31 - 1  # the rank of a pair that is not merged


def chunks_of(texts: Iterable[str]) -> Iterator[tuple[int, int]]:
    """The places of adjacent texts that have about ``CHUNK_CHARS`` characters together."""
    begin = size = at = 0
    for at, text in enumerate(texts, 1):
        size += len(text)
        if size >= CHUNK_CHARS:
            yield begin, at
            begin, size = at, 0
    if begin < at:
        yield begin, at


class RankedPairs:
    """left, right, rank: which ids are joined; ``made``: the id that a rank makes; ``byte_ids``: those of the 256 bytes."""

    def __init__(self, byte_ids: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray):
        self.byte_ids, self.made = np.asarray(byte_ids, np.int32), np.asarray(made, np.int32)
        self.size = int(max(self.byte_ids.max(), self.made.max(initial=0))) + 1
        key = np.asarray(left, np.int64) * self.size + np.asarray(right, np.int64)
        order = np.argsort(key)
        self.key = np.append(key[order], -1)  # the last is never found
        self.rank = np.append(np.asarray(rank, np.int32)[order], _NONE).astype(np.int32)
        self.first = self.ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.key[:-1], key)
        return np.where(self.key[at] == key, self.rank[at], np.int32(_NONE))

    def merge(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of all words, each of at most ``width`` bytes, one after the other."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)
        ids = self.byte_ids[chars]
        near = self.first[chars[:, :-1], chars[:, 1:]]
        near[np.arange(1, width) >= n[:, None]] = _NONE
        out, sizes, row = np.zeros((len(words), width), np.int32), n.copy(), np.arange(len(words))
        while len(row):
            p = near.argmin(axis=1) if near.shape[1] else np.zeros(len(row), np.int64)
            low = near[np.arange(len(row)), p] if near.shape[1] else np.full(len(row), _NONE)
            going = low != _NONE
            if not going.all():
                done = ~going
                out[row[done], : ids.shape[1]] = ids[done]
                row, ids, near, p, low = row[going], ids[going], near[going], p[going], low[going]
                if not len(row):
                    break
            sizes[row] -= 1
            every, wide = np.arange(len(row)), ids.shape[1]
            joined = self.made[low]
            ids = ids[np.arange(wide) != p[:, None] + 1].reshape(len(row), wide - 1)
            ids[every, p] = joined
            near = near[np.arange(wide - 1) != p[:, None]].reshape(len(row), wide - 2)
            # a pair with padding stays unranked: its left place is the word's last
            last = sizes[row] - 1
            k = np.flatnonzero(p > 0)
            near[k, p[k] - 1] = self.ranks(ids[k, p[k] - 1], joined[k])
            k = np.flatnonzero(p < last)
            near[k, p[k]] = self.ranks(joined[k], ids[k, p[k] + 1])
        return out[np.arange(width) < sizes[:, None]], sizes


class WordIds:
    """The ids of words, in a bounded table; ``whole``: ids of words that are looked up, ``long``: merges one long word."""

    def __init__(self, pairs: RankedPairs, long: Callable[[bytes], Iterable[int]], whole: dict[bytes, int] | None = None):
        self.pairs, self.long, self.whole = pairs, long, whole or {}
        self._begin()

    def _begin(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.flat, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its words, as little-endian unsigned 32-bit integers."""
        if len(self.numbers) > CACHED_WORDS:
            self._begin()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        numbers = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(texts)), np.int64,
                              int(lengths.sum()))
        flat, sizes = self._merged([w.encode() for w in itertools.islice(self.numbers, len(self.sizes), None)])
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        begins, reps = np.cumsum(self.sizes) - self.sizes, self.sizes[numbers]
        ends = np.cumsum(reps)
        full = self.flat[np.repeat(begins[numbers] - (ends - reps), reps) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        return [full[a:b].astype("<u4", copy=False).tobytes() for a, b in itertools.pairwise(cuts)]

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of all words, one after the other."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        whole = np.fromiter((self.whole.get(w, -1) for w in words), np.int64, len(words)) if self.whole else (
            np.full(len(words), -1))
        group = np.where(whole >= 0, -1, np.searchsorted(WIDTHS, n))
        sizes, parts, places = np.ones(len(words), np.int64), [whole[group == -1]], [np.flatnonzero(group == -1)]
        for k, width in enumerate(WIDTHS):
            at = np.flatnonzero(group == k)
            ids, sizes[at] = self.pairs.merge([words[i] for i in at.tolist()], width)
            parts.append(ids)
            places.append(at)
        for i in np.flatnonzero(group == len(WIDTHS)).tolist():
            parts.append(np.fromiter(self.long(words[i]), np.int64))
            sizes[i] = len(parts[-1])
            places.append(np.array([i]))
        # the parts are in the order of their groups: put each word's ids in its own place
        order = np.concatenate(places).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        reps = sizes[order]
        flat = np.empty(int(sizes.sum()), np.uint32)
        flat[np.repeat(begins[order] - (np.cumsum(reps) - reps), reps) + np.arange(len(flat))] = np.concatenate(parts)
        return flat, sizes
