"""Ranked merges over distinct words, for many words at once.

``MergeFold`` folds the merges of a vocabulary over arrays of symbols: in each
round every word merges its best-ranked pair (the leftmost of equals), so
numpy does a round for thousands of words together.  ``WordEncoder`` keeps
what it encoded under a bound and encodes every distinct word of a batch once.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable

import numpy as np

NONE = np.iinfo(np.int32).max
#: Symbols under this number get a dense table of pairs.
DENSE = 512
#: Words of more symbols are folded one by one through a heap.
LONG = 48


class MergeFold:
    """``pairs``: (left, right, merged) symbols in the order of their rank."""

    def __init__(self, pairs: Iterable[tuple[int, int, int]]):
        table = np.array(list(pairs), np.int64).reshape(-1, 3)
        keys = (table[:, 0] << 32) | table[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int32)
        self.merged = table[:, 2].astype(np.int32)
        self.dense = np.full((DENSE, DENSE), NONE, np.int32)
        low = (table[:, 0] < DENSE) & (table[:, 1] < DENSE)
        self.dense[table[low, 0], table[low, 1]] = np.flatnonzero(low)
        self.one: dict[int, int] | None = None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.rank_of[at], NONE) if len(self.keys) else np.full(len(wanted), NONE, np.int32)

    def fold(self, words: list[bytes], first: Callable[[np.ndarray], np.ndarray]) -> list[bytes]:
        """The packed symbols of each word when no pair can be merged any more.
        ``first`` turns rows of bytes into rows of symbols."""
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_length.setdefault(len(word), []).append(k)
        for length, rows in by_length.items():
            raw = np.frombuffer(b"".join([words[k] for k in rows]), np.uint8).reshape(len(rows), length)
            symbols = first(raw)
            if length > LONG:
                for k, word in zip(rows, symbols, strict=True):
                    out[k] = self.fold_long(word).tobytes()
            elif length:
                self._fold_equal(np.array(rows), symbols, out)
        return out

    @staticmethod
    def _done(rows: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        raw, width = symbols.astype("<u4").tobytes(), 4 * symbols.shape[1]
        for i, k in enumerate(rows.tolist()):
            out[k] = raw[i * width:(i + 1) * width]

    def _fold_equal(self, rows: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        """Words of one length; every round makes all that go on one shorter."""
        ranks = self.dense[symbols[:, :-1], symbols[:, 1:]]
        while symbols.shape[1] > 1:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            going = best < NONE
            if not going.all():
                self._done(rows[~going], symbols[~going], out)
                rows, symbols, ranks, at, best = rows[going], symbols[going], ranks[going], at[going], best[going]
            if not len(rows):
                return
            n, width = symbols.shape
            line = np.arange(n)
            symbols[line, at] = self.merged[best]
            keep = np.ones((n, width), bool)
            keep[line, at + 1] = False
            symbols = symbols[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(n, width - 2)
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.ranks(symbols[has, at[has] - 1], symbols[has, at[has]])
            has = np.flatnonzero(at < width - 2)
            ranks[has, at[has]] = self.ranks(symbols[has, at[has]], symbols[has, at[has] + 1])
        self._done(rows, symbols, out)

    def fold_long(self, word: np.ndarray) -> np.ndarray:
        """One word of any length, in time n log n."""
        if self.one is None:
            self.one = dict(zip(self.keys.tolist(), self.rank_of.tolist(), strict=True))
        symbols = word.tolist()
        after = list(range(1, len(symbols))) + [-1]
        before = list(range(-1, len(symbols) - 1))
        get, heap = self.one.get, []
        for i in range(len(symbols) - 1):
            if (rank := get(symbols[i] << 32 | symbols[i + 1])) is not None:
                heap.append((rank, i, symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # one of the two was merged meanwhile
            symbols[i], symbols[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (rank := get(symbols[a] << 32 | symbols[b])) is not None:
                    heapq.heappush(heap, (rank, a, symbols[a], symbols[b]))
        return np.array([s for s in symbols if s >= 0], "<u4")


class WordEncoder:
    """Texts to ids, packed as little-endian unsigned 32-bit integers.

    ``chunks`` cuts a text into strings whose ids don't depend on their
    neighbours, ``pieces`` cuts a chunk into words and ``first`` turns their
    bytes into symbols.  ``whole`` has words that are ids as they are, ``odd``
    encodes a chunk for which ``pieces`` gives None.  About ``capacity``
    chunks and as many words are remembered."""

    def __init__(self, fold: MergeFold, chunks: Callable[[str], list[str]], pieces: Callable[[str], list[str] | None],
                 first: Callable[[np.ndarray], np.ndarray], whole: dict[bytes, bytes] | None = None,
                 odd: Callable[[str], bytes] | None = None, capacity: int = 200_000):
        self.fold, self.chunks, self.pieces, self.first = fold, chunks, pieces, first
        self.whole, self.odd, self.capacity = whole or {}, odd, capacity
        self.of_chunk: dict[str, bytes] = {}
        self.of_word: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks(t) for t in texts]
        if len(self.of_chunk) > self.capacity:
            self.of_chunk = {}
        if len(self.of_word) > self.capacity:
            self.of_word = {}
        known = self.of_chunk
        if new := {c for chunks in cut for c in chunks if c not in known}:
            self._learn(new)
        get = known.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def _learn(self, chunks: set[str]) -> None:
        known, split, new = self.of_word, [], set()
        for chunk in chunks:
            words = self.pieces(chunk)
            if words is None:
                self.of_chunk[chunk] = self.odd(chunk)
            else:
                split.append((chunk, words))
                for word in words:
                    if word not in known:
                        new.add(word)
        folded = []
        for word in new:
            raw = word.encode()
            if raw in self.whole:
                known[word] = self.whole[raw]
            else:
                folded.append((word, raw))
        for (word, _), ids in zip(folded, self.fold.fold([raw for _, raw in folded], self.first), strict=True):
            known[word] = ids
        for chunk, words in split:
            self.of_chunk[chunk] = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])


def in_portions(texts: list[str | None], chars: int = 2_000_000) -> Iterable[list[str]]:
    """Runs of texts of about ``chars`` characters, at least one text each."""
    run, n = [], 0
    for text in texts:
        run.append(text or "")
        n += len(run[-1])
        if n >= chars:
            yield run
            run, n = [], 0
    if run:
        yield run
