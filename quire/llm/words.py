"""Words of whole batches as numpy arrays: bounds and 64-bit hashes.

A text is its UTF-8 bytes with A-Z lowered; words are runs without the six
ASCII white-space bytes.  A word's hash is a polynomial in an odd multiplier
modulo 2**64, taken from running sums over the buffer and mixed at the end, so
it depends on the word alone.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII punctuation, for words stripped at the ends.
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << n.bit_length()
        for name, base in (("_POWERS", BASE), ("_INVERSES", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[:n], _INVERSES[:n]


class Words:
    """Bounds and hashes of the words of ``buffer`` (lowered bytes); with
    ``strip``, punctuation at their ends is left out."""

    def __init__(self, buffer: np.ndarray, strip: bool = False):
        space = _SPACE[buffer]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if strip and len(starts):
            plain = np.flatnonzero(~(_PUNCT | _SPACE)[buffer])
            first, last = np.searchsorted(plain, starts), np.searchsorted(plain, ends) - 1
            some = first <= last
            starts, ends = plain[first[some]], plain[last[some]] + 1
        powers, self.inverses = _powers(len(buffer) + 1)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.sums[1:])
        self.starts, self.ends = starts, ends

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """Of the words, or of other stretches of the buffer."""
        starts, ends = (self.starts if starts is None else starts), (self.ends if ends is None else ends)
        value = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def portions(texts: list[str | None], size: int = 1 << 20):
    """(first row, buffer, row starts) for runs of texts of about ``size``
    bytes, joined by a space; at least one text each."""
    at, run, n = 0, [], 0
    for k, text in enumerate(texts):
        raw = lowered(text)
        run.append(raw)
        n += len(raw) + 1
        if n >= size or k + 1 == len(texts):
            lengths = np.array([len(r) + 1 for r in run])
            yield at, np.frombuffer(b" ".join(run) + b" ", np.uint8), np.concatenate([[0], np.cumsum(lengths)])
            at, run, n = k + 1, [], 0
