"""Ids of a word-level BPE file of the ``tokenizers`` library, a portion of
texts at a time.

A portion's bytes are cut at ASCII white space; Arrow's dictionary encoding
finds the distinct chunks, numpy cuts those of ASCII and common Latin letters
into words (letters, single digits, runs of other signs) and the distinct words
meet a store of known ones, so a string is looked at once per portion and not
once per occurrence.  Unknown words go through the ranked merges together.
Chunks that need more of Unicode or hold an apostrophe are cut one by one or go
to the library itself.  Ids are put together by gathering.

The file's added tokens stand for themselves wherever a text spells them out,
as the library has it.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from quire.llm.bpe import MergeFold

#: Words that are remembered; the store starts anew beyond.
CAPACITY = 300_000
#: Bytes of a portion.
PORTION = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 1: letters (and all bytes of longer characters), 2: digits, 3: other signs.
_KIND = np.full(256, 3, np.int8)
_KIND[48:58] = 2
_KIND[97:123] = 1
_KIND[65:91] = 1
_KIND[128:] = 1
#: Bytes that keep a chunk from being cut by numpy: controls, the apostrophe and all that begin other than C3.
_HARD = np.zeros(256, bool)
_HARD[:33] = True
_HARD[127] = True
_HARD[39] = True
_HARD[0xC0:] = True
_HARD[0xC3] = False


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[starts[0]:starts[0] + lengths[0]]`` and so on, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array's values, joined, and their bounds."""
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[bounds[0]:bounds[-1]], bounds - bounds[0]


class WordIds:
    """Texts to packed ids (little-endian unsigned 32-bit)."""

    plain = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
    words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")

    def __init__(self, path: str, capacity: int = CAPACITY):
        from tokenizers import Tokenizer

        self.library, self.capacity = Tokenizer.from_file(path), capacity
        added = {token.content: k for k, token in self.library.get_added_tokens_decoder().items()}
        self.added = {text: np.array([k], "<u4").tobytes() for text, k in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte alphabet of byte-level BPE
        shown = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in printable)}
        self.inner = np.array([vocab[shown[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[shown[b] + model["end_of_word_suffix"]] for b in range(256)], np.int32)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.fold = MergeFold((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)
        self._empty()

    def _empty(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.bounds = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _symbols(self, raw: np.ndarray) -> np.ndarray:
        ids = self.inner[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        return ids

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The store's numbers of ``words``; unknown ones are learned."""
        if len(self.number) > self.capacity:
            self._empty()
        known = self.number
        new = list(dict.fromkeys(w for w in words if w not in known))
        if new:
            packed = self.fold.fold(new, self._symbols)
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(packed), "<u4")])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        return np.array([known[w] for w in words], np.int64)

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, joined, and their number for each word."""
        coded = words.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lengths = self.bounds[numbers + 1] - self.bounds[numbers]
        return gather(self.flat, self.bounds[numbers], lengths), lengths

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct chunks: all joined, and each one's start and length."""
        data, bounds = _bytes(chunks)
        hard = np.add.reduceat(_HARD[data].astype(np.int64), bounds[:-1]) > 0
        # of C3's characters all are letters but the signs of multiplication and division
        signs = np.flatnonzero((data[1:] == 0x97) | (data[1:] == 0xB7)) + 1
        signs = signs[data[signs - 1] == 0xC3]
        hard[np.searchsorted(bounds, signs, side="right") - 1] = True
        lowered = _LOWER[data]
        capital = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        capital = capital[data[capital - 1] == 0xC3]
        lowered[capital] += 0x20
        # words of all chunks; those of hard ones are left out below
        kind = _KIND[data]
        begins = np.ones(len(data), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begins[bounds[:-1]] = True
        owner = np.repeat(np.arange(len(chunks)), np.diff(bounds))
        keep = ~hard[owner]
        at = np.flatnonzero(begins & keep)
        lowered, owners = lowered[keep], owner[at]
        place = (np.cumsum(keep) - 1)[at]
        ids, sizes = self._word_ids(_strings(lowered, np.diff(np.append(place, len(lowered))))) if len(at) else (np.empty(0, np.uint32), np.empty(0, np.int64))
        lengths = np.bincount(owners, weights=sizes, minlength=len(chunks)).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        odd, total = [ids], len(ids)
        for k in np.flatnonzero(hard).tolist():
            packed = self._hard(chunks[k].as_py())
            odd.append(packed)
            starts[k], lengths[k] = total, len(packed)
            total += len(packed)
        return np.concatenate(odd), starts, lengths

    def _hard(self, raw: bytes) -> np.ndarray:
        chunk = raw.decode()
        if self.plain.fullmatch(chunk):
            return self._word_ids(pa.array([w.encode() for w in self.words.findall(chunk.lower())], pa.large_binary()))[0]
        return np.array(self.library.encode(chunk, add_special_tokens=False).ids, np.uint32)

    def _portion(self, texts: list[bytes]) -> list[bytes]:
        ends = np.cumsum([len(t) + 1 for t in texts])
        buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        inside = ~_SPACE[buffer]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        begin, end = edge[::2], edge[1::2]
        if not len(begin):
            return [b""] * len(texts)
        coded = _strings(buffer[inside], end - begin).dictionary_encode()
        flat, starts, lengths = self._chunk_ids(coded.dictionary)
        index = coded.indices.to_numpy()
        raw = gather(flat, starts[index], lengths[index]).astype("<u4").tobytes()
        # ids up to the last chunk that begins before a text's end
        before = np.concatenate([[0], np.cumsum(lengths[index])])
        bounds = np.concatenate([[0], before[np.searchsorted(begin, ends)]]) * 4
        return [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        plain, parts = [], []  # parts of a text: added tokens' ids, or numbers of ``plain``
        for text in texts:
            text = text or ""
            if self.cut is not None and "<" in text and self.cut.search(text):
                own = []
                for piece in self.cut.split(text):
                    if piece in self.added:
                        own.append(self.added[piece])
                    elif piece:
                        own.append(len(plain))
                        plain.append(piece.encode())
                parts.append(own)
            else:
                parts.append(len(plain))
                plain.append(text.encode())
        ids: list[bytes] = []
        run, size = [], 0
        for raw in plain:
            run.append(raw)
            size += len(raw) + 1
            if size >= PORTION:
                ids += self._portion(run)
                run, size = [], 0
        if run:
            ids += self._portion(run)
        return [ids[p] if isinstance(p, int) else b"".join([x if isinstance(x, bytes) else ids[x] for x in p]) for p in parts]
