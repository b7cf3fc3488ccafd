"""Packing of token sequences by Karmarkar-Karp multiway differencing.

One pass over the scan's partitions, no shuffle: texts are tokenised, pieces of
full windows leave at once and the rest gathers in a pool.  When the pool holds
``WINDOWS`` windows of tokens (the last text is cut there), differencing deals
it into near-equal windows: of the two partial partitions with the largest
imbalance the fullest windows of one meet the emptiest of the other.  Where
texts may be cut, what a window holds beyond the capacity is cut off and fills
windows that fall short; where they may not, the window count rises until
differencing exceeds the capacity nowhere.  What a partition has left at its
end is dealt the same way, its odd rest cut into windows of powers of two,
which need no padding.

Sequence ids hold the input partition's number, so a task that runs again
gives the same rows.  That holds for inputs read from files; write the output
of a shuffle first (the order of its rows may change when a task runs again).

Edge cases: a null or empty text is its end token; texts of any length are cut;
null identifiers and repeated rows are packed each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe import in_portions
from quire.llm.common import tidy
from quire.llm.word_ids import WordIds

CAPACITY = 2048
#: Windows that one differencing fills.
WINDOWS = 64
END_ID = 1


def karmarkar_karp(sizes: list[int], windows: int) -> list[list[int]]:
    """Positions of ``sizes`` in each of ``windows`` parts with near-equal sums.

    A partial partition is its non-empty parts, (sum, positions), largest
    first; the others up to ``windows`` are zeros at its end."""
    heap = [(-size, k, [(size, [k])]) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, name, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        meet = len(a) + len(b) - windows
        if meet > 0:  # the smallest of one and the largest of the other, crosswise
            free = len(a) - meet
            both = [(a[free + i][0] + b[-1 - i][0], a[free + i][1] + b[-1 - i][1]) for i in range(meet)]
            merged = a[:free] + both + b[:len(b) - meet]
        else:
            merged = a + b
        merged.sort(key=lambda part: -part[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], name, merged))
    parts = [positions for _, positions in heap[0][2]] if heap else []
    return parts


def near_equal_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest windows that differencing fills without exceeding ``capacity``."""
    count = max(1, -(-sum(sizes) // capacity)) if sizes else 0
    while count:
        parts = karmarkar_karp(sizes, count)
        if all(sum(sizes[k] for k in part) <= capacity for part in parts):
            return parts
        count += 1
    return []


_VOCABULARIES: dict[str, WordIds] = {}


def _vocabulary(path: str) -> WordIds:
    """One per worker and file."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = WordIds(path)
    return _VOCABULARIES[path]


class Packer:
    """The rows of one input partition; a pool of at most ``windows`` windows."""

    def __init__(self, partition: int, capacity: int, windows: int, cut: bool = True):
        self.capacity, self.windows, self.cut = capacity, windows, cut
        self.next_id = partition << 32
        self.pool: list[tuple] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.rows.append((key, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def add(self, key, ids: bytes) -> None:
        total, full = len(ids) // 4, self.capacity * 4
        at = 0
        while len(ids) - at >= full:
            self._emit([(key, at // 4, ids[at:at + full], total)])
            at += full
        while at < len(ids):
            space = self.windows * self.capacity - self.tokens
            if not self.cut and len(ids) - at > 4 * space:
                self._deal()
                continue
            piece = ids[at:at + 4 * space]
            self.pool.append((key, at // 4, piece, total))
            self.tokens += len(piece) // 4
            at += len(piece)
            if self.tokens == self.windows * self.capacity:
                self._deal()

    def _deal(self) -> None:
        sizes = [len(piece[2]) // 4 for piece in self.pool]
        if self.cut:
            parts = karmarkar_karp(sizes, -(-self.tokens // self.capacity))
            windows = self._level([[self.pool[k] for k in part] for part in parts])
        else:
            windows = [[self.pool[k] for k in part] for part in near_equal_windows(sizes, self.capacity)]
        for window in windows:
            self._emit(window)
        self.pool, self.tokens = [], 0

    def _level(self, windows: list[list[tuple]]) -> list[list[tuple]]:
        """The windows with what exceeds the capacity moved to those that fall short."""
        over: list[tuple] = []
        for window in windows:
            excess = sum(len(piece[2]) // 4 for piece in window) - self.capacity
            if excess > 0:
                over += _cut_off(window, excess)
        for window in windows:
            lack = self.capacity - sum(len(piece[2]) // 4 for piece in window)
            if lack > 0 and over:
                window += _cut_off(over, lack)
        return windows

    def finish(self) -> None:
        """Whole windows of the pool, then its rest as powers of two."""
        if not self.cut:
            return self._deal()
        rest = self.tokens % self.capacity
        tail = _cut_off(self.pool, rest)
        self.tokens -= rest
        if self.pool:
            self._deal()
        while rest:
            size = 1 << (rest.bit_length() - 1)
            self._emit(_cut_off(tail, size))
            rest -= size
        self.pool, self.tokens = [], 0


def _cut_off(pieces: list[tuple], tokens: int) -> list[tuple]:
    """Take ``tokens`` tokens (or all there are) off the end of ``pieces``."""
    taken = []
    while tokens and pieces:
        key, start, ids, total = pieces.pop()
        n = min(tokens, len(ids) // 4)
        if n < len(ids) // 4:
            pieces.append((key, start, ids[:len(ids) - 4 * n], total))
            start, ids = start + len(ids) // 4 - n, ids[len(ids) - 4 * n:]
        taken.append((key, start, ids, total))
        tokens -= n
    return taken


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         windows: int = WINDOWS, cut: bool = True, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``<id_col>``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset``."""
    kind = dict(docs.dtypes)[id_col]
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, packer, id_type = _vocabulary(path), Packer(TaskContext.get().partitionId(), capacity, windows, cut), None

        def out():
            columns = list(zip(*packer.rows, strict=True))
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                              names=names)

        for batch in batches:
            id_type = batch.column("id").type
            keys = iter(batch.column("id").to_pylist())
            for texts in in_portions(batch.column("text").to_pylist()):
                for ids in vocabulary.encode(texts):
                    packer.add(next(keys), ids + end)
                if packer.rows:
                    yield out()
        packer.finish()
        if packer.rows:
            yield out()

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(tidy(run), f"id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])).withColumnRenamed("id", id_col))
