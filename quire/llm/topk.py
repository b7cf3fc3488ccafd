"""Exact top-k search by inner product on a bit-sliced index.

Vectors become integers floor(scale * x).  Candidates are cut into blocks; in
a block each component is stored as bit slices (bitmaps over the rows, after
a shift that makes the values non-negative).  For one query the slices,
weighted by the bits of its components, are added column by column with
carry-save adders on bitmaps; a negative component adds complemented slices.
The sum's slices are walked from the most significant one downward to find the
top rows, and rows tied at the boundary are resolved by identifier.

Queries are dealt to blocks in chunks, so a task holds one block and one chunk
and each block answers with its own k best; a last window keeps k per query.

Edge cases: null vectors and vectors with null or non-finite components take
no part; vectors of different lengths are not compared; vectors without
components score 0; values beyond +-2**62 after scaling count as that, and a
score beyond 64 bits is returned as the nearest that has them (its rank is
exact); null identifiers take no part; rows of the query's own identifier are
no candidates of it, and all rows that repeat an identifier are candidates of
others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates in a block and queries in a chunk.
BLOCK_ROWS, CHUNK_ROWS = 65_536, 512
LIMIT = 2 ** 62
_LONG = 2 ** 63


class BitSlicedBlock:
    """Bit slices of a block's components; rows must be in identifier order."""

    def __init__(self, values: np.ndarray):
        self.rows, dims = values.shape
        self.low = int(values.min()) if values.size else 0
        shifted = values.astype(np.uint64) - np.array(self.low, np.int64).astype(np.uint64)  # modulo 2**64, so no overflow
        self.bits = int(shifted.max()).bit_length() if values.size else 0
        words = -(-self.rows // 64) * 64
        padded = np.zeros((dims, words), np.uint64)
        padded[:, :self.rows] = shifted.T
        # slices[dim][bit] is a bitmap of 64-bit words
        self.slices = [[np.packbits((padded[d] >> np.uint64(b)).astype(np.uint8) & 1, bitorder="little").view(np.uint64)
                        for b in range(self.bits)] for d in range(dims)]
        self.flipped = [[~s for s in dim] for dim in self.slices]
        self.every = np.packbits(np.arange(words) < self.rows, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The slices of (score - offset), least significant first, and offset."""
        full = (1 << self.bits) - 1
        offset, columns = 0, []
        for d, weight in enumerate(int(w) for w in query):
            offset += weight * self.low - (0 if weight >= 0 else -weight * full)
            source, weight = (self.slices[d], weight) if weight >= 0 else (self.flipped[d], -weight)
            shift = 0
            while weight:
                if weight & 1:
                    for b, bitmap in enumerate(source):
                        while len(columns) <= b + shift:
                            columns.append([])
                        columns[b + shift].append(bitmap)
                weight >>= 1
                shift += 1
        out = []
        k = 0
        while k < len(columns):  # three bitmaps of a column become a sum and a carry
            column = columns[k]
            if len(column) > 1 and k + 1 == len(columns):
                columns.append([])
            at = 0
            while len(column) - at >= 3:
                a, b, c = column[at:at + 3]
                at += 3
                half = a ^ b
                column.append(half ^ c)
                columns[k + 1].append((a & b) | (half & c))
            if len(column) - at == 2:
                a, b = column[at:]
                column.append(a ^ b)
                columns[k + 1].append(a & b)
            out.append(column[-1] if column else np.zeros_like(self.every))
            columns[k] = None
            k += 1
        return out, offset

    def top(self, query: np.ndarray, k: int, without: range = range(0)) -> list[tuple[int, int]]:
        """(row, score) of the k best rows, the rows ``without`` left out; ties
        go to the lower row.  Not in order."""
        slices, offset = self.scores(query)
        ties = self.every.copy()
        for row in without:
            ties[row // 64] &= ~np.uint64(1 << (row % 64))
        sure = np.zeros_like(ties)
        n_sure = 0
        for bitmap in reversed(slices):
            high = ties & bitmap
            n = n_sure + int(np.bitwise_count(high).sum())
            if n > k:
                ties = high
            else:
                sure |= high
                n_sure = n
                ties = ties & ~bitmap
                if n == k:
                    break
        rows = _rows(sure)
        if len(rows) < k:
            rows = np.concatenate([rows, _rows(ties)[:k - len(rows)]])
        words, shifts = rows // 64, (rows % 64).astype(np.uint64)
        kind = np.int64 if len(slices) < 62 and abs(offset) < 2 ** 62 else object  # Python's integers have no bound
        score = np.zeros(len(rows), kind)
        for b, bitmap in enumerate(slices):
            score += ((bitmap[words] >> shifts) & np.uint64(1)).astype(np.int64).astype(kind) * (1 << b)
        return list(zip(rows.tolist(), (score + offset).tolist(), strict=True))


def _rows(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    if not len(words):
        return words
    bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(len(words), 64)
    word, bit = np.nonzero(bits)
    return words[word] * 64 + bit


def _search(k: int):
    def run(key, candidates, queries):
        # a score's upper and lower 64 bits, both as signed numbers that keep its order
        out = {"query_id": [], "vec_id": [], "score": [], "top": [], "rest": []}
        if candidates.num_rows and queries.num_rows:
            dims = candidates.column("dims")[0].as_py()
            ids, vectors = _rows_by_id(candidates, dims)
            block = BitSlicedBlock(vectors)
            for query_id, query in zip(*_rows_by_id(queries, dims), strict=True):
                own = range(int(np.searchsorted(ids, query_id)), int(np.searchsorted(ids, query_id, "right")))
                best = block.top(query, k, own)
                out["query_id"] += [int(query_id)] * len(best)
                out["vec_id"] += [int(ids[row]) for row, _ in best]
                out["score"] += [min(max(score, -_LONG), _LONG - 1) for _, score in best]
                out["top"] += [min(max(score >> 64, -_LONG), _LONG - 1) for _, score in best]
                out["rest"] += [(score & (2 ** 64 - 1)) - _LONG for _, score in best]
        return pa.table({name: pa.array(x, pa.int64()) for name, x in out.items()})
    return run


def _rows_by_id(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers in order and their vectors, rows that repeat one in the order of their bytes."""
    rows = sorted(zip(table.column("id").to_pylist(), table.column("packed").to_pylist(), strict=True))
    packed = b"".join(p for _, p in rows)
    return np.array([k for k, _ in rows], np.int64), np.frombuffer(packed, "<i8").reshape(len(rows), dims)


def _pack(batches):
    for batch in batches:
        vectors = batch.column("vector")
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<i8")
        ends = np.cumsum(np.asarray(batch.column("dims").to_numpy(zero_copy_only=False), np.int64))
        packed = [flat[e - d:e].tobytes() for e, d in zip(ends, batch.column("dims").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dims"), pa.array(packed, pa.binary())],
                                         names=["id", "dims", "packed"])


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id``, ``dims`` and the quantised components, packed, of the rows that
    take part."""
    def whole(x):
        value = F.lit(float(scale)) * x.cast("double")
        return F.when(value >= LIMIT, F.lit(LIMIT)).when(value <= -LIMIT, F.lit(-LIMIT)).otherwise(F.floor(value))

    ints = F.transform(vector_col, whole)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dims"),
                    ints.alias("vector"))
            .mapInArrow(_pack, "id bigint, dims int, packed binary"))


def top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best
    candidates of every row for which ``is_query(id column)`` holds."""
    rows = quantised(vectors, id_col, vector_col, scale)
    queries = rows.filter(is_query(F.col("id")))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query(F.col("id")), 1)).alias("q")).first()
    blocks, chunks = max(1, -(-count["n"] // block_rows)), max(1, -(-count["q"] // chunk_rows))

    def deal(n):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    left = rows.withColumns({"block": deal(blocks), "chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))})
    right = queries.withColumns({"chunk": deal(chunks), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    found = (left.groupBy("dims", "block", "chunk").cogroup(right.groupBy("dims", "block", "chunk"))
             .applyInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint, top bigint, rest bigint"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("top"), F.desc("rest"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
