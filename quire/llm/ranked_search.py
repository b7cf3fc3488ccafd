"""Ranked lexical search by dense blocked multiplication.

Items (the queries) go in blocks of bounded size.  Per block:

1. One pass over all documents counts the block's terms: exact string look-up
   of every word in the block's vocabulary.  Each document that has one leaves
   its length, term numbers and counts (written once, read again below); each
   partition leaves its sums of N, L and document frequencies.
2. The sums of the vocabulary give the weights; the document side's impacts
   (1000000000 tf) div (1000 tf + 12 m) fill a dense float64 tile of
   ``TILE_DOCS`` documents by a tile of the vocabulary, the item side's
   weights times repeats a tile of vocabulary by those items that use it, and
   BLAS multiplies the two.  A vocabulary tile ends at ``TILE_TERMS`` terms or
   where an item's partial sum could reach 2**53, so each product is exact in
   any order of addition; tiles are added in 64-bit integers.  An entry that
   alone could reach 2**53 is multiplied in integers.
3. Each partition keeps k documents per item, equal scores by identifier; two
   windows (buckets of documents, then the item) keep k of all.

Edge cases: a null or empty text has no terms and is no document of N; items
without terms give no rows; items that repeat both identifier and text count
once, other repeated identifiers are items of their own; repeated rows of
documents are ranked each; null document identifiers come last among equal
scores; an empty table on either side gives an empty result; extra columns are
ignored.  Document identifiers are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import staged
from quire.llm.words import portions

#: Items, and pairs of an item and a term, of a block (held by the driver and by every worker).
BLOCK_ITEMS, BLOCK_TERMS = 1024, 500_000
#: Sides of the dense tiles.
TILE_DOCS, TILE_TERMS = 1024, 2048
#: An impact is below 1000000000 tf / 1000 tf.
IMPACT_BOUND = 1_000_000
EXACT = 2 ** 53
#: Buckets of the first of the two windows.
BUCKETS = 64

_TERM = np.ones(256, bool)  # of lowered bytes: 0-9, a-z and all of other scripts
_TERM[:128] = [chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" for b in range(128)]


def terms_of(buffer: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The terms of lowered bytes and where they start."""
    inside = _TERM[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buffer[inside])), starts


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item``, ``terms`` and ``counts`` of the distinct items with terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = [], []
            for text in batch.column("text").to_pylist():
                for _, buffer, _ in portions([text]):
                    counted = pc.value_counts(terms_of(buffer)[0])
                    terms.append(counted.field("values").to_pylist())
                    counts.append(counted.field("counts").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(terms, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))],
                                             names=["item", "terms", "counts"])

    kind = dict(items.dtypes)[id_col]
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).dropDuplicates()
    return rows.mapInArrow(run, f"item {kind}, terms array<string>, counts array<bigint>").filter("size(terms) > 0")


def _binary(flat: np.ndarray, bounds: np.ndarray) -> pa.BinaryArray:
    """Rows ``flat[bounds[i]:bounds[i + 1]]`` as little-endian unsigned 32-bit numbers."""
    data = np.ascontiguousarray(flat, "<u4")
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(data)])


def term_vectors(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """Rows of documents with a term of ``vocabulary`` (``doc``, ``n``,
    ``terms``, ``counts``) and one row per partition with ``sums``: N, L and
    the document frequency of each term."""
    known, size = pa.array(vocabulary, pa.string()), len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, schema = np.zeros(size + 2, np.int64), None
        for batch in batches:
            schema = schema or pa.schema([("doc", batch.column("doc").type), ("n", pa.int64()), ("terms", pa.binary()),
                                          ("counts", pa.binary()), ("sums", pa.list_(pa.int64()))])
            for first, buffer, rows in portions(batch.column("text").to_pylist(), 4 << 20):
                terms, starts = terms_of(buffer)
                row = np.searchsorted(rows, starts, side="right") - 1
                n = np.bincount(row, minlength=len(rows) - 1)
                place = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy().astype(np.int64)
                hit = place >= 0
                keys, counts = np.unique(row[hit] * size + place[hit], return_counts=True)
                row, place = keys // size, keys % size
                sums[0] += np.count_nonzero(n)
                sums[1] += n.sum()
                sums[2:] += np.bincount(place, minlength=size)
                some, at = np.unique(row, return_index=True)
                bounds = np.append(at, len(row))
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc").take(pa.array(first + some)), pa.array(n[some], pa.int64()), _binary(place, bounds),
                         _binary(counts, bounds), pa.nulls(len(some), pa.list_(pa.int64()))], schema=schema)
        if schema is not None:
            nothing = [pa.nulls(1, field.type) for field in schema][:-1]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array([sums.tolist()], pa.list_(pa.int64()))], schema=schema)

    return (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc bigint, n bigint, terms binary, counts binary, sums array<bigint>"))


class ItemTiles:
    """The item side of the multiplication: entries (term, item, weight times
    repeats) in order of their terms, cut into vocabulary tiles."""

    def __init__(self, terms: np.ndarray, items: np.ndarray, weights: np.ndarray, tile_terms: int = TILE_TERMS, exact: int = EXACT):
        heavy = weights * IMPACT_BOUND >= exact
        order = np.lexsort((items[heavy], terms[heavy]))
        self.heavy = [tuple(int(x[heavy][k]) for x in (terms, items, weights)) for k in order]
        order = np.lexsort((items[~heavy], terms[~heavy]))
        terms, items, weights = (x[~heavy][order] for x in (terms, items, weights))
        self.tiles: list[tuple] = []  # first term, width, items used, rows, columns, weights
        begin, sums = 0, {}
        for k in range(len(terms) + 1):
            end = k == len(terms)
            if not end:
                item, weight = int(items[k]), int(weights[k]) * IMPACT_BOUND
                # an entry that would overfill the tile opens the next one; a term may stand in both
                end = terms[k] - terms[begin] >= tile_terms or sums.get(item, 0) + weight >= exact
            if end and k > begin:
                used, column = np.unique(items[begin:k], return_inverse=True)
                low = int(terms[begin])
                self.tiles.append((low, int(terms[k - 1]) - low + 1, used, terms[begin:k] - low, column, weights[begin:k].astype(np.float64)))
                begin, sums = k, {}
            if k < len(terms):
                sums[item] = sums.get(item, 0) + weight

    def scores(self, rows: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_items: int) -> np.ndarray:
        """Scores (documents by items) of a tile of documents; entries in
        order of their terms."""
        out = np.zeros((rows, n_items), np.int64)
        for low, width, used, at, column, weight in self.tiles:
            left, right = np.searchsorted(term, [low, low + width])
            if left == right:
                continue
            docs = np.zeros((rows, width))
            docs[row[left:right], term[left:right] - low] = impact[left:right]
            items = np.zeros((width, len(used)))
            items[at, column] = weight
            out[:, used] += (docs @ items).astype(np.int64)
        for number, item, weight in self.heavy:
            left, right = np.searchsorted(term, [number, number + 1])
            out[row[left:right], item] += impact[left:right] * weight
        return out


class Best:
    """The k best documents of each item so far: score, then identifier, nulls last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.kept: list[tuple] = [tuple(np.empty(0, t) for t in (np.int64, bool, np.int64))] * n_items

    def add(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        hit = scores >= self.least  # equal to the least kept: the identifier decides
        for item in np.flatnonzero(hit.any(axis=0)):
            rows = np.flatnonzero(hit[:, item])
            parts = [np.concatenate(pair) for pair in zip(self.kept[item], (scores[rows, item], unknown[rows], ids[rows]), strict=True)]
            order = np.lexsort((parts[2], parts[1], -parts[0]))[:self.k]
            self.kept[item] = tuple(part[order] for part in parts)
            if len(order) == self.k:
                self.least[item] = self.kept[item][0][-1]


def lengths_factor(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m = 100 - 25 + ((25 n N) div L), in whole numbers of any size."""
    if 25 * int(n.max(initial=0)) * documents < 2 ** 63:
        return 75 + 25 * n * documents // total
    return np.array([75 + 25 * int(x) * documents // total for x in n], np.int64)


def _rank_block(vectors: DataFrame, item_ids: list, item_kind: str, tiles: ItemTiles, documents: int, total: int, k: int) -> DataFrame:
    """``number``, ``item``, ``doc`` and ``score`` of the k best documents of
    each partition for each item of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(item_ids), k)
        for batch in batches:
            unknown = batch.column("doc").is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(batch.column("doc"), 0).to_numpy()
            m = lengths_factor(batch.column("n").to_numpy(), documents, total)
            terms, counts = batch.column("terms").to_pylist(), batch.column("counts").to_pylist()
            for at in range(0, len(ids), TILE_DOCS):
                here = slice(at, at + TILE_DOCS)
                rows = len(ids[here])
                row = np.repeat(np.arange(rows), [len(x) // 4 for x in terms[here]])
                term = np.frombuffer(b"".join(terms[here]), "<u4").astype(np.int64)
                tf = np.frombuffer(b"".join(counts[here]), "<u4").astype(np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[here][row])
                order = np.argsort(term, kind="stable")
                best.add(tiles.scores(rows, row[order], term[order], impact[order], len(item_ids)), ids[here], unknown[here])
        for number, (score, unknown, ids) in enumerate(best.kept):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(score), pa.int32()), pa.array([item_ids[number]] * len(score), item_type),
                     pa.array(ids, pa.int64(), mask=unknown), pa.array(score, pa.int64())], names=["number", "item", "doc", "score"])

    schema = f"number int, item {item_kind}, doc bigint, score bigint"
    item_type = pa.string() if item_kind == "string" else pa.int64() if item_kind == "bigint" else pa.int32()
    return vectors.filter("sums IS NULL").select("doc", "n", "terms", "counts").mapInArrow(run, schema)


def rank(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text", block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS, tile_terms: int = TILE_TERMS,
         exact: int = EXACT) -> DataFrame:
    """``<item_id_col>``, ``rank`` (from 1), ``<id_col>`` and ``score`` of each
    item's k best documents."""
    spark = docs.sparkSession
    kind = dict(items.dtypes)[item_id_col]
    if kind not in ("string", "bigint", "int"):
        items, kind = items.withColumn(item_id_col, F.col(item_id_col).cast("string")), "string"
    held = staged(item_terms(items, item_id_col, item_text_col))
    size = held.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(-(-size["items"] // block_items), -(-size["terms"] // block_terms))
    results = []
    for block in range(blocks):
        rows = held.filter(F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)) == block).collect()  # a block is bounded
        if not rows:
            continue
        vocabulary = sorted({term for r in rows for term in r["terms"]})
        number = {term: n for n, term in enumerate(vocabulary)}
        vectors = staged(term_vectors(docs, vocabulary, id_col, text_col))
        summed = (vectors.filter("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "n"))
                  .groupBy("at").agg(F.sum("n").alias("n")).collect())  # the block's vocabulary and two more
        sums = {r["at"]: r["n"] for r in summed}
        documents, total = sums.get(0, 0), sums.get(1, 0)
        if not documents:
            continue
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * sums[n + 2] + 1))) for n in range(len(vocabulary))]
        entries = [(number[t], i, c * weight[number[t]]) for i, r in enumerate(rows) for t, c in zip(r["terms"], r["counts"], strict=True)]
        tiles = ItemTiles(*(np.array(x, np.int64) for x in zip(*entries, strict=True)), tile_terms, exact)
        found = _rank_block(vectors, [r["item"] for r in rows], kind, tiles, documents, total, k)
        better = [F.desc("score"), F.col("doc").asc_nulls_last()]
        few = Window.partitionBy("number", "bucket").orderBy(*better)
        found = (found.withColumn("bucket", F.pmod(F.xxhash64("doc"), F.lit(BUCKETS)))
                 .withColumn("place", F.row_number().over(few)).filter(F.col("place") <= k))
        place = F.row_number().over(Window.partitionBy("number").orderBy(*better))
        ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
        results.append(staged(ranked.select(F.col("item").alias(item_id_col), "rank", F.col("doc").alias(id_col), "score")))
    if not results:
        return spark.createDataFrame([], f"{item_id_col} {kind}, rank int, {id_col} bigint, score bigint")
    return reduce(DataFrame.unionByName, results)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
q AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
t AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM t, sizes GROUP BY term, big_n),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(qtf * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN weights USING (term), sizes GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
