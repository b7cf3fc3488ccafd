"""Byte-level BPE encoding and decoding by a rank file.

``encode`` cuts texts by the vocabulary's pattern, folds ranked merges over the
byte arrays of the distinct words of each batch and packs the ids; ``decode``
concatenates the binary pieces of ids.  One pass, no shuffle, whole texts.

``encode_native`` is the same fold in Spark higher-order functions with a
literal rank map; the README gives its figures and why the Arrow form runs.

Edge cases: a null text counts as empty and gives no ids; words of any length
are folded in n log n; repeated rows are encoded each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe import MergeFold, WordEncoder, in_portions

#: White space of the pattern (Unicode White_Space), as a character class.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A run without white space and the space before it; else white space, as the pattern takes it.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def rank_pairs(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """(left, right, merged) for every way to join two pieces into a third, by rank."""
    for piece, rank in sorted(ranks.items(), key=lambda x: x[1]):
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                yield left, right, rank


class Vocabulary:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.piece = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.piece[rank] = piece
        byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        whole = {piece: np.array([rank], "<u4").tobytes() for piece, rank in ranks.items()}
        cut = regex.compile(pattern).findall

        def pieces(chunk: str) -> list[str]:  # a space and letters are one word by the pattern
            return [chunk] if chunk.isalpha() or chunk[0] == " " and chunk[1:].isalpha() else cut(chunk)

        self.encoder = WordEncoder(MergeFold(rank_pairs(ranks)), CHUNK.findall, pieces, lambda raw: byte_ids[raw], whole)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encoder.encode(texts)

    def decode(self, packed: bytes) -> bytes:
        return b"".join([self.piece[i] for i in np.frombuffer(packed, "<u4").tolist()])


_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def _vocabulary(name: str, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    """One per worker and rank file."""
    if (name, pattern) not in _VOCABULARIES:
        _VOCABULARIES[name, pattern] = Vocabulary(ranks, pattern)
    return _VOCABULARIES[name, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>`` and ``ids``, the packed ids of the whole text, per row."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # a vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path, ranks.value, pattern)
        for batch in batches:
            at = 0
            for texts in in_portions(batch.column("text").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(texts)), pa.array(vocabulary.encode(texts), pa.binary())],
                    names=["id", "ids"])
                at += len(texts)

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, ids binary").withColumnRenamed("id", id_col))


def decode_digest(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of packed ids and of the bytes they decode to."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))  # a vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path, ranks.value, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(vocabulary.decode(x)).hexdigest() for x in ids], pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(encoded.dtypes)[id_col]
    return (encoded.select(F.col(id_col).alias("id"), "ids")
            .mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded bytes of ``ids_col``."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))  # a vocabulary file

    @F.pandas_udf("binary")
    def pieces(ids):
        vocabulary = _vocabulary(path, ranks.value, pattern)
        return ids.map(lambda x: None if x is None else vocabulary.decode(x))

    return encoded.withColumn(out_col, pieces(F.col(ids_col)))


#: Buckets of the literal rank map; a bucket's few entries are searched in turn.
BUCKETS = 1 << 16


def rank_literal(spark, ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of small maps, dealt by CRC-32 of the piece."""
    import zlib

    buckets: list[list[str]] = [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        buckets[zlib.crc32(piece) % BUCKETS].append(f"X'{piece.hex()}', {rank}")
    none = "map(X'', cast(null as int))"
    return F.expr("array(" + ", ".join(f"map({', '.join(b)})" if b else none for b in buckets) + ")")


def encode_native(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``<id_col>`` and ``ids`` (array<int>) by Spark functions alone: the
    distinct words of each text are folded by ``aggregate``."""
    literal = rank_literal(docs.sparkSession, ranks)

    def rank(piece: Column) -> Column:
        return F.element_at(F.element_at(literal, (F.crc32(piece) % BUCKETS + 1).cast("int")), piece)

    def best(parts: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.struct(
            F.coalesce(rank(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))), F.lit(int(NONE_RANK))).alias("rank"),
            i.alias("at")))
        return F.array_min(pairs)

    def step(parts: Column, _: Column) -> Column:
        def merged(found: Column) -> Column:
            at = found["at"]
            return F.when(found["rank"] == int(NONE_RANK), parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), at - 1),
                F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
                F.slice(parts, at + 2, F.size(parts))))
        return F.when(F.size(parts) < 2, parts).otherwise(F.element_at(F.transform(F.array(best(parts)), merged), 1))

    def word_ids(word: Column) -> Column:
        raw = F.encode(word, "UTF-8")
        parts = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(raw, i, F.lit(1)))
        return F.transform(F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), parts, step), rank)

    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit("(?U)" + pattern), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), words.alias("words")).select(
        "id", "words", F.array_distinct("words").alias("distinct_words"))
    rows = rows.withColumn("encoded", F.transform("distinct_words", word_ids))
    ids = F.flatten(F.transform("words", lambda w: F.element_at(
        F.col("encoded"), F.array_position(F.col("distinct_words"), w).cast("int"))))
    return rows.select(F.col("id").alias(id_col), ids.alias("ids"))


NONE_RANK = 2 ** 31 - 1
