"""Exact dedup by content sort, on DataFrame functions only.

Rows are range-partitioned by sampled splitters on (first 64 characters, hash
of the text, salt), each partition is sorted externally on that key and the
whole text, and neighbouring full comparisons (the window's partition
boundaries) form the groups.  The splitters sample a bounded key, never whole
texts.  The salt, a hash of the identifier, deals one group of copies over as
many partitions as there are; the runs of a text meet again by its SHA-256,
one small row per salt.

Edge cases: a null text counts as empty; null identifiers sort last, so they
stay only in a group without any other; of rows repeated with the same
identifier and text one is kept; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import shuffle_partitions, staged

#: Characters of a text that take part in the range splitters.
HEAD_CHARS = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise=lambda text: text, salts: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``.  ``keep`` is ``smallest`` or ``largest``;
    ``normalise`` maps the text column to the column that is compared."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    salts = salts or shuffle_partitions(docs.sparkSession)
    best: Column = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()

    rows = docs.select(F.col(id_col).alias("id"),
                       normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("body"))
    keyed = rows.select("id", "body", F.substring("body", 1, HEAD_CHARS).alias("head"),
                        F.xxhash64("body").alias("hash"),
                        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    dealt = keyed.repartitionByRange("head", "hash", "salt")
    run = (Window.partitionBy("head", "hash", "salt", "body").orderBy(best)
           .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    place = Window.partitionBy("head", "hash", "salt", "body").orderBy(best)
    runs = staged(dealt.select(
        "id", "salt", F.row_number().over(place).alias("place"), F.first("id").over(run).alias("run_best"),
        F.count(F.lit(1)).over(run).alias("run_size"), F.unhex(F.sha2("body", 256)).alias("digest")))

    # one row per run; a text has at most one run per salt
    together = Window.partitionBy("digest")
    agg = F.min if keep == "smallest" else F.max
    groups = runs.filter("place = 1").select(
        F.col("digest").alias("g_digest"), F.col("salt").alias("g_salt"),
        agg("run_best").over(together).alias("keep_id"), F.sum("run_size").over(together).alias("group_size"))
    joined = runs.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("salt") == F.col("g_salt")))
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        ((F.col("place") == 1) & F.col("run_best").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
