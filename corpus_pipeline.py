"""A training corpus from raw documents: toxic texts out, exact copies out, one
text of each near-duplicate group kept, secrets masked, the rest packed.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
Decisions name rows by where they stand in their files, never by the
identifier: rows that repeat an identifier, or repeat altogether, are told
apart, and rows with a null identifier are judged like any others.  The rows
that go are marked in bit words, so texts that stay are not shuffled.

Edge cases: a null text counts as empty and stays unless it is a copy; texts
of any length are judged whole; an empty table gives an empty result; extra
columns pass through the filtering stages whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import exact_dedup, ngram_join, packing, queries, secrets, toxicity
from quire.llm.common import free_name, placed, read, release, staged, staged_count, without


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), lambda key: toxicity.fold_of(key) != 0)
    return toxicity.drop(docs, model, 0.5)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays, in one row."""
    docs, rows, place, seed = placed(docs)
    key = free_name(rows, "key")  # ordered by doc_id, then place; a null doc_id is the least
    judged = exact_dedup.exact_dedup(rows.withColumn(key, F.struct("doc_id", place)), id_col=key, keep="largest")
    return without(docs, judged.filter("NOT kept").select(F.col(key)[place].alias(place)), place, seed)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays, in one row;
    texts without words stay all."""
    docs, rows, place, seed = placed(docs)
    return without(docs, ngram_join.dropped(rows, place), place, seed)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, one row per piece."""
    return packing.pack(docs, public_tokenizers.path(queries.WORD_FILE))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("n-gram Jaccard join", drop_near_copies),
          ("secret scans", mask_secrets), ("packing", pack)]

#: The classifier is fitted, so SQL can't state the rows; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    first = staged_count()
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        last = staged_count() - 1
        release(spark, first, last)  # all that this stage read or wrote on its way
        first = last
    return STAGES[-1][1](spark, docs, sf_dir)
