"""Readers for the parquet tables the jobs start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet tables carry their schema, so nothing is inferred here.  How many
    tasks a scan has is Spark's choice (``spark.sql.files.maxPartitionBytes``
    and ``spark.sql.files.minPartitionNum``); nothing is dealt out again."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
