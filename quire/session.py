"""Spark session defaults and cluster-safe helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder for scripts and tests, plus the checkpoint helper used to
cut long lineages.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for correctness or scale (not for a particular box).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # splits of a scan: small enough that one task's regular expressions end soon
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's current one); where it is
    unset, as in tests, a folder below the warehouse, which the cluster shares
    as well."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have ``path`` (and all below it) deleted when the driver's JVM ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def staging_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, deleted with the
    driver's JVM."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-staging/{name}-{uuid.uuid4().hex[:12]}"
    delete_at_exit(spark, path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written once to a staging folder as columns and read back: what reads
    it again computes nothing anew and reads the columns it needs.  Compressed
    and not held in memory, so meant for wide or many rows."""
    path = staging_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    A reliable checkpoint writes its files in a second job over the same
    plan, so the rows are persisted for the duration of the call: the plan is
    computed once, then written, then the cache is dropped."""
    delete_at_exit(df.sparkSession, ensure_checkpoint_dir(df.sparkSession))
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
