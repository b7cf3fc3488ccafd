"""Reading and staging helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import delete_at_exit, ensure_checkpoint_dir, settings

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Folders of staged files, oldest first.
_STAGED: list[str] = []


def staged(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the plan runs once, later stages prune columns, and a lost executor
    costs only a re-read.  The files go when the driver's JVM ends, or before
    by ``release``.  ``batch_bytes`` bounds the Arrow batches of its Python steps."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    with settings(spark, {} if batch_bytes is None else {"spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes)}):
        df.write.parquet(path)
    delete_at_exit(spark, path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run):
    """``run`` (a function of batches), which at its end hands the memory it has
    freed back to the system: workers are kept for later tasks, several to an executor."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def staged_count() -> int:
    return len(_STAGED)


def release(spark: SparkSession, first: int, last: int) -> None:
    """Delete the folders staged from number ``first`` to before ``last``; nothing may read them any more."""
    for path in _STAGED[first:last]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


# --- rows named by where they stand in their files -------------------------------------

#: Rows of the table of dropped positions (64 positions each) that may be broadcast: some 60 MB.
BROADCAST_WORDS = 1_000_000


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _place(seed: int):
    return F.struct(F.xxhash64(F.lit(seed), F.col("_metadata.file_path")).alias("file"), F.col("_metadata.row_index").alias("row"))


def placed(docs: DataFrame) -> tuple[DataFrame, DataFrame, str, int]:
    """``docs`` as rows of Parquet files (written first unless it is a plain
    read of such), the same with a column that names each row by a hash of its
    file's path and its number there, that column's name, and the seed for
    which no two files share a hash."""
    name = free_name(docs, "place")
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = staged(docs)
    for seed in range(100):
        files = docs.select(_place(seed)["file"].alias("hash"), F.col("_metadata.file_path").alias("file")).distinct()
        if files.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return docs, docs.select("*", _place(seed).alias(name)), name, seed
    raise ValueError("no seed tells the files apart")


def without(docs: DataFrame, dropped: DataFrame, name: str, seed: int, words: int = BROADCAST_WORDS) -> DataFrame:
    """``docs`` (of ``placed``) without the rows whose places ``dropped`` holds in
    column ``name``.  The places become bit words of 64 rows, which are broadcast,
    so no row of ``docs`` is shuffled.  Where they are more than ``words``, the files are worked
    through in waves, each with its own words."""
    place = F.col(name)
    bits = staged(dropped.groupBy(place["file"].alias("file"), F.shiftright(place["row"], 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({name}.row % 64 AS int))")).alias("bits")))
    waves = max(1, -(-bits.count() // words))
    file, row, held, of_file, of_word = (free_name(docs, n) for n in ("file_hash", "row_number", "bits", "of_file", "of_word"))
    rows = docs.select("*", _place(seed)["file"].alias(file), F.col("_metadata.row_index").alias(row))

    def wave(k: int) -> DataFrame:
        mine, among = bits, rows
        if waves > 1:  # a filter on a file's path leaves other files unread
            mine, among = (x.filter(F.pmod(F.col(c), F.lit(waves)) == k) for x, c in ((bits, "file"), (rows, file)))
        mine = mine.select(F.col("file").alias(of_file), F.col("word").alias(of_word), F.col("bits").alias(held))
        j = among.join(F.broadcast(mine), (F.col(file) == F.col(of_file)) & (F.shiftright(F.col(row), 6) == F.col(of_word)), "left")
        bit = F.getbit(F.col(held), (F.col(row) % 64).cast("int"))
        return j.filter(F.col(held).isNull() | (bit == 0)).select(*[F.col(f"`{c}`") for c in docs.columns])

    return wave(0) if waves == 1 else reduce(DataFrame.unionByName, [staged(wave(k)) for k in range(waves)])


def ascii_lower(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
