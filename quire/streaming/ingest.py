"""Document arrival as a file stream.

New files -> clean -> content id -> skip ids already stored -> classify, fields
of the gated class -> append.

Which ids are stored is the query's state: Spark's streaming de-duplication keeps the content
ids in its state store (RocksDB, change logs in the checkpoint), so a batch looks up its own ids
and the work follows the batch, not the corpus; no Python runs per id.  The ids of a
corpus that was there before the stream are noted in the checkpoint at the
first start and arrive with the first batch.  Copies
inside one batch are all kept, as in the batch append; rows with one id that
meet in an Arrow batch travel as one row with one text and the list of their
names, so a hot text is not shuffled once per copy.

A batch overwrites its own partition of the corpus, and a batch that stopped
half-way runs again on the state before it: the rows are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import scalars as S
from quire.functions import text as TX
from quire.session import settings

CORPUS_COLUMNS = ["id", "filename", "text", "label_name", "timestamp"]
SCORE_COLUMNS = ["classification", "fields"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def to_corpus_rows(batch: DataFrame) -> DataFrame:
    """Arriving ``documents`` rows -> corpus rows with content-hash ids; a null
    text counts as empty."""
    cleaned = batch.select(
        F.concat(F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.coalesce(TX.clean_text("text"), F.lit("")).alias("text"), F.lower("lang").alias("label_name"))
    return cleaned.select(S.content_hash("text").alias("id"), "filename", "text", "label_name",
                          S.format_timestamp(F.current_timestamp()).alias("timestamp"))


_GROUPED = "id string, text string, filenames array<string>, labels array<string>"


def _one_text_per_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members: dict[str, list[int]] = {}
        for n, content_id in enumerate(batch.column("id").to_pylist()):
            members.setdefault(content_id, []).append(n)
        first = pa.array([rows[0] for rows in members.values()], pa.int64())
        names, labels = (batch.column(c).to_pylist() for c in ("filename", "label_name"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(first), batch.column("text").take(first),
             *(pa.array([[column[n] for n in rows] for rows in members.values()], pa.list_(pa.string())) for column in (names, labels))],
            names=["id", "text", "filenames", "labels"])


#: What a row of the stream is: arrived, the first of its id in any batch, or stored before the stream.
_ROW, _FIRST, _STORED = range(3)


def arrivals(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The stream that ``unseen`` takes batch by batch: rows (``id``, ``filename``,
    ``text``, ``label_name``), one flag per id that no earlier batch had (Spark's
    streaming de-duplication holds the ids) and the ids of the stream ``stored``."""
    grouped = rows.select("id", "filename", "text", "label_name").mapInArrow(_one_text_per_id, _GROUPED)
    ids = rows.select("id").unionByName(stored.select("id")).dropDuplicates(["id"])
    return (grouped.withColumn("kind", F.lit(_ROW)).unionByName(ids.withColumn("kind", F.lit(_FIRST)), allowMissingColumns=True)
            .unionByName(stored.select("id", F.lit(_STORED).alias("kind")), allowMissingColumns=True))


def unseen(batch: DataFrame) -> DataFrame:
    """Of one batch of ``arrivals``, the rows whose id is neither stored nor in an
    earlier batch; copies inside the batch are all kept."""
    same = Window.partitionBy("id")
    passed = batch.select("*", F.max(F.col("kind") == _FIRST).over(same).alias("first"), F.max(F.col("kind") == _STORED).over(same).alias("was"))
    passed = passed.filter((F.col("kind") == _ROW) & F.col("first") & ~F.col("was"))
    both = F.arrays_zip("filenames", "labels")
    return (passed.select("id", "text", F.explode_outer(both).alias("m"))
            .select("id", F.col("m.filenames").alias("filename"), "text", F.col("m.labels").alias("label_name")))


def score_rows(model: PipelineModel, gate: str = "invoice", presence=None) -> Callable[[DataFrame], DataFrame]:
    """Adds ``classification`` (display form) and, for the gated class, the
    ``fields`` of the cleaned text; with ``presence`` a field is its status
    text (X13).  Works on a stream as on a table."""
    from quire.functions import extract as X
    from quire.operators import models as M
    from quire.operators.results import field_value

    def run(rows: DataFrame) -> DataFrame:
        scored = M.predict(model, rows).select(*rows.columns, "predicted_label")
        if presence is not None:
            scored = M.predict_presence(*presence, scored)
        values = [X.extract_field(F.col("text"), f) for f in X.FIELD_KEYS]
        if presence is not None:
            values = [field_value(v, F.col(f"probability_has_{f}")) for f, v in zip(X.FIELD_KEYS, values, strict=True)]
        fields = F.map_from_arrays(F.array(*[F.lit(f) for f in X.FIELD_KEYS]), F.array(*values))
        return scored.select(*rows.columns, S.display_class(F.col("predicted_label")).alias("classification"),
                             F.when(F.lower("predicted_label") == gate, fields).alias("fields"))
    return run


def write_batch(rows: DataFrame, corpus_path: str, batch: str) -> None:
    """Write ``rows`` as the batch's own partition, replacing what is there, in
    files of about the session's advisory partition size."""
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{corpus_path}/batch={batch}")


def stored_ids(spark: SparkSession, corpus_path: str, stream: str) -> DataFrame:
    """The ids of a corpus, which may not exist yet; not those that ``stream``
    itself has written, so that its first batch can run again."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "batch")])
    root = spark._jvm.org.apache.hadoop.fs.Path(corpus_path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], "id string")
    return spark.read.schema(schema).parquet(corpus_path).filter(~F.col("batch").startswith(f"{stream}-")).select("id")


def _noted(spark: SparkSession, checkpoint: str, stored: Callable[[], DataFrame]) -> DataFrame:
    """A stream of the ids that were stored at the first start, noted in the checkpoint then."""
    path = f"{checkpoint}/stored"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        stored().dropDuplicates().write.mode("overwrite").parquet(path)
    return spark.readStream.schema("id string").parquet(path)


def read_corpus(spark: SparkSession, corpus_path: str, scored: bool = False) -> DataFrame:
    rows = spark.read.option("mergeSchema", scored).parquet(corpus_path)
    return rows.select(CORPUS_COLUMNS + (SCORE_COLUMNS if scored else []))


def start_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, corpus_path: str,
                 checkpoint: str, glob: str = "*.parquet", available_now: bool = True,
                 max_files_per_trigger: int | None = None, rows_of: Callable[[DataFrame], DataFrame] = to_corpus_rows,
                 score: Callable[[DataFrame], DataFrame] | None = None):
    """Start the file stream; returns the ``StreamingQuery``.  ``rows_of`` makes
    corpus rows of arriving ones; ``score`` (``score_rows``) sees new rows only.  The number of state
    partitions is the session's ``spark.sql.shuffle.partitions`` at the first start."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # batch numbers of another stream into the same corpus are not mistaken for this one's
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    arrived = arrivals(rows_of(reader.parquet(source_dir)), _noted(spark, checkpoint, lambda: stored_ids(spark, corpus_path, stream)))
    columns = CORPUS_COLUMNS + (SCORE_COLUMNS if score is not None else [])

    def sink(batch: DataFrame, epoch_id: int) -> None:
        new = unseen(batch)
        if score is not None:
            new = score(new)
        new = new.withColumn("timestamp", S.format_timestamp(F.current_timestamp()))
        write_batch(new.select(columns), corpus_path, f"{stream}-{epoch_id}")

    writer = arrived.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    with settings(spark, {_PROVIDER: _ROCKS}):  # the query takes its own copy of the settings when it starts
        return writer.start()
