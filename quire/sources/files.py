"""File sources and sinks.

Folder scans use the ``binaryFile`` source: Spark lists the files in parallel,
and the ``content`` column is only read when a query selects it (metadata
queries never touch the bytes).  Staging folders for jobs that write and read
back live under the cluster's shared checkpoint folder, never on a
machine-local path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import scalars as S
from quire.functions import text as TX
from quire.session import reliable_checkpoint, staging_dir  # noqa: F401

CORPUS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("filename", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])


def scan_folder(spark: SparkSession, path: str, with_content: bool = True) -> DataFrame:
    """S1 for one input path: every file below it (recursive); the label is the
    lower-cased name of the input path itself."""
    label = path.rstrip("/").split("/")[-1].lower()
    return _listing(spark, path, with_content).withColumn("label_name", F.lit(label))


def _listing(spark: SparkSession, path: str, with_content: bool) -> DataFrame:
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return df.select("path", "length", "modificationTime", *(["content"] if with_content else []))


def scan_labelled(spark: SparkSession, root: str, with_content: bool = True) -> DataFrame:
    """S1 for a folder of labelled folders, in one scan: the label of a file is
    the lower-cased name of the folder right below ``root``, however many there
    are."""
    files = _listing(spark, root, with_content)
    below = F.regexp_extract("path", r"^.*?" + root.rstrip("/").split("/")[-1] + r"/([^/]*)/", 1)
    return files.withColumn("label_name", F.lower(below))


def scan_folders(spark: SparkSession, paths: list[str], with_content: bool = True) -> DataFrame:
    """Several labelled input folders (one scan each; the folder list is
    small, the files are listed and read in parallel)."""
    out = None
    for p in paths:
        df = scan_folder(spark, p, with_content)
        out = df if out is None else out.unionByName(df)
    return out


def decode_text(content) -> F.Column:
    """S3: UTF-8 decode that drops undecodable bytes (a genuine U+FFFD is
    dropped too)."""
    return F.regexp_replace(F.make_valid_utf8(TX.col_of(content).cast("string")), "\ufffd", "")


def ingest(files: DataFrame, id_type: str = "filename", now: F.Column | None = None) -> tuple[DataFrame, DataFrame]:
    """S1-S3 + S2 + T10 + D1: routed files -> corpus rows; returns
    ``(rows, rejects)``.  Text-family files are decoded here; PDF / image /
    spreadsheet routes need their page, OCR or row text as input (see
    ``quire.operators.ocr`` and ``table_to_text``) and are passed on as rejects
    with their route so a second job can pick them up."""
    now = now if now is not None else F.current_timestamp()
    f = files.withColumn("filename", S.base_name("path")).withColumn("ext", S.extension("path"))
    f = f.withColumn("route", S.route("ext"))
    texts = f.filter(F.col("route") == "text")
    rejects = f.filter(F.col("route") != "text").select(
        "path", "filename", "route", F.when(F.col("route") == S.UNSUPPORTED, F.lit("unsupported file type"))
        .otherwise(F.lit("needs extracted text")).alias("reason"))
    rows = texts.select("filename", "label_name", TX.clean_text(decode_text("content")).alias("text"))
    ident = S.content_hash("text") if id_type == "hash" else F.col("filename")
    rows = rows.select(ident.alias("id"), "filename", "text", "label_name",
                       S.format_timestamp(now).alias("timestamp"))
    return rows, rejects


def file_metadata(files: DataFrame, *keep: str) -> DataFrame:
    """S12 + D2-D6: name, extension, type, sizes and modification time, from
    the listing only."""
    return files.select(
        *keep, S.base_name("path").alias("filename"), S.extension("path").alias("extension"),
        S.file_type("path").alias("file_type"), S.type_description(S.extension("path")).alias("type"),
        S.format_size("length").alias("file_size"), S.format_size_short("length").alias("size"),
        S.format_timestamp("modificationTime").alias("last_modified"), F.col("length"))


#: Rows of one CSV file: ``read_csv`` gives a whole file to one task.
CSV_ROWS = 20_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows: int = CSV_ROWS) -> None:
    """Header, quoted multi-line safe CSV; files of at most ``rows`` rows."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", True)
     .option("maxRecordsPerFile", rows).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Explicit schema, header, multi-line records; empty fields read as null."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def write_class_index(lines: DataFrame, path: str) -> None:
    """The ``<id> <name>`` lines, one file, sorted by id (a handful of rows)."""
    lines.orderBy("label").select("value").coalesce(1).write.mode("overwrite").text(path)


def read_class_index(spark: SparkSession, path: str) -> DataFrame:
    """S10 input."""
    return spark.read.text(path)


#: Rows of one sheet: the most a spreadsheet file of the common format holds is 1,048,576.
SHEET_ROWS = 10_000


def table_to_text(df: DataFrame, file_key: str, order_col: str, cols: list[str]) -> DataFrame:
    """A sheet's cells to text - null -> '', cells joined by a space, rows
    (in row order) joined by a space; one text per file.  A file is one sheet,
    so its rows are bounded; tables are cut into sheets by ``sheets`` first."""
    row_text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    rows = df.select(file_key, F.col(order_col).alias("_o"), row_text.alias("_r"))
    g = rows.groupBy(file_key).agg(F.sort_array(F.collect_list(F.struct("_o", "_r"))).alias("_rs"))
    return g.select(file_key, F.array_join(F.transform("_rs", lambda x: x["_r"]), " ").alias("text"))


def sheets(df: DataFrame, order_col: str, out: str = "sheet", rows: int = SHEET_ROWS) -> DataFrame:
    """Number the sheets a table is cut into: ranges of ``rows`` keys."""
    return df.withColumn(out, F.floor(F.col(order_col) / rows))


WRITE_MODES = ("append", "overwrite", "production")


def write_corpus(spark: SparkSession, rows: DataFrame, path: str, mode: str = "append",
                 key: str = "id") -> DataFrame:
    """``append`` adds rows whose key is not stored yet (incoming copies
    of each other are all kept); ``overwrite`` replaces the stored corpus;
    ``production`` writes nothing.  Returns the rows that were (or would be)
    written."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if mode == "production":
        return rows
    if mode == "overwrite":
        rows.write.mode("overwrite").parquet(path)
        return rows
    try:
        stored = spark.read.parquet(path).select(key)
    except Exception as e:  # noqa: BLE001 - nothing stored yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        stored = None
    new = rows if stored is None else rows.join(stored, key, "left_anti")
    # materialise before writing into the folder the anti join reads from
    new = reliable_checkpoint(new)
    new.write.mode("append").parquet(path)
    return new
