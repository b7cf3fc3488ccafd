"""Whole versions of a written table (S7, S11, W4): files first, then one pointer.

A table is a folder: ``data`` holds the files of every write, one folder each,
``versions`` one small manifest per version that lists the folders it is made
of.  A write adds files nobody reads yet and then commits: the next manifest
appears under its number by a rename that fails if the number is taken.  So a reader
always sees a whole version; a write that fails leaves the table as it was; of
two writers that start from one version the second starts again on what the
first has committed.  A write carries its writer's name, and a name that a version
already holds commits nothing: a job that runs again adds nothing twice.

Replacing a part (a split) makes a version without that part's old folders.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = {"parquet": {}, "json": {}, "csv": {"header": "true", "escape": '"', "quoteAll": "true", "multiLine": "true"}}


class Taken(Exception):
    """Another writer has committed this version."""


def _path(spark: SparkSession, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(names))


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names and modification times (ms) in a folder; none if it is not there."""
    fs = _fs(spark, folder)
    if not fs.exists(_path(spark, folder)):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(_path(spark, folder))]


def current(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    """The newest version's number (0 for none) and its entries: ``writer``,
    ``folder`` and, in tables of parts, ``part`` (as ``column=value``)."""
    numbers = [int(m[1]) for name, _ in _names(spark, f"{path}/versions") if (m := re.fullmatch(r"(\d+)\.json", name))]
    if not numbers:
        return 0, []
    number = max(numbers)
    text = spark.read.text(f"{path}/versions/{number:020d}.json", wholetext=True).first()[0]
    return number, json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, entries: list[dict]) -> None:
    fs, folder = _fs(spark, path), f"{path}/versions"
    fs.mkdirs(_path(spark, folder))
    draft, final = _path(spark, folder, f".draft-{uuid.uuid4().hex}"), _path(spark, folder, f"{number:020d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(entries).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # no overwriting
    try:
        context.rename(draft, final, plain)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise Taken(str(final)) from e
        raise


def _read(spark: SparkSession, path: str, entries: list[dict], fmt: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.format(fmt).options(**FORMATS[fmt]).option("basePath", f"{path}/data")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([f"{path}/data/{e['folder']}" + (f"/{e['part']}" if e.get("part") else "") for e in entries]).drop("writer")


def read(spark: SparkSession, path: str, part: str | None = None, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """The newest version, or one part of it (``column=value``)."""
    number, entries = current(spark, path)
    entries = [e for e in entries if part is None or e.get("part") == part]
    if not entries:
        if schema is None:
            raise ValueError(f"{path} has no version" if not number else f"version {number} of {path} has no rows" + (f" in {part}" if part else ""))
        return spark.createDataFrame([], schema)
    return _read(spark, path, entries, fmt, schema)


def _write(rows: DataFrame, path: str, writer: str, part_col: str | None, fmt: str) -> list[dict]:
    spark = rows.sparkSession
    folder = f"writer={writer}.{uuid.uuid4().hex[:8]}"
    out = rows.write.format(fmt).options(**FORMATS[fmt])
    if part_col:
        out = out.partitionBy(part_col)
    out.save(f"{path}/data/{folder}")
    entry = {"writer": writer, "folder": folder}
    if not part_col:
        return [entry]
    return [entry | {"part": name} for name, _ in sorted(_names(spark, f"{path}/data/{folder}")) if "=" in name]


def _publish(rows: DataFrame, path: str, writer: str, part_col: str | None, fmt: str, fresh, merged) -> int:
    if not re.fullmatch(r"[\w-]+", writer):
        raise ValueError("a writer's name has letters, digits, _ and - only")
    spark = rows.sparkSession
    while True:
        number, entries = current(spark, path)
        if any(e["writer"] == writer for e in entries):
            return number
        written = _write(fresh(rows, entries), path, writer, part_col, fmt)
        try:
            _commit(spark, path, number + 1, merged(entries, written))
            return number + 1
        except Taken:  # again, on top of what has been committed; the files just written are never read
            if written:
                _fs(spark, path).delete(_path(spark, path, "data", written[0]["folder"]), True)


def append(rows: DataFrame, path: str, writer: str, key: str | None = None, part_col: str | None = None, fmt: str = "parquet",
           schema: T.StructType | None = None) -> int:
    """Add ``rows``; with ``key``, those whose key the table does not hold yet
    (copies among them are all added).  Returns the version that holds them."""
    def fresh(rows: DataFrame, entries: list[dict]) -> DataFrame:
        if key is None or not entries:
            return rows
        return rows.join(_read(rows.sparkSession, path, entries, fmt, schema).select(key), key, "left_anti").select(rows.columns)

    return _publish(rows, path, writer, part_col, fmt, fresh, lambda entries, written: entries + written)


def replace(rows: DataFrame, path: str, writer: str, part_col: str | None = None, fmt: str = "parquet") -> int:
    """Replace the table, or, with ``part_col``, the parts that occur in ``rows``."""
    def merged(entries: list[dict], written: list[dict]) -> list[dict]:
        parts = {e["part"] for e in written} if part_col else None
        return [e for e in entries if parts is not None and e.get("part") not in parts] + written

    return _publish(rows, path, writer, part_col, fmt, lambda rows, entries: rows, merged)


def clean(spark: SparkSession, path: str, older_than_s: float = 7 * 86400) -> int:
    """Delete folders that the newest version does not list and that were
    written long ago (younger ones may belong to a writer at work)."""
    _, entries = current(spark, path)
    listed, gone = {e["folder"] for e in entries}, 0
    for name, changed in _names(spark, f"{path}/data"):
        if name not in listed and changed / 1000 < time.time() - older_than_s:
            gone += bool(_fs(spark, path).delete(_path(spark, path, "data", name), True))
    return gone
