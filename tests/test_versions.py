"""Versioned tables: failed, repeated and concurrent writes; parts."""

import pytest
from pyspark.sql import functions as F

from quire.sources import files as FS
from quire.sources import versions as V


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, text string, split string")


def ids(spark, path, **options):
    return sorted(r.id for r in V.read(spark, path, **options).collect())


def test_failed_and_repeated_appends_add_nothing_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        V.read(spark, path)
    assert V.append(rows(spark, ("a", "1", "x"), ("b", "2", "x")), path, "first", "id") == 1
    batch = rows(spark, ("b", "2", "x"), ("c", "3", "x"), ("c", "3", "x"), ("d", None, "x")).repartition(3, "id")
    broken = batch.withColumn("text", F.when(F.col("id") == "d", F.raise_error(F.lit("stopped"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="stopped"):
        V.append(broken, path, "second", "id")
    assert ids(spark, path) == ["a", "b"]
    for _ in range(2):
        assert V.append(batch, path, "second", "id") == 2
        assert ids(spark, path) == ["a", "b", "c", "c", "d"]
    assert V.clean(spark, path) == 0 and V.clean(spark, path, -10) == 1  # the failed write's folder
    assert ids(spark, path) == ["a", "b", "c", "c", "d"]


def test_the_second_of_two_writers_starts_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    V.append(rows(spark, ("a", "1", "x")), path, "first", "id")
    write, raced = V._write, []

    def slow(data, *args):
        written = write(data, *args)
        if not raced:  # another writer commits between these files and their commit
            raced.append(1)
            V.append(rows(spark, ("b", "2", "x"), ("c", "3", "x")), path, "quick", "id")
        return written

    monkeypatch.setattr(V, "_write", slow)
    assert V.append(rows(spark, ("c", "3", "x"), ("d", "4", "x")), path, "slow", "id") == 3
    assert ids(spark, path) == ["a", "b", "c", "d"]
    assert len(V._names(spark, f"{path}/data")) == 3


def test_parts_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    V.replace(rows(spark, ("a", "1", "train"), ("b", "2", "test"), ("c", "3", "validation")), path, "one", "split")
    assert V.replace(rows(spark, ("d", "4", "test")), path, "two", "split") == 2
    assert ids(spark, path) == ["a", "c", "d"] and ids(spark, path, part="split=test") == ["d"]
    assert V.read(spark, path).columns == ["id", "text", "split"]
    V.append(rows(spark, ("e", "5", "test")), path, "three", "id", "split")
    assert ids(spark, path, part="split=test") == ["d", "e"]
    V.replace(rows(spark, ("z", "9", "train")), path, "four")
    assert ids(spark, path) == ["z"]


def test_csv_tables(spark, tmp_path):
    path, schema = str(tmp_path / "t"), FS.CORPUS_SCHEMA
    data = spark.createDataFrame([("a", "f", "one\n\"two\", three", 1, "s"), ("b", "g", None, None, "s")], schema)
    V.append(data, path, "one", "id", fmt="csv")
    V.append(data, path, "two", "id", fmt="csv", schema=schema)
    assert sorted(map(tuple, V.read(spark, path, fmt="csv", schema=schema).collect())) == sorted(map(tuple, data.collect()))
    assert V.read(spark, str(tmp_path / "none"), schema=schema).count() == 0
