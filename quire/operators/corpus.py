"""Corpus operators: label index, class index file, incremental de-duplicated
append, lookups (S9-S11, J1b, J3, J4, U1, U2, W6, W7, P1-P5, P10, K9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.functions import text as TX


def label_index(df: DataFrame, name_col: str = "label_name", lower: bool = True) -> DataFrame:
    """``label_name, label`` with label = 0-based rank of the sorted
    distinct (lower-cased) names.

    The window runs over the *distinct* names only (one row per class), so the
    single-partition ordering is over a handful of rows whatever the corpus size.
    """
    name = F.lower(F.col(name_col)) if lower else F.col(name_col)
    names = df.select(name.alias("label_name")).distinct()
    return names.select("label_name", (F.dense_rank().over(Window.orderBy("label_name")) - 1).alias("label"))


def with_label(df: DataFrame, name_col: str, index: DataFrame) -> DataFrame:
    """Attach the dense label; Spark sizes the index (one row per class) at run time."""
    keyed = df.withColumn("label_name", F.lower(F.col(name_col)))
    return keyed.join(index, "label_name", "left")


def class_index_lines(index: DataFrame) -> DataFrame:
    """``<id> <name>`` lines ordered by id."""
    return index.select(F.format_string("%d %s", F.col("label"), F.col("label_name")).alias("value"),
                        "label").orderBy("label")


def parse_class_index(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split each line once on a space; malformed lines (no space, or a
    non-integer id) are ignored; exposes the int id, the name and its
    capitalised display form."""
    parts = F.split(F.regexp_replace(F.col(col), r"^\s+|\s+$", ""), " ", 2)
    out = lines.select(parts.alias("p")).filter(F.size("p") == 2)
    out = out.select(F.expr("try_cast(p[0] AS INT)").alias("class_id"), F.col("p")[1].alias("name"))
    return out.filter(F.col("class_id").isNotNull()).select(
        "class_id", "name", S.capitalize("name").alias("display"))


def append_new(existing: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """S11 append + J3 / U2 + U1: rows of ``incoming`` whose key is not already
    stored, unioned by name onto ``existing``.  Incoming duplicates of each other
    are all kept (left anti join, never ``subtract``, which would de-duplicate).

    Only the key column of the stored corpus takes part in the anti join.
    """
    new = incoming.join(existing.select(key), key, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def hash_ids(df: DataFrame, text_col: str = "text") -> DataFrame:
    """D1 hash mode: clean first, then the id is the MD5 of the cleaned text."""
    cleaned = df.withColumn(text_col, TX.clean_text(text_col))
    return cleaned.withColumn("id", S.content_hash(text_col))


def one_hot(df: DataFrame, label_col: str = "label", n_classes: DataFrame | None = None) -> DataFrame:
    """K9: one-hot int array of length k (k = number of distinct labels).

    k arrives as a one-row aggregate joined on a constant key (a broadcast of
    one row), so the plan stays a single lazy job.
    """
    if n_classes is None:
        n_classes = df.agg(F.countDistinct(label_col).alias("_k"))
    k = n_classes.withColumn("_one", F.lit(1))
    joined = df.withColumn("_one", F.lit(1)).join(F.broadcast(k), "_one")
    vec = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda i: (i == F.col(label_col)).cast("int"))
    return joined.withColumn("one_hot", F.when(F.col("_k") > 0, vec).otherwise(F.array())).drop("_one", "_k")


def whole_labels(df: DataFrame, label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """P5: labels as integers.  Returns the rows whose label is one (blanks around it
    and a zero fraction allowed, null stays null) and the rejected rows, as they came,
    with a ``reason``; a bad label ends no job."""
    number = F.trim(F.col(label_col).cast("string")).try_cast("decimal(38,6)")
    whole = F.when(number == F.floor(number), number).try_cast("int")
    good = F.col(label_col).isNull() | whole.isNotNull()
    reason = F.when(number.isNull(), "not a number").when(number != F.floor(number), "not whole").otherwise("out of range")
    return (df.filter(good).withColumn(label_col, whole),
            df.filter(~good).withColumn("reason", reason))


def deterministic_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """P10 deterministic form: the first ``n`` rows by ``md5(seed|key)`` (a
    distributed top-n, no full sort)."""
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return df.withColumn("_o", order).orderBy("_o", key).limit(n).drop("_o")


def lookup_text(requests: DataFrame, docs: DataFrame, req_key: str, doc_key: str, pos: str) -> DataFrame:
    """Left lookup of text by key, default ''; the stored row with the
    smallest ``pos`` (its place in the stored table) wins.  Only rows with a
    requested key travel, and their texts are aggregated map-side first."""
    wanted = requests.select(F.col(req_key).alias(doc_key)).distinct()
    one = (docs.select(doc_key, pos, "text").join(wanted, doc_key, "left_semi")
           .groupBy(doc_key).agg(F.min_by("text", F.col(pos)).alias("text")))
    j = requests.join(one.withColumnRenamed(doc_key, req_key), req_key, "left")
    return j.withColumn("text", F.coalesce(F.col("text"), F.lit("")))


def to_str_or_empty(c) -> Column:
    """Any value to string, null -> ''."""
    return F.coalesce(TX.col_of(c).cast("string"), F.lit(""))
