"""Seeded and stratified splits.

Order inside a split decision is ``md5(seed|id)``: independent of the
partitioning, reproducible in SQL, and uniform.  So rows are counted per class
and first hash digits; a cut falls into one such bucket, every other bucket
lies whole on one side of it, and only the rows of the cut buckets (one in
65,536 per cut) are ranked.  No global sort, no checkpoint, and a class of any
size is spread over its buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")


def seeded_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def check_fractions(*fractions: float) -> None:
    """The parts must sum to 1 (float tolerance, as ``numpy.isclose``)."""
    total = sum(fractions)
    if not math.isclose(total, 1.0, rel_tol=1e-05, abs_tol=1e-08):
        raise ValueError("Split proportions must sum to 1.0")


#: Hash digits that name a bucket: 16 ** 4 buckets per class.
BUCKET_DIGITS = 4


def _cut(df: DataFrame, cuts: DataFrame, key: str, seed: int, names: tuple[str, str, str]) -> DataFrame:
    """``df`` (with a class column ``_c``) and its split: rows of a class, in
    hash order, before rank ``_cut1`` get the first name, before ``_cut2`` the
    second, others the third.  ``cuts`` has one row per class; null is a class.
    Of a class one row is broadcast: the last buckets that begin before the cuts,
    and those that a cut falls into.  So rows stay where they are, but for the cut buckets'."""
    rows = df.withColumn("_h", seeded_order(key, seed)).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    buckets = rows.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)))

    def same(x, y):
        return x["_c"].eqNullSafe(y["_c"])

    buckets = buckets.join(cuts, same(buckets, cuts)).select(buckets["_c"].alias("_bc"), "_b", "_n", "_at", "_cut1", "_cut2")
    ends = []
    for i in (1, 2):
        cut = F.col(f"_cut{i}")
        inside = (F.col("_at") < cut) & (cut < F.col("_at") + F.col("_n"))
        ends += [F.max(F.when(F.col("_at") < cut, F.col("_b"))).alias(f"_last{i}"), F.max(F.when(inside, F.col("_b"))).alias(f"_in{i}"),
                 F.max(F.when(inside, F.col("_at"))).alias(f"_at{i}"), F.max(cut).alias(f"_cut{i}")]
    ends = buckets.groupBy("_bc").agg(*ends)
    placed = rows.filter(F.col("_h").isNotNull()).join(F.broadcast(ends), rows["_c"].eqNullSafe(F.col("_bc")))
    placed = placed.withColumn("_mixed", F.coalesce(F.col("_b") == F.col("_in1"), F.lit(False)) | F.coalesce(F.col("_b") == F.col("_in2"), F.lit(False)))
    at = F.when(F.col("_b") == F.col("_in1"), F.col("_at1")).otherwise(F.col("_at2"))
    rank = at + F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_h", F.col(key).cast("string"))) - 1
    columns = [c for c in df.columns if c != "_c"]
    whole = F.when(F.col("_b") <= F.col("_last1"), names[0]).when(F.col("_b") <= F.col("_last2"), names[1]).otherwise(names[2])
    ranked = F.when(F.col("_r") < F.col("_cut1"), names[0]).when(F.col("_r") < F.col("_cut2"), names[1]).otherwise(names[2])
    return (placed.filter(~F.col("_mixed")).select(*columns, whole.alias("split"))
            .unionByName(placed.filter("_mixed").withColumn("_r", rank).select(*columns, ranked.alias("split"))))


def split_701515(df: DataFrame, key: str = "id", seed: int = 42,
                 first: float = 0.7, second: float = 0.85) -> DataFrame:
    """Seeded shuffle cut at ``int(0.7 N)`` and ``int(0.85 N)`` -> train /
    valid / test."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    cuts = n.select(F.lit(0).alias("_c"), F.floor(F.col("_n") * first).alias("_cut1"),
                    F.floor(F.col("_n") * second).alias("_cut2"))
    return _cut(df.withColumn("_c", F.lit(0)), cuts, key, seed, ("train", "valid", "test"))


def _largest_remainder(counts: DataFrame, label: str, n_col: str, total_take: Column, out: str) -> DataFrame:
    """Per-class quota summing exactly to ``total_take``: floor of the share,
    the remainder to the largest fractions, ties by label.  ``counts`` has one
    row per class, so the unpartitioned windows run over K rows."""
    w_all = Window.partitionBy()
    share = total_take * F.col(n_col) / F.sum(n_col).over(w_all)
    base = F.floor(share)
    c = counts.withColumn("_share", share).withColumn("_base", base)
    c = c.withColumn("_left", (total_take - F.sum("_base").over(w_all)))
    order = Window.orderBy(F.desc(F.col("_share") - F.col("_base")), F.col(label))
    c = c.withColumn("_rk", F.row_number().over(order))
    return c.withColumn(out, (F.col("_base") + F.when(F.col("_rk") <= F.col("_left"), 1).otherwise(0)).cast("long")) \
            .drop("_share", "_base", "_left", "_rk")


def stratified_split(df: DataFrame, label: str = "label", key: str = "id", train: float = 0.8,
                     test: float = 0.1, validation: float = 0.1, seed: int = 42) -> DataFrame:
    """Cut the test part first (``ceil(test N)`` rows), then split the rest
    by ``validation / (train + validation)`` (``ceil`` again), each with
    per-class largest-remainder quotas; inside a class rows go in
    ``md5(seed|id)`` order: test quota, validation quota, then train.  Rows
    without a label are a class like any other."""
    check_fractions(train, test, validation)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    w_all = Window.partitionBy()
    n_test = F.ceil(F.lit(test) * F.sum("_nc").over(w_all))
    q = _largest_remainder(counts, label, "_nc", n_test, "_qt")
    q = q.withColumn("_rest", F.col("_nc") - F.col("_qt"))
    ratio = validation / (train + validation) if (train + validation) > 0 else 0.0
    n_val = F.ceil(F.lit(ratio) * F.sum("_rest").over(w_all))
    q = _largest_remainder(q, label, "_rest", n_val, "_qv")
    cuts = q.select(F.col(label).alias("_c"), F.col("_qt").alias("_cut1"), (F.col("_qt") + F.col("_qv")).alias("_cut2"))
    return _cut(df.withColumn("_c", F.col(label)), cuts, key, seed, ("test", "validation", "train"))


def stratified_holdout(df: DataFrame, fraction: float = 0.1, label: str = "label", key: str = "id",
                       seed: int = 42) -> DataFrame:
    """A stratified validation hold-out (two parts: train / validation)."""
    out = stratified_split(df, label, key, train=1.0 - fraction, test=0.0, validation=fraction, seed=seed)
    return out


def split_members(df: DataFrame, names: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is in a split's name list (left semi join)."""
    return df.join(names.select(key), key, "left_semi")


def split_report(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split and their share of all rows (percent, 1 decimal)."""
    per = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n").alias("_t")).withColumn("_one", F.lit(1))
    out = per.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return out.select(split_col, "n", F.round(F.col("n") * 100.0 / F.col("_t"), 1).alias("pct"))
