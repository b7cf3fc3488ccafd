"""Distributions, summaries and evaluation reports.

Aggregates are partial + final hash aggregates.  Exact quartiles avoid the
``percentile`` aggregate (which buffers every value of a group in one task):
for columns of few values, such as lengths, rows are counted per (class, value)
and ranks are running sums over distinct values; for continuous columns
``radix_quantiles`` counts digits of the values.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import reliable_checkpoint


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("_one", F.lit(1))


def with_total(df: DataFrame, n_col: str = "n", out: str = "_t") -> DataFrame:
    """Attach the grand total of ``n_col`` (one-row broadcast)."""
    tot = df.agg(F.sum(n_col).alias(out))
    return _one(df).join(F.broadcast(_one(tot)), "_one").drop("_one")


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """A1."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def class_share(df: DataFrame, label: str = "label") -> DataFrame:
    """A2: share of all rows, percent."""
    c = with_total(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    return c.select(label, "n", (F.col("n") * 100.0 / F.col("_t")).alias("pct"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """A3: balanced weights ``N / (K * n_c)`` keyed by the dense class index."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("_N"), F.count(F.lit(1)).alias("_K"))
    j = _one(c).join(F.broadcast(_one(tot)), "_one")
    # K rows: the unpartitioned window is over one row per class
    return j.select(label, (F.row_number().over(Window.orderBy(label)) - 1).alias("class_index"), "n",
                    (F.col("_N") / (F.col("_K") * F.col("n"))).alias("weight"))


def value_counts(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """``_g, _v, _n``: rows per (class, value); nulls are left out."""
    base = df.select((F.col(group) if group else F.lit(0)).alias("_g"), F.col(value).cast("double").alias("_v"))
    return base.filter(F.col("_v").isNotNull()).groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n"))


def _quantiles(counts: DataFrame, probs: list[float]) -> DataFrame:
    """Per ``_g``: ``q<p>`` by linear interpolation between the two ranks around p."""
    w = Window.partitionBy("_g")
    first = F.coalesce(F.sum("_n").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = counts.select("_g", "_v", first.alias("_first"), (first + F.col("_n")).alias("_end"),
                      F.sum("_n").over(w).alias("_t"))

    def at(rank):  # the value that holds this rank
        return F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_end")), F.col("_v")))

    picked = []
    for p in probs:
        pos = F.lit(p) * (F.col("_t") - 1)
        picked += [at(F.floor(pos)).alias(f"_lo{p}"), at(F.ceil(pos)).alias(f"_hi{p}"),
                   F.max(pos - F.floor(pos)).alias(f"_f{p}")]
    q = c.groupBy("_g").agg(*picked)
    return q.select("_g", *[(F.col(f"`_lo{p}`") + (F.col(f"`_hi{p}`") - F.col(f"`_lo{p}`")) * F.col(f"`_f{p}`"))
                            .alias(f"q{round(p * 100):d}") for p in probs])


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles (numpy / pandas default), exact.

    Returns one row per group with ``q<p>`` columns (e.g. ``q25``)."""
    out = _quantiles(value_counts(df, value, group), probs)
    return out.withColumnRenamed("_g", group) if group else out.drop("_g")


#: Bits of a digit of the radix selection; 64 are a whole number of them.
DIGIT = 16


@F.pandas_udf(T.LongType())
def _to_key(v: pd.Series) -> pd.Series:
    """The bits of a double, in an order of signed integers that is the order of
    the values; -0.0 is 0.0, and NaN comes last."""
    bits = (v.to_numpy(np.float64, na_value=np.nan) + 0.0).view(np.int64)
    bits = np.where(np.isnan(v.to_numpy(np.float64, na_value=np.nan)), np.int64(0x7FF8 << 48), bits)
    return pd.Series(bits ^ ((bits >> 63) & np.int64(2 ** 63 - 1)))


@F.pandas_udf(T.DoubleType())
def _to_value(key: pd.Series) -> pd.Series:
    bits = key.to_numpy(np.int64)
    return pd.Series((bits ^ ((bits >> 63) & np.int64(2 ** 63 - 1))).view(np.float64))


def _prefix(key, digits: int):
    """The first ``digits`` digits; 0 for none (a shift by 64 would be one by none)."""
    return F.shiftright(key, 64 - DIGIT * digits) if digits else F.lit(0).cast("long")


def radix_quantiles(df: DataFrame, value: str, probs: list[float], group: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles (numpy / pandas default), exact, of a
    continuous column: one row per group with ``q<p>`` columns.

    Radix selection over the order-preserving bits of the doubles: a round
    counts the next digit of the rows whose digits so far are those of a wanted
    rank, and keeps of each such bucket the one digit that holds the rank.  A
    bucket has at most 65,536 digits, however many values there are, and a hot
    value is one count.  No value is sorted, and none is in a window."""
    base = df.select((F.col(group) if group else F.lit(0)).alias("_g"), F.col(value).cast("double").alias("_v"))
    keys = base.filter(F.col("_v").isNotNull()).select("_g", _to_key("_v").alias("_k"))
    sizes = keys.groupBy("_g").agg(F.count(F.lit(1)).alias("_t"))
    ranks = F.array_distinct(F.array(*[f(F.lit(p) * (F.col("_t") - 1)).cast("long") for p in probs for f in (F.floor, F.ceil)]))
    wanted = sizes.select("_g", "_t", F.explode(ranks).alias("_rank")).withColumns(
        {"_left": F.col("_rank"), "_found": F.lit(0).cast("long")})
    for digits in range(64 // DIGIT):
        wanted = reliable_checkpoint(wanted)  # one row per group and rank
        buckets = wanted.select(F.col("_g").alias("_bg"), "_found").distinct()
        inside = keys.withColumn("_found", _prefix("_k", digits))
        inside = inside.join(buckets.withColumnRenamed("_found", "_bf"), F.col("_g").eqNullSafe(F.col("_bg")) & (F.col("_found") == F.col("_bf")),
                             "left_semi")
        counts = inside.groupBy("_g", "_found", _prefix("_k", digits + 1).alias("_next")).agg(F.count(F.lit(1)).alias("_n"))
        # within a bucket the next prefix ascends with the digit; of the first digit all groups' values may be negative
        before = F.coalesce(F.sum("_n").over(Window.partitionBy("_g", "_found").orderBy("_next")
                                             .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.select(F.col("_g").alias("_cg"), F.col("_found").alias("_cf"), "_next", "_n", before.alias("_before"))
        held = (F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_n"))
        wanted = (wanted.join(counts, F.col("_g").eqNullSafe(F.col("_cg")) & (F.col("_found") == F.col("_cf")) & held)
                  .select("_g", "_t", "_rank", (F.col("_left") - F.col("_before")).alias("_left"), F.col("_next").alias("_found")))
    values = wanted.select("_g", "_t", "_rank", _to_value("_found").alias("_v"))
    picked = []
    for p in probs:
        pos = F.lit(p) * (F.col("_t") - 1)
        picked += [F.max(F.when(F.col("_rank") == f(pos), F.col("_v"))).alias(f"_{n}{p}") for n, f in (("lo", F.floor), ("hi", F.ceil))]
        picked.append(F.max(pos - F.floor(pos)).alias(f"_f{p}"))
    q = values.groupBy("_g").agg(*picked)
    lo, hi, part = ((lambda p, n=n: F.col(f"`_{n}{p}`")) for n in ("lo", "hi", "f"))
    # equal neighbours need no arithmetic, which infinite ones would not survive
    out = q.select("_g", *[F.when(lo(p) == hi(p), lo(p)).otherwise(lo(p) + (hi(p) - lo(p)) * part(p)).alias(f"q{round(p * 100):d}") for p in probs])
    return out.withColumnRenamed("_g", group) if group else out.drop("_g")


def describe_amount(df: DataFrame, value: str) -> DataFrame:
    """A4 for a continuous column: as ``describe_length``, by radix selection."""
    return _described(df, value, radix_quantiles(df, value, [0.25, 0.5, 0.75]))


def amounts_by_class(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    """A5 for a continuous column: as ``five_numbers_by_class``, by radix
    selection and one more pass for what lies inside the fences."""
    q = radix_quantiles(df, value, [0.25, 0.5, 0.75], label)
    rows = df.select(F.col(label).alias("_g"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    fences = _fences(q.withColumnRenamed(label, "_bg"))
    j = rows.join(fences, F.col("_g").eqNullSafe(F.col("_bg"))).withColumn("_n", F.lit(1))
    return _five_numbers(j, label)


def describe_length(df: DataFrame, value: str) -> DataFrame:
    """A4: count, mean, sample std, min, quartiles, max of a column of few values."""
    return _described(df, value, exact_quantiles(df, value, [0.25, 0.5, 0.75]))


def _described(df: DataFrame, value: str, q: DataFrame) -> DataFrame:
    stats = df.agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                   F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"))
    return _one(stats).join(F.broadcast(_one(q)), "_one").select(
        "count", "mean", "std", "min", F.col("q25").alias("p25"), F.col("q50").alias("p50"),
        F.col("q75").alias("p75"), "max")


def five_numbers_by_class(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    """A5: per class min, quartiles, max and the 1.5 IQR whisker ends (the data
    behind a box plot): whiskers reach the furthest value inside the fences."""
    v = value_counts(df, value, label)
    return _five_numbers(v.join(_fences(_quantiles(v, [0.25, 0.5, 0.75])), "_g"), label)


def _fences(q: DataFrame) -> DataFrame:
    iqr = F.col("q75") - F.col("q25")
    return q.withColumns({"_low": F.col("q25") - 1.5 * iqr, "_high": F.col("q75") + 1.5 * iqr})


def _five_numbers(j: DataFrame, label: str) -> DataFrame:
    """From ``_g``, ``_v``, ``_n`` (rows of this value), the quartiles and the fences."""
    out = (F.col("_v") < F.col("_low")) | (F.col("_v") > F.col("_high"))
    agg = j.groupBy("_g", "q25", "q50", "q75").agg(
        F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.min(F.when(F.col("_v") >= F.col("_low"), F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(F.col("_v") <= F.col("_high"), F.col("_v"))).alias("whisker_hi"),
        F.sum(F.when(out, F.col("_n")).otherwise(0)).alias("n_outliers"))
    return agg.select(F.col("_g").alias(label), "min", "q25", "q50", "q75", "max", "whisker_lo", "whisker_hi", "n_outliers")


def null_counts(df: DataFrame) -> DataFrame:
    """One row, a null count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def pair_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(truth, prediction, n): the K x K table every evaluation report reads."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list) -> DataFrame:
    """rows = truth, one column per predicted class (explicit pivot values,
    so no extra job to discover them), zeros filled."""
    p = pair_counts(df, label, pred)
    wide = p.groupBy("label").pivot("prediction", classes).agg(F.sum("n"))
    for c in classes:
        wide = wide.withColumnRenamed(str(c), f"pred_{c}")
    return wide.na.fill(0)


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision / recall / f1 / support per class (classes = truth and
    predicted values), accuracy, macro and weighted averages; 0 when a
    denominator is 0."""
    return report_of_pairs(pair_counts(df, label, pred))


def report_of_pairs(p: DataFrame) -> DataFrame:
    """A9 from the K x K table (label, prediction, n)."""
    truth = p.groupBy("label").agg(F.sum("n").alias("support"))
    predicted = p.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("n_pred"))
    tp = p.filter(F.col("label") == F.col("prediction")).select("label", F.col("n").alias("tp"))
    classes = truth.select("label").union(predicted.select("label")).distinct()
    c = (classes.join(truth, "label", "left").join(predicted, "label", "left").join(tp, "label", "left")
         .na.fill(0, ["support", "n_pred", "tp"]))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    c = c.select("label", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    c = c.withColumn("f1", f1)
    per_class = c.select(F.col("label").cast("string").alias("class"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    tot = c.agg(F.sum("support").alias("N"), F.sum("tp").alias("TP"), F.count(F.lit(1)).alias("K"),
                F.sum("precision").alias("sp"), F.sum("recall").alias("sr"), F.sum("f1").alias("sf"),
                F.sum(F.col("precision") * F.col("support")).alias("wp"),
                F.sum(F.col("recall") * F.col("support")).alias("wr"),
                F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("TP") / F.col("N")).alias("f1"),
                     F.col("N").cast("long").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("class"), (F.col("sp") / F.col("K")).alias("precision"),
                       (F.col("sr") / F.col("K")).alias("recall"), (F.col("sf") / F.col("K")).alias("f1"),
                       F.col("N").cast("long").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("N")).alias("precision"),
                          (F.col("wr") / F.col("N")).alias("recall"), (F.col("wf") / F.col("N")).alias("f1"),
                          F.col("N").cast("long").alias("support"))
    return per_class.unionByName(acc).unionByName(macro).unionByName(weighted)


def binary_outcomes(df: DataFrame, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """Per (name, truth, prediction) column pair TP / FP / FN / TN and
    accuracy - one pass, conditional sums."""
    aggs = []
    for name, t, p in pairs:
        tt, pp = F.col(t) == 1, F.col(p) == 1
        aggs += [F.count_if(tt & pp).alias(f"{name}__tp"), F.count_if(~tt & pp).alias(f"{name}__fp"),
                 F.count_if(tt & ~pp).alias(f"{name}__fn"), F.count_if(~tt & ~pp).alias(f"{name}__tn")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"{name}__tp").alias("tp"),
                              F.col(f"{name}__fp").alias("fp"), F.col(f"{name}__fn").alias("fn"),
                              F.col(f"{name}__tn").alias("tn")) for name, _, _ in pairs])
    long = wide.select(F.explode(rows).alias("r")).select("r.*")
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return long.withColumn("accuracy", F.when(total > 0, (F.col("tp") + F.col("tn")) / total))


def run_stats(results: DataFrame, class_col: str = "classification", error_col: str = "error") -> DataFrame:
    """Count and percent (1 decimal) per predicted class - errors are
    left out of the classes but counted in the denominator - plus the error
    row."""
    tagged = results.select(F.when(F.col(error_col).isNotNull(), F.lit("Error"))
                            .otherwise(F.col(class_col)).alias("classification"))
    c = with_total(tagged.groupBy("classification").agg(F.count(F.lit(1)).alias("n")))
    return c.select("classification", "n", F.round(F.col("n") * 100.0 / F.col("_t"), 1).alias("pct"))
