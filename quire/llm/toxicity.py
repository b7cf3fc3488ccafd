"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts train a linear numpy classifier.
The risk of the negative class is estimated from the unlabelled texts, less
the share that the class prior says is positive, and kept from falling below
zero: R = prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), with the sigmoid
loss.  When the bracket is negative, the step goes against it instead.

Features are words (runs without white space, A-Z lowered, punctuation
stripped at the ends) and their first bytes, hashed into ``FEATURES`` buckets;
a text has a bucket or not.  The fit takes at most ``MAX_POSITIVE`` and
``MAX_UNLABELLED`` texts, drawn by a hash of the text, and the buckets that
stand out among the positives.  Scoring is one pass over all rows with the
weights (a fixed number) broadcast.

Edge cases: a null or empty text has no words and scores by the bias alone;
texts of any length are read whole; null labels count as no label; repeated
rows are scored each; without positive training rows every score is 0; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import staged, tidy
from quire.llm.words import Words, portions

FEATURES = 1 << 20
#: Lengths in bytes of the word beginnings that are features beside the word.
BEGINNINGS = (4, 5)
#: Bounds of the fit's sample in texts, and of its buckets.
MAX_POSITIVE, MAX_UNLABELLED, MAX_KEPT = 4_000, 12_000, 4_000
#: A bucket of the fit is in this many positives, and this many standard errors above its rate in all texts.
MIN_TEXTS, MIN_Z = 3, 5.0
STEPS, RATE, DECAY = 600, 0.05, 1e-4


def buckets(texts: list[str | None], wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Portion by portion: first text, number of texts, and (text, bucket) of
    every distinct bucket of every text, in order, texts counted from the first;
    with ``wanted`` (a mask over buckets) of those alone."""
    for first, buffer, bounds in portions(texts):
        words = Words(buffer, strip=True)
        rows = np.searchsorted(bounds, words.starts, "right") - 1
        size = words.ends - words.starts
        found = []
        for length in (None, *BEGINNINGS):
            long = slice(None) if length is None else np.flatnonzero(size > length)
            starts = words.starts[long]
            hashes = words.hashes(starts, words.ends if length is None else starts + length)
            # a beginning is another feature than the word of the same letters
            column = ((hashes + np.uint64(length or 0)) & np.uint64(FEATURES - 1)).astype(np.int64)
            key = (rows[long] << 32) | column
            found.append(key if wanted is None else key[wanted[column]])
        key = np.unique(np.concatenate(found))
        yield first, len(bounds) - 1, key >> 32, key & 0xFFFFFFFF


@dataclass
class Model:
    weight: np.ndarray  # of every bucket
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        margins = [np.bincount(rows, self.weight[columns], n) for _, n, rows, columns in buckets(texts, self.weight != 0)]
        return sigmoid(np.concatenate([np.empty(0), *margins]) + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(positive: list[list[int]], unlabelled: list[list[int]], prior: float, steps: int = STEPS) -> Model:
    """A linear model over the buckets that the texts hold (a list each)."""
    weight = np.zeros(FEATURES, np.float64)
    if not positive or not unlabelled:
        return Model(weight, -60.0)
    sides = [(np.repeat(np.arange(len(side)), [len(x) for x in side]), np.array([b for x in side for b in x], np.int64), len(side))
             for side in (positive, unlabelled)]
    used, column = np.unique(np.concatenate([b for _, b, _ in sides]), return_inverse=True)
    split = len(sides[0][1])
    cells = (column[:split], column[split:])
    w = np.zeros(len(used) + 1)  # the last one is the bias
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p, u = (np.bincount(owner, w[c], n) + w[-1] for (owner, _, n), c in zip(sides, cells, strict=True))
        # sigmoid loss of label y: sigmoid(-y * margin); its slope is -y * s * (1 - s)
        slope_p, slope_u = sigmoid(p) * sigmoid(-p) / len(p), sigmoid(u) * sigmoid(-u) / len(u)
        rest = sigmoid(u).mean() - prior * sigmoid(p).mean()
        g_p, g_u = (-2 * prior * slope_p, slope_u) if rest >= 0 else (prior * slope_p, -slope_u)
        gradient = DECAY * w
        for (owner, _, _), c, g in zip(sides, cells, (g_p, g_u), strict=True):
            gradient[:-1] += np.bincount(c, g[owner], len(used))
            gradient[-1] += g.sum()
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient ** 2
        w -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    weight[used] = w[:-1]
    return Model(weight, float(w[-1]))


def _buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, n, rows, columns in buckets(batch.column("text").to_pylist()):
            ends = np.cumsum(np.bincount(rows, minlength=n))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(columns, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(first, n) for c in ("place", "positive", "unlabelled")), lists],
                names=["place", "positive", "unlabelled", "buckets"])


def train(docs: DataFrame, labels: DataFrame, may_learn, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """``may_learn(id column)`` names the rows whose labels may be used.  Toxic
    rows among them are the positives; the unlabelled sample is drawn from all
    rows without regard to labels; only the prior (the share of toxic among
    labelled rows) uses the clean labels."""
    known = (labels.filter(F.col(label_col).isNotNull() & may_learn(F.col(id_col)))
             .groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("toxic")))
    prior = known.agg(F.avg("toxic").alias("p")).first()["p"] or 0.0
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).filter("length(text) > 0")
    # narrow rows decide the sample: one of equal texts, in the order of the texts' hashes
    texts = (rows.select("key", F.xxhash64("text").alias("place")).join(known, "key", "left").groupBy("place")
             .agg(F.min("key").alias("first"), F.min(F.when(F.col("toxic") == 1, F.col("key"))).alias("toxic_key")))
    positives = texts.filter("toxic_key IS NOT NULL").orderBy("place").limit(MAX_POSITIVE)
    others = texts.orderBy("place").limit(MAX_UNLABELLED)
    picked = (positives.select("place", F.col("toxic_key").alias("key"), F.lit(1).alias("positive"), F.lit(0).alias("unlabelled"))
              .unionByName(others.select("place", F.coalesce("toxic_key", "first").alias("key"),
                                         F.lit(0).alias("positive"), F.lit(1).alias("unlabelled")))
              .groupBy("place").agg(F.max("key").alias("key"), F.max("positive").alias("positive"),
                                    F.max("unlabelled").alias("unlabelled")))
    held = staged(rows.join(F.broadcast(picked), "key").dropDuplicates(["place"])  # at most the sample's bound
                  .mapInArrow(_buckets_of, "place bigint, positive int, unlabelled int, buckets array<int>"))
    sizes = held.agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u")).first()
    if not sizes["p"] or not sizes["u"]:
        return fit([], [], prior)
    rate = (F.col("u") + 1) / F.lit(sizes["u"] + 2)
    z = (F.col("p") / F.lit(sizes["p"]) - rate) / F.sqrt(rate * (1 - rate) / F.lit(sizes["p"]))
    kept = (held.select("positive", "unlabelled", F.explode("buckets").alias("b")).groupBy("b")
            .agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
            .filter((F.col("p") >= MIN_TEXTS) & (z >= MIN_Z)).orderBy(z.desc(), "b").limit(MAX_KEPT))
    keep = {r["b"] for r in kept.select("b").collect()}
    wanted = F.array(*(F.lit(b) for b in sorted(keep))).cast("array<int>")
    sample = sorted(held.select("place", "positive", "unlabelled", F.array_intersect("buckets", wanted).alias("b")).collect(),
                    key=lambda r: r["place"])  # at most the sample's bound, few buckets each
    return fit([r["b"] for r in sample if r["positive"]], [r["b"] for r in sample if r["unlabelled"]], prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>`` and ``score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*shared.value)
        for batch in batches:
            scores = fitted.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col))


def drop(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that score below ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # a fixed number of weights
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array(fitted.score(batch.column(at).to_pylist()) < least, pa.bool_()))

    return docs.mapInArrow(tidy(run), T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]))


def fold_of(key: Column) -> Column:
    """crc32(the identifier as text) mod 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5))
