"""Names of organisations by a trained sequence tagger.

A structured perceptron over tokens (tags: outside, begin, inside) with Viterbi
decoding.  It learns from names that are known without a reader: those a
company suffix gives away (rule ``ORG_RULE``) and those a column gives.  The
suffix is taken off a second copy of each example, so that the words around a
name have to carry it, and names without a suffix are found.

Training is iterative parameter mixing: in every pass each partition goes
through its sentences from the mixed weights of the pass before, the changes
are summed by weight in Spark, and the driver holds the weights alone (hashed
features x tags, a fixed size).  It reads at most ``FIT_ROWS`` rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.extract import ORG_RULE
from quire.functions.text import col_of
from quire.operators.models import fit_sample
from quire.session import reliable_checkpoint

#: Labelled texts a fit reads at most.
FIT_ROWS = 50_000
#: Hashed features; weights are this many times three tags.
FEATURES = 1 << 18
PASSES = 6
#: Tokens tagged together; longer texts are cut there (and every token is tagged).
SPAN = 400
OUT, BEGIN, INSIDE = 0, 1, 2
SUFFIX = r" +(?:Inc|LLC|Ltd|GmbH|Co|Corp|SA|SARL|AG|BV|PLC)\.?$"
_TOKEN = re.compile(r"[^\W_](?:[\w&'#-]*[^\W_])?|[^\w\s]|_")


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def _shape(word: str) -> str:
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c for c in word[:12])
    return re.sub(r"(.)\1+", r"\1", kinds)


def features_of(words: list[str]) -> np.ndarray:
    """Hashed features, one row per word."""
    low, shapes = [w.lower() for w in words], [_shape(w) for w in words]
    edge = ["^^", "^", *low, "$", "$$"]
    shaped = ["^", *shapes, "$"]
    rows = []
    for k, w in enumerate(low):
        before2, before, after, after2 = edge[k], edge[k + 1], edge[k + 3], edge[k + 4]
        names = ("bias", f"w {w}", f"s {shapes[k]}", f"e {w[-3:]}", f"b {before}", f"bb {before2} {before}", f"a {after}", f"aa {after} {after2}",
                 f"bs {before} {shapes[k]}", f"as {shapes[k]} {after}", f"sss {shaped[k]} {shapes[k]} {shaped[k + 2]}")
        rows.append([zlib.crc32(n.encode()) % FEATURES for n in names])
    return np.array(rows, np.int64).reshape(len(words), -1)


#: A name goes on only where one has begun.
_ALLOWED = np.zeros((3, 3))
_ALLOWED[OUT, INSIDE] = -np.inf


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags for scores (words by tags) and moves (tag to tag)."""
    n = len(scores)
    moves = moves + _ALLOWED
    back = np.zeros((n, 3), np.int8)
    best = scores[0].copy()
    best[INSIDE] = -np.inf
    for k in range(1, n):
        ways = best[:, None] + moves
        back[k] = ways.argmax(0)
        best = ways.max(0) + scores[k]
    tags = np.empty(n, np.int8)
    tags[-1] = best.argmax()
    for k in range(n - 1, 0, -1):
        tags[k - 1] = back[k, tags[k]]
    return tags


@dataclass
class Tagger:
    """``weights`` (features by tags) and ``moves`` (tag to tag)."""

    weights: np.ndarray
    moves: np.ndarray

    def tag(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the names of a text, in its order."""
        spans, found = tokens_of(text), []
        words = [text[a:b] for a, b in spans]
        for at in range(0, len(words), SPAN):
            tags = viterbi(self.weights[features_of(words[at:at + SPAN])].sum(1), self.moves)
            for k, tag in enumerate(tags.tolist(), at):
                if tag == BEGIN:
                    found.append(list(spans[k]))
                elif tag == INSIDE:
                    found[-1][1] = spans[k][1]
        return [tuple(f) for f in found]


def _gold(text: str, names: list[str]) -> tuple[list[str], np.ndarray]:
    """Words and tags of a text whose names are known (every occurrence)."""
    spans = tokens_of(text)
    tags = np.zeros(len(spans), np.int8)
    starts, ends = {a: k for k, (a, _) in enumerate(spans)}, {b: k for k, (_, b) in enumerate(spans)}
    for name in sorted(filter(None, names), key=len):  # a longer name is tagged over a shorter one in it
        at = text.find(name)
        while at >= 0:
            if at in starts and at + len(name) in ends:
                first, last = starts[at], ends[at + len(name)]
                tags[first:last + 1] = INSIDE
                tags[first] = BEGIN
            at = text.find(name, at + 1)
    return [text[a:b] for a, b in spans], tags


def labelled(df: DataFrame, text: str, name_cols: list[str]) -> DataFrame:
    """``text`` and ``names`` of the rows with a known name, and each with the
    company suffix taken off its rule-found name."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = F.transform(F.regexp_extract_all(t, F.lit(ORG_RULE), F.lit(1)), lambda x: F.trim(x))
    given = F.array(*[F.col(c) for c in name_cols]) if name_cols else F.array().cast("array<string>")
    rows = df.select(t.alias("text"), found.alias("found"), F.filter(given, lambda x: x.isNotNull() & (x != "")).alias("given"))
    rows = rows.filter((F.size("found") > 0) | (F.size("given") > 0))
    # names go one by one, the longest first
    order = F.array_sort(F.array_distinct("found"), lambda a, b: F.length(b) - F.length(a))
    bare = F.aggregate(order, F.col("text"), lambda acc, x: F.replace(acc, x, F.regexp_replace(x, SUFFIX, "")))
    stripped = F.transform("found", lambda x: F.regexp_replace(x, SUFFIX, ""))
    return (rows.select("text", F.concat("found", "given").alias("names"))
            .unionByName(rows.filter(F.size("found") > 0).select(bare.alias("text"), F.concat(stripped, "given").alias("names"))))


def train(df: DataFrame, text: str = "text", name_cols: list[str] = (), passes: int = PASSES, rows: int = FIT_ROWS) -> Tagger:
    """Fit on the rows of ``df`` whose names the suffix rule or ``name_cols`` tell."""
    data = reliable_checkpoint(fit_sample(labelled(df, text, list(name_cols)), "text", rows))
    size = FEATURES * 3 + 9
    weights, total = np.zeros(size), np.zeros(size)
    for number in range(passes):
        given = df.sparkSession.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = given.value.copy()
            emission, moves = w[:-9].reshape(FEATURES, 3), w[-9:].reshape(3, 3)
            steps, drift = 0, np.zeros(size)  # changes times the step they came at, for the average
            drift_e, drift_m = drift[:-9].reshape(FEATURES, 3), drift[-9:].reshape(3, 3)
            for batch in batches:
                for body, names in zip(batch.column("text").to_pylist(), batch.column("names").to_pylist(), strict=True):
                    words, gold = _gold(body, names)
                    for at in range(0, len(words), SPAN):
                        steps += 1
                        tags = gold[at:at + SPAN]
                        rows_of = features_of(words[at:at + SPAN])
                        guess = viterbi(emission[rows_of].sum(1), moves)
                        for k in np.flatnonzero(tags != guess):
                            for tag, sign in ((tags[k], 1.0), (guess[k], -1.0)):
                                np.add.at(emission[:, tag], rows_of[k], sign)
                                np.add.at(drift_e[:, tag], rows_of[k], sign * steps)
                        for way, sign in ((tags, 1.0), (guess, -1.0)):
                            np.add.at(moves, (way[:-1], way[1:]), sign)
                            np.add.at(drift_m, (way[:-1], way[1:]), sign * steps)
            if steps:
                change, mean = w - given.value, w - given.value - drift / (steps + 1)
                touched = np.flatnonzero((change != 0) | (mean != 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(touched, -1)), pa.array(np.append(change[touched], 1.0)), pa.array(np.append(mean[touched], 0.0))],
                    names=["at", "change", "mean"])

        # one row per weight that changed; number -1 counts the partitions
        sums = data.mapInArrow(learn, "at bigint, change double, mean double").groupBy("at").agg(
            F.sum("change").alias("change"), F.sum("mean").alias("mean")).toPandas()
        parts = float(sums.loc[sums["at"] == -1, "change"].sum())
        if not parts:
            break
        sums = sums[sums["at"] >= 0]
        total += weights
        total[sums["at"]] += sums["mean"] / parts
        weights = weights.copy()
        weights[sums["at"]] += sums["change"] / parts
        given.unpersist()
    return Tagger(total[:-9].reshape(FEATURES, 3) / passes, total[-9:].reshape(3, 3) / passes)


def names_udf(tagger: Tagger):
    """A column function: text to its names, in order, each occurrence."""
    def names(rows):
        return rows.map(lambda x: [x[a:b] for a, b in tagger.tag(x)] if x else [])

    return F.pandas_udf(names, T.ArrayType(T.StringType()))


def first_name(text, tagger: Tagger) -> Column:
    """The first organisation of a text, '' becomes null."""
    return F.get(names_udf(tagger)(col_of(text)), F.lit(0))


def name_words(text, tagger: Tagger) -> Column:
    """The distinct words of all names of a text."""
    return F.array_distinct(F.flatten(F.transform(names_udf(tagger)(col_of(text)), lambda n: F.split(n, r"\s+"))))
