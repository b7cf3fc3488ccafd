"""Sentence borders with abbreviations learned from the corpus (K1).

A word is an abbreviation if it stands with a full stop far more often than
chance has it: the log-likelihood ratio of "the stop belongs to the word" (99 %
of its uses) against "stops fall on words at random", weighted by the word's
length, its inner stops and its uses without one (Kiss and Strunk, 2006,
unsupervised multilingual sentence boundary detection).  The counts are
aggregates over all tokens; what passes is a small table.

A full stop of such a word does not end a sentence.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.keywords import SENT_MARK, sentences
from quire.functions.text import col_of
from quire.session import staged

#: Score from which a word is an abbreviation.
THRESHOLD = 0.3
#: Abbreviations that workers may hold, of at most some dozen characters each.
HELD = 1_000_000
_LEADING, _TRAILING = r"^[(\[{\"'«“‘]+", r"[)\]}\"'»”’,;:!?]+$"
#: A type that can be an abbreviation: letters, with inner stops or without.
_WORD = r"^\p{L}(\.?\p{L})*$"


def token(raw) -> Column:
    """A whitespace token in lower case without the punctuation around it, but with its full stop."""
    return F.lower(F.regexp_replace(F.regexp_replace(col_of(raw), _LEADING, ""), _TRAILING, ""))


def abbreviation_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """``word``, ``with_stop``, ``without_stop`` and ``score`` of every type of
    letters (inner stops allowed) that stands with a full stop somewhere."""
    # counted as they stand first: the patterns see every form once, not every use of it
    raw = df.select(F.explode_outer(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+")).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    tokens = raw.select(token("raw").alias("t"), "n")
    stop = F.col("t").endswith(".")
    counts = (tokens.filter(F.col("t") != "").select(F.regexp_replace("t", r"\.$", "").alias("word"), stop.alias("stop"), "n")
              .groupBy("word").agg(F.sum(F.when(F.col("stop"), F.col("n")).otherwise(0)).alias("with_stop"),
                                   F.sum(F.when(F.col("stop"), 0).otherwise(F.col("n"))).alias("without_stop")))
    counts = staged(counts, "counts")  # read twice: the texts are cut into tokens once
    total = counts.agg(F.sum("with_stop").alias("stops"), (F.sum("with_stop") + F.sum("without_stop")).alias("tokens"))
    rows = counts.filter((F.col("with_stop") > 0) & F.col("word").rlike(_WORD))
    one = total.select(F.lit(1).alias("_one"), (F.col("stops") / F.col("tokens")).alias("chance"))
    j = rows.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one")
    a, b = F.col("with_stop"), F.col("without_stop")
    inner = F.length("word") - F.length(F.replace(F.col("word"), F.lit("."), F.lit("")))
    letters = F.length("word") - inner
    # where every token has a stop, chance is 1: no word stands out
    random = a * F.ln("chance") + b * F.ln(F.greatest(1 - F.col("chance"), F.lit(1e-300)))
    belongs = a * F.ln(F.lit(0.99)) + b * F.ln(F.lit(0.01))
    score = 2 * (belongs - random) * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -b.cast("double"))
    return j.select("word", "with_stop", "without_stop", score.alias("score"))


def abbreviations(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The words (``word``, ``score``) whose full stop belongs to them."""
    return abbreviation_scores(df, text).filter(F.col("score") >= threshold).select("word", "score")


def _last_word(piece) -> Column:
    """The last token of a piece, without its stop; null where it ends otherwise."""
    last = token(F.regexp_extract(piece, r"(\S+)\s*$", 1))
    return F.when(last.endswith("."), F.regexp_replace(last, r"\.$", ""))


def with_sentences(df: DataFrame, text: str, known: DataFrame, out: str = "sentences", held: int = HELD) -> DataFrame:
    """``df`` with the sentences of ``text``: the pieces of the punctuation rule,
    joined again (by a space) where the first ends with an abbreviation of
    ``known`` (``word``).  Up to ``held`` abbreviations go to the workers and nothing is shuffled; beyond, the pieces'
    last words are joined and each row's pieces meet again."""
    split = df.withColumn("_p", sentences(F.coalesce(F.col(text), F.lit(""))))
    last = F.transform("_p", _last_word)
    words = known.select("word").limit(held + 1).collect()
    if len(words) <= held:
        abbreviated = frozenset(r[0] for r in words)

        @F.pandas_udf(T.ArrayType(T.BooleanType()))
        def goes_on(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                yield rows.map(lambda ws: [w in abbreviated for w in ws])

        split = split.withColumn("_on", goes_on(last))
    else:
        row = split.withColumn("_row", F.monotonically_increasing_id())
        pieces = row.select("_row", F.posexplode_outer(last).alias("_at", "word"))
        pieces = pieces.join(known.select("word", F.lit(True).alias("_known")), "word", "left")
        per = pieces.groupBy("_row").agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", F.coalesce("_known", F.lit(False)).alias("k")))),
                                                     lambda x: x["k"]).alias("_on"))
        split = row.join(per, "_row").drop("_row")
    pairs = F.arrays_zip(F.col("_p").alias("p"), F.col("_on").alias("on"))
    joined = F.array_join(F.transform(pairs, lambda x: F.concat(x["p"], F.when(x["on"], F.lit(" ")).otherwise(F.lit(SENT_MARK)))), "")
    return split.withColumn(out, F.split(F.regexp_replace(joined, f"[ {SENT_MARK}]\\z", ""), SENT_MARK)).drop("_p", "_on")
