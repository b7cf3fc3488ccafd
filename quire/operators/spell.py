"""Dictionary spelling correction as a join (J8, U3, T11 last step).

Each token goes to the dictionary term at the smallest edit distance (at most
2), then the highest frequency, then the term itself; an exact dictionary word
stays; a token with no term within 2 stays unchanged; tokens of a recognised
organisation name are exempt.

Candidate generation is a symmetric-delete equi-join: every term and every
distinct out-of-dictionary token is expanded to the strings reachable by
deleting up to two characters from its first seven, the two sides are joined
on those keys, and each candidate pair is verified with
an exact distance (an exchange of neighbouring characters
counts 1).  No cross join:
the work is proportional to the candidate pairs that share a delete key.
Only distinct tokens take part; occurrences are joined back afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.extract import ORG_RULE
from quire.functions.text import clean_text, col_of
from quire.session import reliable_checkpoint

MAX_EDIT = 2
PREFIX = 7
WORD = r"^[a-z]+$"


def _drop_each(s: Column) -> Column:
    """All strings made by deleting one character of ``s`` (empty for '')."""
    n = F.length(s)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n),
                                     lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, PREFIX))))\
        .otherwise(F.array().cast("array<string>"))


def delete_keys(word) -> Column:
    """The prefix and every string reachable by deleting 1 or 2 of its characters."""
    p = F.substring(col_of(word), 1, PREFIX)
    d1 = _drop_each(p)
    d2 = F.flatten(F.transform(d1, _drop_each))
    return F.array_distinct(F.concat(F.array(p), d1, d2))


def _swaps(s: Column) -> Column:
    """Every string made by exchanging two neighbouring characters of ``s``."""
    n = F.length(s)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(
        F.substring(s, 1, i - 1), F.substring(s, i + 1, 1), F.substring(s, i, 1), F.substring(s, i + 2, n)))) \
        .otherwise(F.array().cast("array<string>"))


def edit_distance(token, term) -> Column:
    """Edits up to ``MAX_EDIT`` (null beyond), an exchange of neighbours being
    one: plain distance, or one exchange on either side and one more edit, or
    one exchange on each side."""
    a, b = col_of(token), col_of(term)
    plain = F.levenshtein(a, b, MAX_EDIT)
    near_a = F.exists(_swaps(a), lambda s: F.levenshtein(s, b, 1) >= 0)
    near_b = F.exists(_swaps(b), lambda s: F.levenshtein(s, a, 1) >= 0)
    one = F.array_contains(_swaps(a), b)
    return (F.when((plain >= 0) & (plain < 2), plain).when(one, 1)
            .when((plain == 2) | near_a | near_b | F.arrays_overlap(_swaps(a), _swaps(b)), 2))


def dictionary_from_text(df: DataFrame, text: str = "text", min_count: int = 1) -> DataFrame:
    """A frequency dictionary ``term, cnt``: lower-cased words (``[a-z]+``) of
    the cleaned text."""
    words = df.select(F.explode_outer(F.split(F.lower(clean_text(text)), r"\s+")).alias("term"))
    d = words.filter(F.col("term").rlike(WORD)).groupBy("term").agg(F.count(F.lit(1)).alias("cnt"))
    return d.filter(F.col("cnt") >= min_count)


def best_terms(tokens: DataFrame, dictionary: DataFrame, token: str = "token") -> DataFrame:
    """``token, term, distance`` for every distinct token that has a term within
    ``MAX_EDIT`` (tokens that are dictionary words map to themselves)."""
    toks = tokens.select(F.col(token).alias("token")).distinct()
    d = dictionary.select("term", "cnt")
    exact = toks.join(d.select(F.col("term").alias("token")), "token", "left_semi") \
        .select("token", F.col("token").alias("term"), F.lit(0).alias("distance"))
    rest = toks.join(d.select(F.col("term").alias("token")), "token", "left_anti")
    # join on (delete key, token length): each term is listed under the token
    # lengths it can be within MAX_EDIT of, so a short, common key does not pair
    # every token with every term that shares it
    tk = rest.select("token", F.length("token").alias("tlen"), F.explode_outer(delete_keys("token")).alias("key"))
    dk = d.select("term", "cnt", F.explode_outer(delete_keys("term")).alias("key"),
                  F.explode(F.sequence(F.length("term") - MAX_EDIT, F.length("term") + MAX_EDIT)).alias("tlen"))
    cand = tk.join(dk, ["key", "tlen"]).select("token", "term", "cnt").distinct()
    cand = cand.filter(F.abs(F.length("token") - F.length("term")) <= MAX_EDIT)
    # two edits, exchanges included, are at most four plain ones
    cand = cand.filter(F.levenshtein("token", "term", 2 * MAX_EDIT) >= 0)
    cand = cand.withColumn("distance", edit_distance("token", "term")).filter(F.col("distance").isNotNull())
    best = cand.groupBy("token").agg(
        F.min_by(F.struct("term", "distance"), F.struct("distance", -F.col("cnt"), "term")).alias("b"))
    fuzzy = best.select("token", F.col("b.term").alias("term"), F.col("b.distance").alias("distance"))
    return exact.unionByName(fuzzy)


def entity_tokens(text) -> Column:
    """U3 (re-aimed): the distinct words of the first organisation-like name."""
    org = F.regexp_extract(col_of(text), ORG_RULE, 1)
    return F.when(org != "", F.array_distinct(F.split(org, r"\s+"))).otherwise(F.array().cast("array<string>"))


def correct(df: DataFrame, key: list[str], text: str, dictionary: DataFrame) -> DataFrame:
    """J8 applied to whole texts: whitespace tokens corrected in place, joined
    by one space.  ``text`` is the cleaned, line-joined text (T11 before J8)."""
    # the cleaned text feeds two branches (distinct tokens, occurrences):
    # materialise it once in the shared checkpoint folder
    base = reliable_checkpoint(df.select(*key, F.col(text).alias("_t"), entity_tokens(F.col(text)).alias("_ents")))
    occ = base.select(*key, "_ents", F.posexplode_outer(F.split(F.col("_t"), r"\s+")).alias("_p", "token")) \
        .filter(F.col("_p").isNotNull() & (F.col("token") != ""))
    exempt = F.array_contains("_ents", F.col("token"))
    to_fix = occ.filter(~exempt)
    # only tokens that change are joined back: usually a small table, so the
    # occurrences (hot tokens included) are not shuffled by token
    best = best_terms(to_fix, dictionary).filter(F.col("term") != F.col("token")).select("token", "term")
    fixed = occ.join(best, "token", "left").select(
        *key, "_p", F.when(exempt, F.col("token")).otherwise(F.coalesce("term", "token")).alias("w"))
    regrouped = fixed.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_p", "w"))).alias("_ws"))
    out = base.select(*key).join(regrouped, key, "left")
    return out.select(*key, F.coalesce(F.array_join(F.transform("_ws", lambda x: x["w"]), " "), F.lit("")).alias(text))
