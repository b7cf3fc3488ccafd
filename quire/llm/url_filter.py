"""URL filter: host and path rules, then a weighted vocabulary.

Rules are native columns.  The vocabulary is matched by one Aho-Corasick
automaton per worker over the lower-cased url; a hit counts when neither
neighbour is a letter or a digit.  One strict term, or ``min_soft`` distinct
soft terms, reject the url.  No shuffle: one pass over the rows, so hot hosts
cost nothing extra.

Edge cases: a null url, or one without ``://``, has an empty host and path and
fits no rule; a null url has no hits (allow), another is matched whole; of two
fitting rules the longer wins, then the smaller text; repeated rows are judged
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ascii_lower, sql_text

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: (term, strict, weight).
VOCABULARY = (
    ("casino", True, 1.0), ("porn", True, 1.0), ("xxx", True, 1.0), ("viagra", True, 1.0),
    ("escort", True, 1.0), ("warez", True, 1.0), ("gambling", True, 1.0), ("malware", True, 1.0),
    ("phishing", True, 1.0), ("jackpot", True, 1.0),
    ("free", False, 0.5), ("bet", False, 0.5), ("bets", False, 0.5), ("win", False, 0.4),
    ("cheap", False, 0.5), ("pills", False, 0.6), ("ads", False, 0.5), ("track", False, 0.4),
    ("bonus", False, 0.5), ("loan", False, 0.5), ("loans", False, 0.5), ("prize", False, 0.5),
    ("dating", False, 0.5), ("crack", False, 0.5), ("adult", False, 0.6), ("poker", False, 0.6),
    ("popup", False, 0.5), ("spam", False, 0.5), ("click", False, 0.4), ("deal", False, 0.3),
)
MIN_SOFT = 2
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def automaton(vocabulary) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for k, (term, strict, weight) in enumerate(vocabulary):
        built.add_word(term, (k, len(term), strict, weight))
    built.make_automaton()
    return built


def hits(url: str, words: ahocorasick.Automaton) -> tuple[int, int, float]:
    """Distinct strict terms, distinct soft terms and their summed weight."""
    found = {}
    for end, (k, length, strict, weight) in words.iter(url):
        start = end - length + 1
        if (start == 0 or url[start - 1] not in ALNUM) and (end + 1 == len(url) or url[end + 1] not in ALNUM):
            found[k] = (strict, weight)
    strict = sum(1 for is_strict, _ in found.values() if is_strict)
    return strict, len(found) - strict, float(sum(weight for _, weight in found.values()))


def _match(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton(vocabulary)
        for batch in batches:
            got = [hits(url, words) if url else (0, 0, 0.0) for url in batch.column("lowered").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in ("id", "host", "path", "rule", "rule_verdict")]
                + [pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.int32()),
                   pa.array([g[2] for g in got], pa.float64())],
                names=["id", "host", "path", "rule", "rule_verdict", "n_strict", "n_soft", "weight"])
    return run


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               vocabulary=VOCABULARY, min_soft: int = MIN_SOFT) -> DataFrame:
    """One row per row of ``pages``: ``<id_col>``, ``host``, ``path``, ``rule``,
    ``verdict``, ``n_strict``, ``n_soft`` (distinct terms) and ``weight``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), ascii_lower(F.regexp_extract(url, URL_PARTS, 1)).alias("host"),
                        F.regexp_extract(url, URL_PARTS, 2).alias("path"), ascii_lower(url).alias("lowered"))
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    kind_of_id = dict(pages.dtypes)[id_col]
    judged = rows.withColumns({"rule": rule, "rule_verdict": verdict}).mapInArrow(
        _match(tuple(vocabulary)), f"id {kind_of_id}, host string, path string, rule string, rule_verdict string, "
                                   "n_strict int, n_soft int, weight double")
    reject = (F.col("n_strict") >= 1) | (F.col("n_soft") >= min_soft)
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("rule_verdict", F.when(reject, "block").otherwise("allow")).alias("verdict"),
                         "n_strict", "n_soft", F.round("weight", 6).alias("weight"))


def oracle(rules=RULES, vocabulary=VOCABULARY, min_soft: int = MIN_SOFT) -> str:
    """The same judgement in SQL, a pattern per term instead of the automaton."""
    def hit(term):
        return f"CAST(regexp_matches(lowered, {sql_text('(^|[^a-z0-9])' + term + '([^a-z0-9]|$)')}) AS INTEGER)"

    def case(value):
        whens = []
        for rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
            host, slash, path = rule[1].partition("/")
            whens.append(f"WHEN (host = {sql_text(host)} OR ends_with(host, {sql_text('.' + host)})) "
                         f"AND starts_with(path, {sql_text(slash + path)}) THEN {sql_text(value(rule))}")
        return f"CASE {' '.join(whens)} END"

    def total(strict, unit):
        return " + ".join(unit(t, w) for t, s, w in vocabulary if strict is None or s == strict)

    return f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM pages),
p AS (
  SELECT page_id, lowered, regexp_extract(lowered, {sql_text(URL_PARTS)}, 1) AS host,
         regexp_extract(url, {sql_text(URL_PARTS)}, 2) AS path FROM u),
h AS (
  SELECT *, {total(True, lambda t, w: hit(t))} AS n_strict, {total(False, lambda t, w: hit(t))} AS n_soft,
         {total(None, lambda t, w: f"{w!r}::DOUBLE * {hit(t)}")} AS weight,
         {case(lambda r: r[1])} AS rule, {case(lambda r: r[0])} AS rule_verdict
  FROM p)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN n_strict >= 1 OR n_soft >= {min_soft} THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(n_strict AS INTEGER) AS n_strict, CAST(n_soft AS INTEGER) AS n_soft, round(weight, 6) AS weight
FROM h
"""
