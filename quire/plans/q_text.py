"""Queries: text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as TX
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus
from quire.sources.tables import table


@register("ocr_substitute", sql=f"SELECT doc_id, {O.ocr_substitute('text')} AS text FROM documents")
def ocr_substitute(spark, sf_dir):
    """T2."""
    return corpus(spark, sf_dir).select("doc_id", TX.ocr_substitute("text").alias("text"))


@register("noise_strip", sql=f"SELECT doc_id, {O.noise_strip(O.ocr_substitute('text'))} AS text FROM documents")
def noise_strip(spark, sf_dir):
    """T2 -> T3..T5."""
    return corpus(spark, sf_dir).select("doc_id", TX.noise_strip(TX.ocr_substitute("text")).alias("text"))


@register("fix_spacing", sql=f"SELECT doc_id, {O.fix_spacing('text')} AS text FROM documents")
def fix_spacing(spark, sf_dir):
    """T7 + T8 on raw text (ASCII-class rules)."""
    return corpus(spark, sf_dir).select("doc_id", TX.fix_spacing("text").alias("text"))


@register("clean_text", sql=f"SELECT doc_id, {O.clean_text('text')} AS text FROM documents")
def clean_text(spark, sf_dir):
    """The full cleaning chain over every document."""
    return corpus(spark, sf_dir).select("doc_id", TX.clean_text("text").alias("text"))


@register("clean_text_pages", sql=f"SELECT page_id, {O.clean_text('html')} AS text FROM pages")
def clean_text_pages(spark, sf_dir):
    """T10 over raw web pages (markup is noise to the OCR rules too)."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", TX.clean_text("html").alias("text"))


@register("accent_fold", sql="SELECT doc_id, strip_accents(text) AS text FROM documents")
def accent_fold(spark, sf_dir):
    """T6 on its own: diacritics removed, everything else kept."""
    return corpus(spark, sf_dir).select("doc_id", TX.accent_fold("text").alias("text"))


@register("advanced_cleanup", sql=f"SELECT doc_id, {O.line_cleanup(O.clean_text('text'))} AS text FROM documents")
def advanced_cleanup(spark, sf_dir):
    """Clean, then line rules and short-line removal."""
    return corpus(spark, sf_dir).select("doc_id", TX.advanced_cleanup("text").alias("text"))


@register("classifier_normalize", sql=f"SELECT doc_id, {O.classifier_normalize('text')} AS text FROM documents")
def classifier_normalize(spark, sf_dir):
    """T15."""
    return corpus(spark, sf_dir).select("doc_id", TX.classifier_normalize("text").alias("text"))


@register("text_lengths", sql="""
SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars,
       CAST(length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS BIGINT) AS n_alnum
FROM documents""")
def text_lengths(spark, sf_dir):
    """T16 + T17: character length and Unicode alphanumeric count."""
    d = corpus(spark, sf_dir)
    return d.select("doc_id", TX.char_length("text").cast("bigint").alias("n_chars"),
                    TX.alnum_count("text").cast("bigint").alias("n_alnum"))


# --- spelling pass (J8) ---------------------------------------------------------

from quire.functions import extract as _X  # noqa: E402
from quire.operators import spell as SPL  # noqa: E402

_DICT_SQL = f"""
dict AS (SELECT term, count(*) AS cnt
         FROM (SELECT unnest(string_split_regex(lower({O.clean_text('text')}), '\\s+')) AS term FROM benchmark)
         WHERE regexp_matches(term, '{SPL.WORD}') GROUP BY term)"""


@register("spell_correct", sql=f"""
WITH {_DICT_SQL},
c AS (SELECT conv_id, turn, {O.line_cleanup(O.clean_text('text'))} AS t FROM conversations),
e AS (SELECT conv_id, turn, t, regexp_extract(t, {O.q(_X.ORG_RULE)}, 1) AS org FROM c),
occ AS (SELECT conv_id, turn, org, unnest(string_split_regex(t, '\\s+')) AS tok,
               generate_subscripts(string_split_regex(t, '\\s+'), 1) AS pos FROM e),
o2 AS (SELECT *, org <> '' AND list_contains(string_split_regex(org, '\\s+'), tok) AS exempt FROM occ WHERE tok <> ''),
ut AS (SELECT DISTINCT tok FROM o2 WHERE NOT exempt AND tok NOT IN (SELECT term FROM dict)),
cand AS (SELECT tok, term, cnt, damerau_levenshtein(tok, term) AS d FROM ut JOIN dict
         ON abs(length(tok) - length(term)) <= {SPL.MAX_EDIT} WHERE damerau_levenshtein(tok, term) <= {SPL.MAX_EDIT}),
best AS (SELECT tok, arg_min(term, {{'d': d, 'c': -cnt, 't': term}}) AS term FROM cand GROUP BY tok),
w AS (SELECT o2.conv_id, o2.turn, o2.pos, CASE WHEN exempt THEN o2.tok ELSE coalesce(best.term, o2.tok) END AS w
      FROM o2 LEFT JOIN best ON o2.tok = best.tok),
agg AS (SELECT conv_id, turn, string_agg(w, ' ' ORDER BY pos) AS text FROM w GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, coalesce(agg.text, '') AS text
FROM c LEFT JOIN agg ON c.conv_id = agg.conv_id AND c.turn = agg.turn
""")
def spell_correct(spark, sf_dir):
    """T11 + J8 + U3: advanced cleanup of every conversation turn, then the
    dictionary pass (dictionary = word counts of the cleaned benchmark texts)."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", TX.advanced_cleanup("text").alias("text"))
    dictionary = SPL.dictionary_from_text(table(spark, sf_dir, "benchmark"))
    return SPL.correct(conv, ["conv_id", "turn"], "text", dictionary)
