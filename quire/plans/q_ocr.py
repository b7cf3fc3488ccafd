"""Queries: pages, OCR candidates and table text."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import ocr as OC
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus
from quire.sources.tables import table

WORDS_PER_LINE = 12


@register("concat_pages", sql=f"""
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_pages,
       {O.strip_ws("string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)")} AS text
FROM conversations GROUP BY conv_id
""")
def concat_pages(spark, sf_dir):
    """A17 + A20: conversation turns as the pages of one document."""
    c = OC.stamp_pages(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return OC.concat_pages(c, "conv_id", "page")


@register("best_candidate", sql="""
WITH s AS (SELECT conv_id, turn, role AS name, text,
                  CAST(length(regexp_replace(coalesce(text, ''), '[^\\p{L}\\p{N}]', '', 'g')) AS INTEGER) AS char_count
           FROM conversations)
SELECT conv_id, arg_max(name, [char_count, -turn]) AS name, arg_max(text, [char_count, -turn]) AS text,
       max(char_count) AS char_count
FROM s GROUP BY conv_id
""")
def best_candidate(spark, sf_dir):
    """A18 + T17 + O5: per document the candidate text with most letters and
    digits (role = candidate name, turn = list order)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("name"), "text")
    return OC.best_candidate(c, "conv_id", "turn")


def ocr_words(spark, sf_dir):
    """Word boxes of every document: whitespace-split words with a line number,
    an x position that is not in reading order, and a confidence, all from
    fixed arithmetic on the word position.  One document in five has no word
    rows, and one has rejected words only."""
    d = corpus(spark, sf_dir).filter("doc_id % 5 <> 3").select(
        "doc_id", F.posexplode_outer(F.split("text", " ")).alias("pos", "text")).filter(F.col("pos").isNotNull())
    return d.select("doc_id", "pos", "text",
                    (F.floor(F.col("pos") / WORDS_PER_LINE) + 1).alias("line_num"),
                    ((F.col("pos") * 7) % WORDS_PER_LINE * 50).alias("left"),
                    F.when(F.col("doc_id") % 5 == 2, 0).otherwise((F.col("pos") % 5) - 1).alias("conf"))


@register("table_lines", sql=f"""
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS text,
                  generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents
      WHERE doc_id % 5 <> 3),
b AS (SELECT doc_id, pos, text, floor(pos / {WORDS_PER_LINE}) + 1 AS line_num,
             (pos * 7) % {WORDS_PER_LINE} * 50 AS "left", CASE WHEN doc_id % 5 = 2 THEN 0 ELSE (pos % 5) - 1 END AS conf FROM w),
k AS (SELECT * FROM b WHERE CAST(CAST(conf AS DOUBLE) AS INTEGER) > 0 AND {O.strip_ws('text')} <> ''),
l AS (SELECT doc_id, line_num, string_agg(text, '  ' ORDER BY "left", pos) AS line FROM k GROUP BY doc_id, line_num),
t AS (SELECT doc_id, string_agg(line || chr(10), '' ORDER BY line_num) AS body FROM l GROUP BY doc_id),
f AS (SELECT DISTINCT doc_id FROM b)
SELECT d.doc_id, d.text || CASE WHEN f.doc_id IS NULL THEN '' ELSE chr(10) || {O.q(OC.TABLE_START)} || coalesce(t.body, '')
       || {O.q(OC.TABLE_END)} END AS text
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
""")
def table_lines(spark, sf_dir):
    """Table text rebuilt from word boxes and appended to the page text."""
    tables = OC.table_text(ocr_words(spark, sf_dir), "doc_id")
    pages = corpus(spark, sf_dir).select("doc_id", "text")
    return OC.append_table_text(pages, tables, "doc_id")
