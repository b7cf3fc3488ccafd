"""Page and OCR-result operators.

The OCR engine itself is not run (it is an external binary); jobs start from
the tables it produces: page texts, candidate texts and word boxes.  Every
grouping here is per document (or per document line): a group never spans
more than one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import alnum_count, strip_ws

# ---------------------------------------------------------------------------
# Separators and markers of the reference's page / table text.
# ---------------------------------------------------------------------------
PAGE_SEPARATOR = "\n\n"
TABLE_START = "\n\n----- TABLE CONTENT START -----\n"
TABLE_END = "----- TABLE CONTENT END -----\n\n"
WORD_SEPARATOR = "  "
OCR_FAILED = "OCR failed for all processing methods"
# ---------------------------------------------------------------------------


def stamp_pages(results: DataFrame, doc: str, page_pos: str) -> DataFrame:
    """1-based page number on each page's OCR rows."""
    return results.withColumn("page", F.col(page_pos) + 1)


def concat_pages(pages: DataFrame, doc: str, page: str, text: str = "text") -> DataFrame:
    """Page texts in page order, blank line between, outer whitespace stripped."""
    g = pages.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct(F.col(page).alias("p"),
                                                                     F.coalesce(F.col(text), F.lit("")).alias("t"))))
                               .alias("_pages"))
    joined = F.array_join(F.transform("_pages", lambda x: x["t"]), PAGE_SEPARATOR)
    return g.select(doc, F.size("_pages").alias("n_pages"), strip_ws(joined).alias("text"))


def best_candidate(cands: DataFrame, doc: str, pos: str, name: str = "name", text: str = "text",
                   docs: DataFrame | None = None) -> DataFrame:
    """A18 + T17 + O5: the candidate with most alphanumeric characters; the
    first in list order wins ties; a document without candidates gets the
    failure message (when ``docs`` lists all documents)."""
    scored = cands.select(doc, pos, name, text, alnum_count(F.coalesce(F.col(text), F.lit(""))).alias("char_count"))
    best = scored.groupBy(doc).agg(F.max_by(F.struct(name, text, "char_count"),
                                            F.struct(F.col("char_count"), -F.col(pos))).alias("_b"))
    best = best.select(doc, F.col(f"_b.{name}").alias(name), F.col(f"_b.{text}").alias(text),
                       F.col("_b.char_count").alias("char_count"))
    if docs is None:
        return best
    j = docs.select(doc).join(best, doc, "left")
    return j.select(doc, name, F.coalesce(F.col(text), F.lit(OCR_FAILED)).alias(text), "char_count")


def table_text(words: DataFrame, doc: str, line: str = "line_num", left: str = "left", pos: str = "pos",
               conf: str = "conf", text: str = "text") -> DataFrame:
    """Keep words with confidence > 0 and non-blank text; per line sort by
    x (ties keep reading order) and join with two spaces; lines in order, each
    ending in a newline, wrapped by the start / end markers.  A page whose words
    were all rejected has an empty block; a page without word rows has none."""
    kept = (F.col(conf).cast("double").cast("int") > 0) & (strip_ws(F.col(text)) != "")
    # rejected words stay where they are: of them one row a page travels; a page's rows meet once, for lines and page
    rows = words.filter(kept).select(doc, line, left, pos, text, F.lit(True).alias("_word"))
    rows = rows.unionByName(words.select(doc).distinct(), allowMissingColumns=True).repartition(doc)
    lines = rows.groupBy(doc, line).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_word"), F.struct(left, pos, text)))), lambda x: x[text]),
                     WORD_SEPARATOR).alias("_line"), F.count("_word").alias("_kept"))
    per_doc = lines.groupBy(doc).agg(F.sort_array(F.collect_list(
        F.when(F.col("_kept") > 0, F.struct(line, "_line")))).alias("_ls"))
    body = F.concat_ws("", F.transform("_ls", lambda x: F.concat(x["_line"], F.lit("\n"))))
    return per_doc.select(doc, F.concat(F.lit(TABLE_START), body, F.lit(TABLE_END)).alias("table_text"))


def append_table_text(pages: DataFrame, tables: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """A19 last step: page text + newline + table text where a table was found."""
    j = pages.join(tables, doc, "left")
    return j.select(doc, F.concat(F.col(text), F.coalesce(F.concat(F.lit("\n"), "table_text"), F.lit(""))).alias(text))
