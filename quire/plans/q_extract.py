"""Queries: invoice field extraction (X1-X14, J7, K1 on invoice text)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import extract as X
from quire.functions import keywords as KW
from quire.functions import text as TX
from quire.operators import tagger as TG
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus, invoice_text
from quire.session import reliable_checkpoint
from quire.sources.tables import table

_FIELDS_SQL = ", ".join(f"{O.extract_field('text', f)} AS {f}" for f in X.FIELD_KEYS)


@register("extract_fields", sql=f"""
WITH inv AS ({O.INVOICE_TEXT})
SELECT o_orderkey, {_FIELDS_SQL} FROM inv
""")
def extract_fields(spark, sf_dir):
    """X1-X7, X9, X10 on every synthetic invoice (raw text: default)."""
    inv = invoice_text(spark, sf_dir)
    return inv.select("o_orderkey", *X.extract_all_fields(F.col("text")))


@register("extract_fields_cleaned", sql=f"""
WITH inv AS ({O.INVOICE_TEXT}),
c AS (SELECT o_orderkey, {O.clean_text('text')} AS text FROM inv)
SELECT o_orderkey, {_FIELDS_SQL} FROM c
""")
def extract_fields_cleaned(spark, sf_dir):
    """Faithful order (Q1): clean first, then extract; digits are rewritten by
    the OCR substitutions so only the two name fields survive."""
    inv = invoice_text(spark, sf_dir).select("o_orderkey", TX.clean_text("text").alias("text"))
    return inv.select("o_orderkey", *X.extract_all_fields(F.col("text")))


@register("org_fallback", sql=f"""
SELECT doc_id, {O.org_fallback('text')} AS org FROM documents
""")
def org_fallback(spark, sf_dir):
    """X8 (re-aimed) over every document."""
    d = corpus(spark, sf_dir)
    return d.select("doc_id", X.org_fallback("text").alias("org"))


def _kw_sql(fn) -> str:
    return ", ".join(fn(f, vs) for f, vs in KW.FIELD_KEYWORDS.items())


def _sql_first_variant(text: str, variants) -> str:
    whens = " ".join(f"WHEN strpos(lower({text}), {O.q(v.lower())}) > 0 THEN {O.q(v)}" for v in variants)
    return f"CASE {whens} END"


def _sql_sentences(text: str) -> str:
    return f"string_split(regexp_replace({text}, {O.q(KW.SENTENCE_BOUNDARY)}, {O.q(chr(92) + '1' + KW.SENT_MARK)}, 'g'), {O.q(KW.SENT_MARK)})"


def _sql_keyword_sentence(f, vs) -> str:
    found = _sql_first_variant("t", vs)
    hit = f"list_filter({_sql_sentences('t')}, lambda s: strpos(lower(s), {found}) > 0)[1]"
    return (f"CASE WHEN ({found}) IS NULL THEN {O.q(KW.NOT_FOUND)} "
            f"ELSE coalesce({O.strip_ws(hit)}, ({found}) || {O.q(KW.DETECTED_SUFFIX)}) END AS {f}")


@register("keyword_detect", sql=f"""
WITH inv AS ({O.INVOICE_TEXT})
SELECT o_orderkey, {_kw_sql(lambda f, vs: _sql_first_variant('text', vs) + ' AS ' + f)} FROM inv
""")
def keyword_detect(spark, sf_dir):
    """J7 + X11: first keyword variant per field found in each invoice."""
    inv = invoice_text(spark, sf_dir)
    return inv.select("o_orderkey", *KW.detect_keywords("text"))


@register("keyword_sentence", sql=f"""
WITH inv AS ({O.INVOICE_TEXT}),
t AS (SELECT o_orderkey, coalesce(text, '') AS t FROM inv)
SELECT o_orderkey, {_kw_sql(_sql_keyword_sentence)} FROM t
""")
def keyword_sentence(spark, sf_dir):
    """X12 (+K1): sentence holding the first found keyword, per field."""
    inv = invoice_text(spark, sf_dir)
    return KW.keyword_fields(inv, "text", ["o_orderkey"])


@register("keyword_sentence_docs", sql=f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, {_kw_sql(_sql_keyword_sentence)} FROM t
""")
def keyword_sentence_docs(spark, sf_dir):
    """X12 over the multilingual corpus (whole texts)."""
    d = corpus(spark, sf_dir)
    return KW.keyword_fields(d, "text", ["doc_id"])


# --- names of organisations by the trained tagger -----------------------------------------

#: Letters about orders: every fifth one is held out, and of the others two in three have a company suffix.
_HELD, _BARE = "o_orderkey % 5 = 0", "o_orderkey % 3 = 0"
_LETTER = {  # by o_orderkey % 4
    0: ("Invoice of ", " for goods worth {p}. Please pay by the due date."),
    1: ("We, ", ", bill you {p} for your order of last week."),
    2: ("Payable to ", " is the sum of {p}. Thank you for your order."),
    3: ("The goods were sold by ", " at a price of {p}. Return them within a week."),
}

def name_letters(spark, sf_dir):
    """``o_orderkey``, ``name``, ``held`` and the ``text`` of a letter that names the customer's
    firm: a word for its nation and one for its number, with a company suffix or without."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    # letters for the digits of the number, so that firms have names of their own
    word = F.initcap(F.translate(F.substring("c_name", -5, 5), "0123456789", "aeioulmnrs"))
    name = F.concat(F.initcap(F.translate("n_name", "_0123456789", "xaeioulmnrs")), F.lit(" "), word)
    suffix = F.when(F.expr(f"{_HELD} OR {_BARE}"), F.lit("")).otherwise(F.concat(F.lit(" "), F.element_at(
        F.array(*[F.lit(x) for x in ("Ltd", "GmbH", "Inc", "AG")]), (F.col("o_orderkey") % 4 + 1).cast("int"))))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == k, F.concat(F.lit(a), name, suffix, F.lit(b.split("{p}")[0]), price, F.lit(b.split("{p}")[1])))
                        for k, (a, b) in _LETTER.items()])
    return j.select("o_orderkey", name.alias("name"), F.expr(_HELD).alias("held"), text.alias("text"))


@register("org_tagger", sql=f"""
SELECT o_orderkey, true AS mostly_found, true AS rule_misses FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE {_HELD}
""")
def org_tagger(spark, sf_dir):
    """A tagger learns from the names that a company suffix gives away; in held-out letters
    whose names have none, and which the suffix rule therefore misses, it finds at least 95 %, each as a whole."""
    letters = reliable_checkpoint(name_letters(spark, sf_dir))
    tagger = TG.train(letters.filter(~F.col("held")), "text")
    out = letters.filter("held").select("o_orderkey", (TG.first_name("text", tagger) == F.col("name")).alias("hit"),
                                        X.org_fallback("text").isNull().alias("rule_misses"), F.lit(1).alias("_one"))
    out = reliable_checkpoint(out)
    rate = out.agg((F.avg(F.coalesce(F.col("hit"), F.lit(False)).cast("double")) >= 0.95).alias("mostly_found"), F.lit(1).alias("_one"))
    return out.join(F.broadcast(rate), "_one").select("o_orderkey", "mostly_found", "rule_misses")
