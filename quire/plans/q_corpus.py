"""Queries: corpus, routing, ids, scalars (S2, S9-S11, P1-P6, P10, J1b, J3, J4,
U1, U2, W6, W7, A7, K9, D1-D8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.functions import text as TX
from quire.operators import corpus as C
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus
from quire.sources.tables import table

URL_PATH = r"^[A-Za-z]+://[^/?#]*([^?#]*)"


def _names(spark, sf_dir):
    """File names to route: page URL paths and corpus file names."""
    p = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page:"), F.col("page_id").cast("string")).alias("key"),
        F.regexp_extract("url", URL_PATH, 1).alias("path"))
    d = corpus(spark, sf_dir).select(F.concat(F.lit("doc:"), F.col("id")).alias("key"),
                                     F.col("filename").alias("path"))
    return p.unionByName(d)


_EXT_SQL = "lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), " + O.q(S.EXT_RULE) + ", 1))"
_ROUTE_SQL = "CASE " + " ".join(
    f"WHEN ext IN ({', '.join(O.q(e) for e in exts)}) THEN {O.q(fam)}" for fam, exts in S.ROUTES
) + f" ELSE {O.q(S.UNSUPPORTED)} END"
_TYPE_SQL = "CASE " + " ".join(f"WHEN ext = {O.q(e)} THEN {O.q(d)}" for e, d in S.FILE_TYPE_NAMES) + \
    " ELSE upper(substring(ext, 2)) || ' File' END"
_ALLOWED_SQL = ("(strpos(base, '.') > 0 AND lower(regexp_extract(base, '\\.([^.]*)$', 1)) IN ("
                + ", ".join(O.q(e) for e in S.ALLOWED_EXTENSIONS) + "))")

NAMES_SQL = f"""
SELECT 'page:' || CAST(page_id AS VARCHAR) AS key, regexp_extract(url, {O.q(URL_PATH)}, 1) AS path FROM pages
UNION ALL
SELECT 'doc:' || id AS key, filename AS path FROM ({O.CORPUS})
"""


@register("route_by_ext", sql=f"""
WITH n AS ({NAMES_SQL}),
e AS (SELECT key, path, regexp_extract(path, '([^/]*)$', 1) AS base, {_EXT_SQL} AS ext FROM n)
SELECT key, base AS filename, ext, {_ROUTE_SQL} AS route, {_ALLOWED_SQL} AS allowed,
       upper(substring(ext, 2)) AS file_type, {_TYPE_SQL} AS type_description
FROM e
""")
def route_by_ext(spark, sf_dir):
    """S2 + P6 + D2 + D6 over page paths and corpus file names."""
    n = _names(spark, sf_dir).withColumn("ext", S.extension("path"))
    base = S.base_name("path")
    return n.select("key", base.alias("filename"), "ext", S.route("ext").alias("route"),
                    S.allowed_file(base).alias("allowed"), S.file_type("path").alias("file_type"),
                    S.type_description("ext").alias("type_description"))


@register("content_hash", sql=f"SELECT doc_id, md5({O.clean_text('text')}) AS id FROM documents")
def content_hash(spark, sf_dir):
    """MD5 of the cleaned text."""
    d = corpus(spark, sf_dir)
    return d.select("doc_id", S.content_hash(TX.clean_text("text")).alias("id"))


_SAFE_SQL = O.rr(O.rr(O.rr(O.rr(O.rr("strip_accents(url)", r"[/\\]", " "), r"^\s+|\s+$", ""), r"\s+", "_"),
                      r"[^A-Za-z0-9_.\-]", ""), r"^[._]+|[._]+$", "")


@register("safe_name", sql=f"SELECT page_id, {_SAFE_SQL} AS safe_name FROM pages")
def safe_name(spark, sf_dir):
    """D8 on every page URL."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", S.safe_name("url").alias("safe_name"))


def _size_sql(x: str) -> str:
    s = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN {s} < 1024.0 THEN format('{{:.2f}} B', round_even({s}, 2)) "
            f"WHEN {s}/1024.0 < 1024.0 THEN format('{{:.2f}} KB', round_even({s}/1024.0, 2)) "
            f"WHEN {s}/1024.0/1024.0 < 1024.0 THEN format('{{:.2f}} MB', round_even({s}/1024.0/1024.0, 2)) "
            f"ELSE format('{{:.2f}} GB', round_even({s}/1024.0/1024.0/1024.0, 2)) END")


def _size_short_sql(x: str) -> str:
    s = f"CAST({x} AS BIGINT)"
    return (f"CASE WHEN {s} < 1024 THEN CAST({s} AS VARCHAR) || ' bytes' "
            f"WHEN {s} < 1048576 THEN format('{{:.1f}} KB', round_even({s}/1024.0, 1)) "
            f"ELSE format('{{:.1f}} MB', round_even({s}/1048576.0, 1)) END")


@register("format_size", sql=f"""
SELECT doc_id, {_size_sql('n_chars')} AS size, {_size_sql('n_chars*n_chars*n_chars')} AS size_cubed,
       {_size_short_sql('n_chars*n_chars')} AS size_short
FROM documents""")
def format_size(spark, sf_dir):
    """D3 / D4 on document sizes (cubed and squared too, to reach every unit)."""
    d = corpus(spark, sf_dir)
    n = F.col("n_chars")
    return d.select("doc_id", S.format_size(n).alias("size"), S.format_size(n * n * n).alias("size_cubed"),
                    S.format_size_short(n * n).alias("size_short"))


@register("format_timestamp",
          sql="SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events")
def format_timestamp(spark, sf_dir):
    """D5."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", S.format_timestamp("ts").alias("ts_text"))


_CAP_SQL = "(upper(substring({c}, 1, 1)) || lower(substring({c}, 2)))"
_DISPLAY_VALUES = ", ".join(f"({O.q(a)}, {O.q(b)})" for a, b in S.DISPLAY_CLASSES)


@register("class_display", sql=f"""
WITH d(k, v) AS (VALUES {_DISPLAY_VALUES}),
e AS (SELECT event_id, {_CAP_SQL.format(c='event_type')} AS cap FROM events)
SELECT event_id, coalesce(d.v, e.cap) AS display FROM e LEFT JOIN d ON e.cap = d.k
""")
def class_display(spark, sf_dir):
    """D7 + J4: display name per run row (broadcast map lookup with default)."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", S.display_class("event_type").alias("display"))


# --- label index, class index -------------------------------------------------

CLASS_INDEX_SQL = """
WITH n AS (SELECT DISTINCT lower(source) AS label_name FROM documents),
i AS (SELECT label_name, CAST(dense_rank() OVER (ORDER BY label_name) - 1 AS INTEGER) AS label FROM n),
l AS (SELECT CAST(label AS VARCHAR) || ' ' || label_name AS value FROM i)
SELECT CAST(split_part(value, ' ', 1) AS INTEGER) AS class_id,
       substring(value, strpos(value, ' ') + 1) AS name,
       upper(substring(substring(value, strpos(value, ' ') + 1), 1, 1))
         || lower(substring(substring(value, strpos(value, ' ') + 1), 2)) AS display
FROM l
"""


@register("class_index", sql=CLASS_INDEX_SQL)
def class_index(spark, sf_dir):
    """W6 + S9 + S10 + O1: folder names -> class ids -> index lines -> parsed back."""
    d = corpus(spark, sf_dir)
    idx = C.label_index(d, "source")
    return C.parse_class_index(C.class_index_lines(idx))


@register("label_index", sql="""
WITH n AS (SELECT DISTINCT lower(lang) AS label_name FROM documents)
SELECT label_name, CAST(dense_rank() OVER (ORDER BY label_name) - 1 AS INTEGER) AS label,
       CAST(count(*) OVER () AS BIGINT) AS n_labels
FROM n
""")
def label_index(spark, sf_dir):
    """W7 + A7: sorted distinct labels, dense ids and their number."""
    idx = C.label_index(corpus(spark, sf_dir), "lang")
    n = idx.agg(F.count("*").alias("n_labels")).withColumn("_one", F.lit(1))
    return (idx.withColumn("_one", F.lit(1)).join(F.broadcast(n), "_one").drop("_one"))


LABELLED_SQL = f"""
WITH c AS ({O.CORPUS}),
i AS (SELECT label_name, CAST(dense_rank() OVER (ORDER BY label_name) - 1 AS INTEGER) AS label
      FROM (SELECT DISTINCT lower(lang) AS label_name FROM c))
SELECT c.*, i.label FROM c LEFT JOIN i ON lower(c.lang) = i.label_name
"""


def labelled_corpus(spark, sf_dir):
    d = corpus(spark, sf_dir)
    return C.with_label(d, "lang", C.label_index(d, "lang"))


@register("one_hot", sql=f"""
WITH l AS ({LABELLED_SQL}), k AS (SELECT count(DISTINCT label) AS k FROM l)
SELECT doc_id, label, array_to_string(list_transform(range(0, k), lambda i: CAST(i = label AS INTEGER)), ',') AS one_hot
FROM l, k
""")
def one_hot(spark, sf_dir):
    """K9 on the language label."""
    l = labelled_corpus(spark, sf_dir)
    out = C.one_hot(l.select("doc_id", "label"))
    return out.select("doc_id", "label", F.array_join("one_hot", ",").alias("one_hot"))


@register("filter_class", sql=f"""
WITH l AS ({LABELLED_SQL}) SELECT doc_id, label FROM l WHERE label IN (3)
""")
def filter_class(spark, sf_dir):
    """P1 + P5: keep one class (label cast to int first)."""
    l = labelled_corpus(spark, sf_dir).withColumn("label", F.col("label").cast("int"))
    return l.filter(F.col("label").isin(3)).select("doc_id", "label")


# labels as a file gives them: numbers as text, some of them none
_TEXT_LABEL_SQL = """CASE doc_id % 25 WHEN 3 THEN NULL WHEN 5 THEN 'n/a' WHEN 7 THEN ' ' || CAST(label AS STRING) || ' ' WHEN 9 THEN CAST(label AS STRING) || '.0'
  WHEN 11 THEN CAST(label AS STRING) || '.5' WHEN 13 THEN '99999999999' WHEN 15 THEN '' ELSE CAST(label AS STRING) END"""


@register("label_cast", sql=f"""
WITH l AS ({LABELLED_SQL})
SELECT doc_id, CASE WHEN doc_id % 25 NOT IN (3, 5, 11, 13, 15) THEN CAST(label AS VARCHAR) END AS label,
       CASE doc_id % 25 WHEN 5 THEN 'not a number' WHEN 15 THEN 'not a number' WHEN 11 THEN 'not whole' WHEN 13 THEN 'out of range' END AS reason
FROM l
""")
def label_cast(spark, sf_dir):
    """P5: text labels to integers; those that are none are rejected with a reason."""
    rows, rejects = C.whole_labels(labelled_corpus(spark, sf_dir).select("doc_id", F.expr(_TEXT_LABEL_SQL).alias("label")))
    none = F.lit(None).cast("string")
    return rows.select("doc_id", F.col("label").cast("string").alias("label"), none.alias("reason")).unionByName(
        rejects.select("doc_id", none.alias("label"), "reason"))


@register("drop_class0", sql=f"""
WITH l AS ({LABELLED_SQL}) SELECT doc_id, label FROM l WHERE label <> 0
""")
def drop_class0(spark, sf_dir):
    """P2."""
    l = labelled_corpus(spark, sf_dir)
    return l.filter(F.col("label") != 0).select("doc_id", "label")


@register("fill_null_text", sql="""
SELECT d.doc_id, coalesce(d.text, '') AS text,
       coalesce(CAST(l.quality AS VARCHAR), '') AS quality, coalesce(CAST(l.toxic AS VARCHAR), '') AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def fill_null_text(spark, sf_dir):
    """P3 + P4: documents left join labels; null text and missing labels -> ''."""
    d = corpus(spark, sf_dir).na.fill("", ["text"])
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select("doc_id", "text", C.to_str_or_empty("quality").alias("quality"),
                    C.to_str_or_empty("toxic").alias("toxic"))


@register("sample_rows", sql="""
SELECT CAST(doc_id AS VARCHAR) AS id, lang FROM documents
ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR) LIMIT 5
""")
def sample_rows(spark, sf_dir):
    """P10, deterministic: five rows in md5(seed|id) order (a top-n)."""
    d = corpus(spark, sf_dir).select("id", "lang")
    return C.deterministic_sample(d, 5, "id", 42)


def stored_copies(spark, sf_dir):
    """Every document at position 2; some ids again before it, some after it."""
    d = corpus(spark, sf_dir).select("doc_id", "text")
    return (d.withColumn("pos", F.lit(2))
            .unionByName(d.filter("doc_id % 4 = 0").select("doc_id", F.lit("zzz first").alias("text"), F.lit(1).alias("pos")))
            .unionByName(d.filter("doc_id % 6 = 0").select("doc_id", F.lit("aaa last").alias("text"), F.lit(3).alias("pos"))))


@register("lookup_text", sql="""
WITH r AS (SELECT doc_id * 2 AS doc_id FROM labels),
s AS (SELECT doc_id, 2 AS pos, text FROM documents
      UNION ALL SELECT doc_id, 1, 'zzz first' FROM documents WHERE doc_id % 4 = 0
      UNION ALL SELECT doc_id, 3, 'aaa last' FROM documents WHERE doc_id % 6 = 0),
f AS (SELECT doc_id, arg_min(text, pos) AS text FROM s GROUP BY doc_id)
SELECT r.doc_id, coalesce(f.text, '') AS text FROM r LEFT JOIN f ON r.doc_id = f.doc_id
""")
def lookup_text(spark, sf_dir):
    """Text for requested ids (some absent -> '')."""
    req = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("doc_id"))
    return C.lookup_text(req, stored_copies(spark, sf_dir), "doc_id", "doc_id", "pos").select("doc_id", "text")


# --- incremental append ---------------------------------------------------------

_APPEND_EXISTING = f"SELECT filename AS id, filename, {O.clean_text('text')} AS text, lower(lang) AS label_name, 'existing' AS origin FROM ({O.CORPUS}) WHERE doc_id % 2 = 0"


@register("corpus_append", sql=f"""
WITH ex AS ({_APPEND_EXISTING}),
inc AS (SELECT filename AS id, filename, text, lower(lang) AS label_name FROM ({O.CORPUS}))
SELECT * FROM ex
UNION ALL
SELECT id, filename, {O.clean_text('text')} AS text, label_name, 'new' AS origin
FROM inc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.id = inc.id)
""")
def corpus_append(spark, sf_dir):
    """S11 append, filename ids: the stored corpus is the even half, the batch is
    every document; known ids are skipped *before* the cleaning expression."""
    d = corpus(spark, sf_dir)
    existing = (d.filter(F.col("doc_id") % 2 == 0)
                .select(F.col("filename").alias("id"), "filename", TX.clean_text("text").alias("text"),
                        F.lower("lang").alias("label_name"), F.lit("existing").alias("origin")))
    incoming = d.select(F.col("filename").alias("id"), "filename", "text", F.lower("lang").alias("label_name"))
    new = incoming.join(existing.select("id"), "id", "left_anti")
    new = new.select("id", "filename", TX.clean_text("text").alias("text"), "label_name",
                     F.lit("new").alias("origin"))
    return existing.unionByName(new)


HASH_CORPUS_SQL = f"""
WITH ex AS (SELECT md5(text) AS id, filename, text, label_name FROM ({_APPEND_EXISTING})),
inc AS (SELECT filename, {O.clean_text('text')} AS text, lower(lang) AS label_name FROM ({O.CORPUS}))
SELECT * FROM ex
UNION ALL
SELECT md5(text) AS id, filename, text, label_name FROM inc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.id = md5(inc.text))
"""


@register("corpus_append_hash", sql=f"""
WITH ex AS (SELECT md5(text) AS id, filename, text, label_name, 'existing' AS origin
            FROM ({_APPEND_EXISTING})),
inc AS (SELECT filename, {O.clean_text('text')} AS text, lower(lang) AS label_name FROM ({O.CORPUS}))
SELECT * FROM ex
UNION ALL
SELECT md5(text) AS id, filename, text, label_name, 'new' AS origin
FROM inc WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.id = md5(inc.text))
""")
def corpus_append_hash(spark, sf_dir):
    """S11 append, content-hash ids (D1): cleaning must run before the skip;
    copies inside the batch are all kept (Q5)."""
    d = corpus(spark, sf_dir)
    existing = C.hash_ids(d.filter(F.col("doc_id") % 2 == 0)).select(
        "id", "filename", "text", F.lower("lang").alias("label_name"), F.lit("existing").alias("origin"))
    incoming = C.hash_ids(d).select("id", "filename", "text", F.lower("lang").alias("label_name"),
                                    F.lit("new").alias("origin"))
    return C.append_new(existing, incoming, "id")
