"""Queries: distributions, summaries, evaluation and run reports (A1-A9, A14,
M10, P9, N6, X13, X14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import extract as X
from quire.functions import keywords as KW
from quire.functions import scalars as S
from quire.functions import text as TX
from quire.operators import reports as R
from quire.operators import results as RS
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus, invoice_text
from quire.plans.q_annotations import WIDE_SQL, wide
from quire.plans.q_corpus import LABELLED_SQL, labelled_corpus
from quire.sources.tables import table

D = "CAST({} AS DOUBLE)".format


@register("class_counts", sql=f"WITH l AS ({LABELLED_SQL}) SELECT label, count(*) AS n FROM l GROUP BY label")
def class_counts(spark, sf_dir):
    """A1."""
    return R.class_counts(labelled_corpus(spark, sf_dir))


@register("class_share", sql=f"""
WITH l AS ({LABELLED_SQL}), c AS (SELECT label, count(*) AS n FROM l GROUP BY label)
SELECT label, n, {D('n')} * {D('100.0')} / {D('sum(n) OVER ()')} AS pct FROM c
""")
def class_share(spark, sf_dir):
    """A2."""
    return R.class_share(labelled_corpus(spark, sf_dir))


@register("class_weights", sql=f"""
WITH l AS ({LABELLED_SQL}), c AS (SELECT label, count(*) AS n FROM l GROUP BY label)
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS class_index, n,
       sum(n) OVER () / (count(*) OVER () * n) AS weight
FROM c
""")
def class_weights(spark, sf_dir):
    """A3."""
    return R.class_weights(labelled_corpus(spark, sf_dir))


@register("length_describe", sql="""
WITH v AS (SELECT length(coalesce(text, '')) AS len FROM documents)
SELECT count(len) AS count, round(avg(len), 6) AS mean, round(stddev_samp(len), 6) AS std,
       CAST(min(len) AS DOUBLE) AS min, round(quantile_cont(len, 0.25), 6) AS p25,
       round(quantile_cont(len, 0.5), 6) AS p50, round(quantile_cont(len, 0.75), 6) AS p75,
       CAST(max(len) AS DOUBLE) AS max
FROM v
""")
def length_describe(spark, sf_dir):
    """A4 + T16: describe() of the text length."""
    d = corpus(spark, sf_dir).select(TX.char_length("text").alias("len"))
    out = R.describe_length(d, "len")
    return out.select("count", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min",
                      *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("length_by_class", sql=f"""
WITH l AS ({LABELLED_SQL}), v AS (SELECT label, CAST(length(text) AS DOUBLE) AS v FROM l),
q AS (SELECT label, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
      FROM v GROUP BY label)
SELECT v.label, min(v) AS min, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, max(v) AS max,
       min(v) FILTER (WHERE v >= q25 - 1.5 * (q75 - q25)) AS whisker_lo,
       max(v) FILTER (WHERE v <= q75 + 1.5 * (q75 - q25)) AS whisker_hi,
       CAST(count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS BIGINT) AS n_outliers
FROM v JOIN q ON v.label = q.label GROUP BY v.label, q25, q50, q75
""")
def length_by_class(spark, sf_dir):
    """A5: per-class five-number summary and whiskers of the text length."""
    l = labelled_corpus(spark, sf_dir).select("label", F.length("text").alias("len"))
    out = R.five_numbers_by_class(l, "len", "label")
    return out.select("label", "min", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")], "max",
                      "whisker_lo", "whisker_hi", F.col("n_outliers").cast("bigint").alias("n_outliers"))


@register("amount_describe", sql="""
SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       CAST(min(l_extendedprice) AS DOUBLE) AS min, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.75), 6) AS p75, CAST(max(l_extendedprice) AS DOUBLE) AS max
FROM lineitem
""")
def amount_describe(spark, sf_dir):
    """A4 on a money column: describe() of the line items' prices."""
    out = R.describe_amount(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.select("count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                      *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("amount_by_class", sql="""
WITH v AS (SELECT l_returnflag AS label, CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem),
q AS (SELECT label, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
      FROM v GROUP BY label)
SELECT v.label, min(v) AS min, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, max(v) AS max,
       min(v) FILTER (WHERE v >= q25 - 1.5 * (q75 - q25)) AS whisker_lo,
       max(v) FILTER (WHERE v <= q75 + 1.5 * (q75 - q25)) AS whisker_hi,
       CAST(count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS BIGINT) AS n_outliers
FROM v JOIN q ON v.label = q.label GROUP BY v.label, q25, q50, q75
""")
def amount_by_class(spark, sf_dir):
    """A5 on a money column: five numbers and whiskers of the line items' prices
    per return flag."""
    out = R.amounts_by_class(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), "l_extendedprice"), "l_extendedprice")
    return out.select("label", "min", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")], "max",
                      "whisker_lo", "whisker_hi", F.col("n_outliers").cast("bigint").alias("n_outliers"))


@register("null_counts", sql="""
SELECT count(*) FILTER (WHERE d.doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE text IS NULL) AS text,
       count(*) FILTER (WHERE lang IS NULL) AS lang, count(*) FILTER (WHERE quality IS NULL) AS quality,
       count(*) FILTER (WHERE toxic IS NULL) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def null_counts(spark, sf_dir):
    """A6 on documents left join labels."""
    d = corpus(spark, sf_dir).select("doc_id", "text", "lang")
    j = d.join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "text", "lang", "quality", "toxic")
    return R.null_counts(j)


LONG_DOC = 1000  # fixed rule standing in for a model: long documents predicted "good"
PAIRS_SQL = f"""SELECT l.quality AS label, CAST(length(d.text) >= {LONG_DOC} AS INTEGER) AS prediction
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def _pairs(spark, sf_dir):
    d = corpus(spark, sf_dir).select("doc_id", "text")
    j = d.join(table(spark, sf_dir, "labels"), "doc_id")
    return j.select(F.col("quality").alias("label"), (F.length("text") >= LONG_DOC).cast("int").alias("prediction"))


@register("confusion_matrix", sql=f"""
WITH p AS ({PAIRS_SQL})
SELECT label, count(*) FILTER (WHERE prediction = 0) AS pred_0, count(*) FILTER (WHERE prediction = 1) AS pred_1
FROM p GROUP BY label
""")
def confusion_matrix(spark, sf_dir):
    """Quality label x length-rule prediction."""
    return R.confusion_matrix(_pairs(spark, sf_dir), "label", "prediction", [0, 1])


REPORT_SQL = f"""
WITH p AS ({PAIRS_SQL}),
pc AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction),
cls AS (SELECT label FROM pc UNION SELECT prediction FROM pc),
c AS (SELECT cls.label,
             coalesce((SELECT sum(n) FROM pc WHERE pc.label = cls.label), 0) AS support,
             coalesce((SELECT sum(n) FROM pc WHERE pc.prediction = cls.label), 0) AS n_pred,
             coalesce((SELECT sum(n) FROM pc WHERE pc.label = cls.label AND pc.prediction = cls.label), 0) AS tp
      FROM cls),
m AS (SELECT label, support, tp,
             CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m),
t AS (SELECT sum(support) AS N, sum(tp) AS TP, count(*) AS K, sum(precision) AS sp, sum(recall) AS sr, sum(f1) AS sf,
             sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM f)
SELECT CAST(label AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(TP / N, 6), CAST(N AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', round(sp / K, 6), round(sr / K, 6), round(sf / K, 6), CAST(N AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', round(wp / N, 6), round(wr / N, 6), round(wf / N, 6), CAST(N AS BIGINT) FROM t
"""


@register("classification_report", sql=REPORT_SQL)
def classification_report(spark, sf_dir):
    """A9."""
    r = R.classification_report(_pairs(spark, sf_dir), "label", "prediction")
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("presence_report", sql=WIDE_SQL + f""",
pr AS (SELECT wide.id, {", ".join(
    f"CAST({O.strip_ws(f)} <> '' AS INTEGER) AS t_{f}" for f in X.FIELD_KEYS)},
       {", ".join(
    "CAST(CASE " + " ".join(f"WHEN strpos(lower(wide.text), {O.q(v.lower())}) > 0 THEN 1" for v in KW.FIELD_KEYWORDS[f])
    + f" ELSE 0 END AS INTEGER) AS p_{f}" for f in X.FIELD_KEYS)}
       FROM wide)
{" UNION ALL ".join(
    f"SELECT '{f}' AS field, count(*) FILTER (WHERE t_{f} = 1 AND p_{f} = 1) AS tp, "
    f"count(*) FILTER (WHERE t_{f} <> 1 AND p_{f} = 1) AS fp, count(*) FILTER (WHERE t_{f} = 1 AND p_{f} <> 1) AS fn, "
    f"count(*) FILTER (WHERE t_{f} <> 1 AND p_{f} <> 1) AS tn, "
    f"(count(*) FILTER (WHERE t_{f} = 1 AND p_{f} = 1) + count(*) FILTER (WHERE t_{f} <> 1 AND p_{f} <> 1)) / count(*) AS accuracy FROM pr"
    for f in X.FIELD_KEYS)}
""")
def presence_report(spark, sf_dir):
    """Field-presence truth (flattened annotations) against a keyword
    detector used as the presence predictor."""
    w = wide(spark, sf_dir)
    from quire.operators.annotations import presence_flags
    flags = w.select("id", "text", *presence_flags(w))
    preds = flags.select("*", *[KW.first_variant("text", KW.FIELD_KEYWORDS[f]).isNotNull().cast("int").alias(f"p_{f}")
                                for f in X.FIELD_KEYS])
    return R.binary_outcomes(preds, [(f, f"has_{f}", f"p_{f}") for f in X.FIELD_KEYS])


# --- run results ------------------------------------------------------------------

# the event log stands in for a run log: one upload per event
UPLOAD_PREFIX, ERROR_PREFIX, GATED_EVENT = "upload_", "Error processing file: ", "purchase"

RUN_SQL = f"""
WITH e AS (SELECT *, {O.q(UPLOAD_PREFIX)} || CAST(event_id AS VARCHAR) || '.' ||
                  ({"[" + ", ".join(O.q(x) for x in S.ALLOWED_EXTENSIONS) + "]"})[CAST(user_id % {len(S.ALLOWED_EXTENSIONS)} AS INTEGER) + 1] AS filename
           FROM events),
r AS (SELECT event_id, filename,
             CASE WHEN event_type = 'error' THEN NULL ELSE upper(substring(event_type, 1, 1)) || lower(substring(event_type, 2)) END AS classification,
             CASE WHEN event_type = 'error' THEN {O.q(ERROR_PREFIX)} || props END AS error,
             upper(regexp_extract(filename, '\\.([^.]*)$', 1)) AS file_type,
             CASE WHEN event_type = 'purchase' THEN 'amount=' || CAST(value AS VARCHAR) || ';user=' || CAST(user_id AS VARCHAR) END AS fields
      FROM e)
"""


def run_log(spark, sf_dir):
    exts = F.array(*[F.lit(x) for x in S.ALLOWED_EXTENSIONS])
    e = table(spark, sf_dir, "events")
    runs = e.select(
        "event_id", F.concat(F.lit(UPLOAD_PREFIX), F.col("event_id").cast("string"), F.lit("."), F.element_at(
            exts, (F.col("user_id") % len(S.ALLOWED_EXTENSIONS)).cast("int") + 1)).alias("filename"),
        F.col("event_type").alias("status"), F.concat(F.lit(ERROR_PREFIX), F.col("props")).alias("message"),
        F.create_map(F.lit("amount"), F.col("value").cast("string"), F.lit("user"), F.col("user_id").cast("string")).alias("fields"))
    return RS.result_rows(runs, GATED_EVENT)


@register("run_results", sql=RUN_SQL + "SELECT event_id, filename, classification, error, file_type, fields FROM r")
def run_results(spark, sf_dir):
    """P9 + N6 + P11: one result or error row per uploaded file; the field map
    only for the gated class."""
    r = run_log(spark, sf_dir)
    return r.select("event_id", "filename", "classification", "error", "file_type",
                    RS.render_fields("fields").alias("fields"))


@register("run_stats", sql=RUN_SQL + """,
t AS (SELECT CASE WHEN error IS NOT NULL THEN 'Error' ELSE classification END AS classification FROM r),
c AS (SELECT classification, count(*) AS n FROM t GROUP BY classification)
SELECT classification, n, round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 1) AS pct FROM c
""")
def run_stats(spark, sf_dir):
    """A14."""
    return R.run_stats(run_log(spark, sf_dir))


def _prob_sql(i: int) -> str:
    return f"CAST((o_orderkey * {i + 3}) % 10 AS DOUBLE) / 10.0"


FIELD_STATUS_SQL = f"""
WITH inv AS ({O.INVOICE_TEXT}),
c AS (SELECT o_orderkey, {O.clean_text('text')} AS text FROM inv),
v AS (SELECT o_orderkey, {", ".join(f"{O.extract_field('text', f)} AS v_{f}, {_prob_sql(i)} AS p_{f}"
                                    for i, f in enumerate(X.FIELD_KEYS))} FROM c)
{" UNION ALL ".join(
    f"SELECT o_orderkey, '{f}' AS field, '{f.replace('_', ' ').title()}' AS label, "
    f"CASE WHEN p_{f} > 0.5 THEN (CASE WHEN v_{f} <> '' THEN v_{f} ELSE {O.q(RS.PRESENT_NO_VALUE)} END) "
    f"ELSE {O.q(RS.NOT_PRESENT)} END AS value FROM v" for f in X.FIELD_KEYS)}
"""


@register("field_status", sql=FIELD_STATUS_SQL)
def field_status(spark, sf_dir):
    """X13 + X14: hybrid field status on cleaned invoices, with a fixed rule
    standing in for the presence model's probability."""
    inv = invoice_text(spark, sf_dir).select("o_orderkey", TX.clean_text("text").alias("text"))
    probs = {f: ((F.col("o_orderkey") * (i + 3)) % 10).cast("double") / 10.0 for i, f in enumerate(X.FIELD_KEYS)}
    return RS.field_status(inv, "o_orderkey", "text", probs)
