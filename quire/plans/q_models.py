"""Queries: training, tuning, scoring, explanation, field presence, the batch
job (M1-M9, A10, O4, P8, P9, P11, S13, J9).

What a fit yields has no SQL; the queries state what SQL can: exact ids, tokens,
sentences, supports and fields, and flags that the model's numbers agree with
each other (or with the truth to a stated degree)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import extract as X
from quire.functions import keywords as KW
from quire.operators import annotations as A
from quire.operators import attention as AT
from quire.operators import batch as B
from quire.operators import models as M
from quire.operators import reports as R
from quire.operators import results as RS
from quire.operators import splits as SP
from quire.operators import vocab as V
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus, invoice_text
from quire.plans.q_annotations import WIDE_SQL, wide
from quire.plans.q_corpus import LABELLED_SQL
from quire.plans.q_features import HAN_SQL, _sql_sentences, lowered_segments
from quire.plans.q_splits import stratified_sql
from quire.session import reliable_checkpoint, staged
from quire.sources import files as FS

SEED = 42
ACCURATE = 0.96

# the language's class number sorts like its name, so the quotas agree
SPLIT_SQL = stratified_sql(0.8, 0.1, 0.1, LABELLED_SQL)
TEST_SQL = f"SELECT d.* FROM documents d JOIN ({SPLIT_SQL}) s ON d.doc_id = s.doc_id WHERE s.split = 'test'"
TOKENS_SQL = f"list_filter(string_split_regex(lower(text), {O.q(M.TOKEN_PATTERN)}), lambda x: x <> '')"


def _split_corpus(spark, sf_dir):
    d = corpus(spark, sf_dir).select("doc_id", "id", "text", F.col("lang").alias("label"))
    # in even parts: a fit and the scores read them, not row groups of any size
    d = staged(d.hint("rebalance"), "documents")
    # split once, not anew for every count, fit and score
    return staged(SP.stratified_split(d, "label", "id", train=0.8, test=0.1, validation=0.1, seed=SEED), "split")


def _fit(spark, sf_dir):
    s = _split_corpus(spark, sf_dir)
    return M.train(s.filter(F.col("split") == "train")), s.filter(F.col("split") == "test")


@register("train_classifier", sql=f"""
SELECT doc_id, lang AS label, true AS argmax_is_prediction, true AS accurate FROM ({TEST_SQL})
""")
def train_classifier(spark, sf_dir):
    """M1 + M5 + O4: class-weighted classifier on the language label, applied to
    the test split: the largest probability names the prediction, and at least
    96 % of the predictions are right."""
    model, test = _fit(spark, sf_dir)
    labels = F.array(*[F.lit(x) for x in model.stages[0].labels])
    p = M.predict(model, test).select("doc_id", "label", "predicted_label", F.element_at(
        labels, F.col("argmax").cast("int") + 1).alias("by_argmax"))
    right = F.avg((F.col("predicted_label") == F.col("label")).cast("double"))
    accuracy = p.agg((right >= ACCURATE).alias("accurate"))
    p = p.select("doc_id", "label", (F.col("by_argmax") == F.col("predicted_label")).alias("argmax_is_prediction"), F.lit(1).alias("_one"))
    return p.join(F.broadcast(accuracy.withColumn("_one", F.lit(1))), "_one").drop("_one")


@register("tune_classifier", sql="SELECT true AS first_penalty_tried, true AS one_kept, true AS kept_is_best, true AS stops_in_time "
                                 "FROM (SELECT count(*) FROM documents)")
def tune_classifier(spark, sf_dir):
    """M2 + M3: the validation split chooses among penalties; one model is kept,
    the one with the least loss, and the search ends after five rounds without gain."""
    s = _split_corpus(spark, sf_dir)
    _, history = M.tune(s.filter(F.col("split") == "train"), validation=s.filter(F.col("split") == "validation"), seed=SEED)
    rounds = spark.createDataFrame([(i, *h) for i, h in enumerate(history)], "k int, reg double, loss double, kept boolean")
    return rounds.agg(
        (F.min_by("reg", "k") == M.REGS[0]).alias("first_penalty_tried"), (F.count_if("kept") == 1).alias("one_kept"),
        (F.min(F.when(F.col("kept"), F.col("loss"))) == F.min("loss")).alias("kept_is_best"),
        (F.max("k") - F.max(F.when(F.col("kept"), F.col("k"))) <= M.PATIENCE).alias("stops_in_time"))


@register("evaluate_model", sql=f"""
WITH t AS ({TEST_SQL}), n AS (SELECT count(*) AS n FROM t)
SELECT lang AS class, count(*) AS support, true AS agrees FROM t GROUP BY lang
UNION ALL SELECT x, n, true FROM n, (VALUES ('accuracy'), ('macro avg'), ('weighted avg'), ('log_loss')) v(x)
UNION ALL SELECT 'unseen labels', 0, true FROM n
""")
def evaluate_model(spark, sf_dir):
    """M4 + A10: the report over the model's test predictions; each row's f1
    (accuracy, loss) agrees with one computed row by row from the predictions."""
    model, test = _fit(spark, sf_dir)
    report = M.evaluate(model, test)
    p = M.predict(model, test).select("label", "predicted_label", F.element_at(
        "probabilities", F.col("label_idx").cast("int") + 1).alias("p"))
    p = reliable_checkpoint(p)
    truth, guess = F.col("label"), F.col("predicted_label")
    one = p.agg(F.avg((truth == guess).cast("double")).alias("accuracy"), F.avg(-F.log("p")).alias("log_loss"))
    both = p.select(F.explode(F.array(F.struct(truth.alias("class"), (truth == guess).alias("hit")),
                                      F.struct(guess.alias("class"), (truth == guess).alias("hit")))).alias("r")).select("r.*")
    # f1 = 2 tp / (support + predicted): a hit is counted on both sides
    per = both.groupBy("class").agg(F.avg(F.col("hit").cast("double")).alias("want"))
    want = per.unionByName(one.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("accuracy").alias("want")),
        F.struct(F.lit("log_loss").alias("class"), F.col("log_loss").alias("want")))).alias("r")).select("r.*"))
    near = F.abs(F.col("f1") - F.col("want")) < 1e-9
    return report.join(want, "class", "left").select(
        "class", "support", F.coalesce(near, F.lit(True)).alias("agrees"))


@register("predict_class", sql="SELECT doc_id, true AS is_probability FROM documents")
def predict_class(spark, sf_dir):
    """M5 + O4: every document's predicted original label; its probability is the
    largest of a distribution over the classes."""
    s = _split_corpus(spark, sf_dir)
    model = M.train(s.filter(F.col("split") == "train"))
    p = M.predict(model, s.select("doc_id", "text"))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    ok = ((F.abs(total - 1) < 1e-9) & (F.array_max("probabilities") >= 1 / len(model.stages[0].labels))
          & F.col("predicted_label").isin(*model.stages[0].labels))
    return p.select("doc_id", ok.alias("is_probability"))


def _margins(model, df):
    """Raw margin of the predicted class."""
    return model.transform(df).select("doc_id", F.element_at(
        vector_to_array("rawPrediction"), F.col("prediction").cast("int") + 1).alias("raw"))


@register("explain_tokens", sql=f"""
SELECT doc_id, word, count(*) AS tf, true AS adds_up FROM (SELECT doc_id, unnest({TOKENS_SQL}) AS word FROM ({TEST_SQL}))
GROUP BY doc_id, word
""")
def explain_tokens(spark, sf_dir):
    """M8 (re-aimed): every token of every test document; a document's
    contributions and the intercept add up to the model's margin."""
    model, test = _fit(spark, sf_dir)
    e = M.explain_tokens(spark, model, test, "doc_id").join(_margins(model, test), "doc_id")
    return e.select("doc_id", "word", "tf", (F.abs(F.col("margin") - F.col("raw")) < 1e-6).alias("adds_up"))


@register("model_roundtrip", sql=f"SELECT doc_id, true AS same FROM ({TEST_SQL})")
def model_roundtrip(spark, sf_dir):
    """The fitted pipeline saved and loaded again predicts the same."""
    model, test = _fit(spark, sf_dir)
    path = FS.staging_dir(spark, "model")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    before = model.transform(test).select("doc_id", "predicted_label", "probability")
    after = back.transform(test).select("doc_id", F.col("predicted_label").alias("p2"), F.col("probability").alias("q2"))
    return before.join(after, "doc_id").select("doc_id", (
        (F.col("predicted_label") == F.col("p2")) & (vector_to_array("probability") == vector_to_array("q2"))).alias("same"))


def _presence_data(spark, sf_dir):
    w = wide(spark, sf_dir)
    flags = staged(w.select("id", "text", *A.presence_flags(w)), "flags")
    names = SP.split_701515(flags.select("id"), "id", SEED)
    return staged(flags.join(names, "id"), "presence")


FLAGS = [f"has_{f}" for f in X.FIELD_KEYS]
PRESENCE_SQL = WIDE_SQL + """,
b AS (SELECT id, md5('42|' || id) AS h FROM wide),
r AS (SELECT id, row_number() OVER (ORDER BY h, id) - 1 AS r, count(*) OVER () AS n FROM b),
p AS (SELECT w.*, CASE WHEN r < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN r < floor(n * CAST(0.85 AS DOUBLE)) THEN 'valid'
                       ELSE 'test' END AS split
      FROM (SELECT id, """ + ", ".join(f"CAST({O.strip_ws(f)} <> '' AS INTEGER) AS has_{f}" for f in X.FIELD_KEYS) + """ FROM wide) w
      JOIN r ON w.id = r.id)
"""


@register("train_presence", sql=PRESENCE_SQL + " UNION ALL ".join(
    f"SELECT '{f}' AS flag, count(*) AS n, CAST(sum({f}) AS BIGINT) AS positives, true AS fitted FROM p WHERE split = 'train'"
    for f in FLAGS))
def train_presence(spark, sf_dir):
    """M6: six binary presence outputs on shared text features, with the
    training split's rows and positives of each."""
    data = _presence_data(spark, sf_dir).filter(F.col("split") == "train")
    feats, models = M.train_presence(data, FLAGS)
    fitted = {f: m.numFeatures == len(feats.stages[1].vocabulary) for f, m in models.items()}
    counts = data.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in FLAGS])
    return counts.select(F.explode(F.array(*[F.struct(
        F.lit(f).alias("flag"), F.col("n"), F.col(f).alias("positives"), F.lit(fitted[f]).alias("fitted")) for f in FLAGS]))
        .alias("r")).select("r.*")


@register("presence_predict", sql=PRESENCE_SQL + f"SELECT id, {', '.join(FLAGS)}, true AS accurate FROM p WHERE split = 'test'")
def presence_predict(spark, sf_dir):
    """M7 + P8 + J9: the test split's flags by id; at least 96 % of the
    predicted flags are the true ones."""
    data = _presence_data(spark, sf_dir)
    feats, models = M.train_presence(data.filter(F.col("split") == "train"), FLAGS)
    out = M.predict_presence(feats, models, data.filter(F.col("split") == "test"))
    hits = sum((F.col(f) == F.col(f"predicted_{f}")).cast("int") for f in FLAGS)
    out = reliable_checkpoint(out.select("id", *FLAGS, hits.alias("hits"), F.lit(1).alias("_one")))
    rate = out.agg((F.avg("hits") >= ACCURATE * len(FLAGS)).alias("accurate"), F.max("_one").alias("_one"))
    return out.join(F.broadcast(rate), "_one").drop("_one", "hits")


def batch_files(spark, sf_dir):
    """Files as the binary source gives them: invoices and documents as text
    files, and one file in fifty that cannot be used."""
    inv = invoice_text(spark, sf_dir).select(F.col("o_orderkey").alias("k"), "text", F.lit("invoice").alias("label"),
                                             F.concat(F.lit("/in/inv_"), F.col("o_orderkey").cast("string")).alias("stem"))
    # documents are dealt out evenly like orders: their texts are cleaned and searched by all tasks, whatever the row groups
    docs = corpus(spark, sf_dir).select(F.col("doc_id").alias("k"), "text", F.lit("other").alias("label"),
                                        F.concat(F.lit("/in/doc_"), F.col("id")).alias("stem")).hint("rebalance")
    f = inv.unionByName(docs)
    odd = F.col("k") % 50
    ext = F.when(odd == 1, ".exe").when(odd == 2, ".pdf").otherwise(".txt")
    content = F.when(odd == 3, F.lit(None).cast("binary")).when(odd == 4, F.unhex(F.lit("FFFE20"))).otherwise(F.encode("text", "UTF-8"))
    return f.select("label", F.concat("stem", ext).alias("path"), content.alias("content"))


BATCH_SQL = f"""
WITH inv AS ({O.INVOICE_TEXT}),
f AS (SELECT o_orderkey AS k, text, true AS is_invoice, 'inv_' || CAST(o_orderkey AS VARCHAR) AS stem FROM inv
      UNION ALL SELECT doc_id, text, false, 'doc_' || CAST(doc_id AS VARCHAR) FROM documents),
r AS (SELECT stem || CASE k % 50 WHEN 1 THEN '.exe' WHEN 2 THEN '.pdf' ELSE '.txt' END AS filename, is_invoice, text,
             CASE k % 50 WHEN 1 THEN {O.q(B.UNSUPPORTED)} WHEN 2 THEN {O.q(B.NEEDS_TEXT)} WHEN 3 THEN {O.q(B.UNREADABLE)}
                         WHEN 4 THEN {O.q(B.NO_TEXT)} END AS error FROM f)
"""


@register("classify_then_extract", sql=BATCH_SQL + f"""
SELECT filename, upper(regexp_extract(filename, '[.](.*)$', 1)) AS file_type, error,
       CASE WHEN error IS NULL AND is_invoice THEN
         {" || ';' || ".join(f"'{f}=' || " + O.extract_field('text', f) for f in sorted(X.FIELD_KEYS))} END AS invoice_fields,
       true AS gate_holds
FROM r
""")
def classify_then_extract(spark, sf_dir):
    """M9 + P9 + P11: a batch of invoices, other documents and bad files.  A bad
    file is one row with its error; fields, from the raw text, are there exactly
    where the class is invoice, which all invoices get."""
    r = _batch(spark, sf_dir)
    gate = F.coalesce(F.col("classification") == "Invoice", F.lit(False)) == F.col("fields").isNotNull()
    return r.select("filename", "file_type", "error",
                    F.when(F.col("filename").startswith("inv_"), RS.render_fields("fields")).alias("invoice_fields"),
                    gate.alias("gate_holds"))


def _read_batch(spark, sf_dir):
    """The batch's files, decoded and cleaned once; the splits, the fits and the job read them."""
    return staged(B.readable(batch_files(spark, sf_dir)).select("path", "filename", "raw", "text", "error", "label"), "batch")


def _batch(spark, sf_dir):
    files = _read_batch(spark, sf_dir)
    good = files.filter("error IS NULL").select("path", "text", "label")
    s = SP.stratified_split(good, "label", "path", train=0.8, test=0.1, validation=0.1, seed=SEED)
    return B.process_files(files, M.train(s.filter(F.col("split") == "train")))


@register("batch_presence", sql=BATCH_SQL + f"""
SELECT filename, error, CASE WHEN error IS NULL AND is_invoice THEN
         {" || ';' || ".join(f"'{f}=' || " + O.extract_field('text', f) for f in sorted(X.FIELD_KEYS))} END AS invoice_fields,
       true AS as_predicted
FROM r
""")
def batch_presence(spark, sf_dir):
    """M9 + X13: the batch job with the presence model in it, fitted on a training
    split's own extractions (P7).  A field's value is the cascade's where the model says it is
    there, else a status text; each agrees with the probability predicted apart."""
    files = _read_batch(spark, sf_dir)
    good = files.filter("error IS NULL").select("path", "text", "raw", "label")
    s = SP.stratified_split(good, "label", "path", train=0.8, test=0.1, validation=0.1, seed=SEED)
    train = s.filter(F.col("split") == "train")
    flags = staged(train.select("text", "label", *[(X.extract_field(F.col("raw"), f) != "").cast("int").alias(f"has_{f}") for f in X.FIELD_KEYS]), "flags")
    presence = M.train_presence(flags, FLAGS)
    r = B.process_files(files, M.train(flags), presence=presence)
    alone = M.predict_presence(*presence, files.select("filename", "raw", "text"))
    wanted = F.map_from_arrays(F.array(*[F.lit(f) for f in X.FIELD_KEYS]), F.array(*[
        RS.field_value(X.extract_field(F.col("raw"), f), F.col(f"probability_has_{f}")) for f in X.FIELD_KEYS]))
    j = r.join(alone.select("filename", RS.render_fields(wanted).alias("wanted")), "filename")
    given = RS.render_fields("fields")
    return j.select("filename", "error", F.when(F.col("filename").startswith("inv_"), given).alias("invoice_fields"),
                    (F.col("fields").isNull() | (given == F.col("wanted"))).alias("as_predicted"))


@register("batch_stats", sql=BATCH_SQL + """,
c AS (SELECT CASE WHEN error IS NOT NULL THEN 'Error' ELSE 'Classified' END AS outcome, count(*) AS n FROM r GROUP BY 1)
SELECT outcome, n, true AS mostly_right FROM c
""")
def batch_stats(spark, sf_dir):
    """M9 + A14: the batch job's statistics, summed over the classes; at most one
    file in a hundred is in another class than its own."""
    r = _batch(spark, sf_dir)
    wrong = ((F.col("classification") == "Invoice") != F.col("filename").startswith("inv_")).cast("int")
    known = r.withColumn("classification", F.when(wrong == 1, "Wrong").otherwise(F.col("classification")))
    stats = R.run_stats(known).groupBy(F.when(F.col("classification") == "Error", "Error").otherwise("Classified").alias("outcome"))
    return stats.agg(F.sum("n").alias("n"), (F.coalesce(F.max(F.when(F.col("classification") == "Wrong", F.col("pct"))), F.lit(0.0))
                                             <= 1.0).alias("mostly_right"))


@register("explain_sentences", sql=f"""
WITH t AS (SELECT doc_id, {_sql_sentences('text')} AS s FROM ({TEST_SQL}))
SELECT doc_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS sentence_pos, unnest(s) AS sentence, true AS adds_up FROM t
""")
def explain_sentences(spark, sf_dir):
    """M8 at sentence level: every sentence of every test document; a document's
    sentences and the intercept add up to the model's margin."""
    model, test = _fit(spark, sf_dir)
    e = M.explain_sentences(spark, model, test, "doc_id").join(_margins(model, test), "doc_id")
    return e.select("doc_id", "sentence_pos", "sentence", (F.abs(F.col("margin") - F.col("raw")) < 1e-6).alias("adds_up"))


# --- the two-level attention model on the sentence grid --------------------------------

#: Passes of the fit that is broken off and taken up again, and where it breaks.
SHORT_PASSES, BREAK_AT = 8, 3


def _grids(spark, sf_dir):
    """Sentence grids of all documents, one more than the largest id, and the language's split."""
    segs = lowered_segments(spark, sf_dir)
    vocab = V.rank_vocabulary(segs.select("doc_id", F.flatten("segs").alias("w")), "doc_id", "w", 1)
    grid = V.encode_hierarchical(segs, "doc_id", "segs", vocab)
    words = min(V.NUM_WORDS, vocab.agg(F.coalesce(F.max("idx"), F.lit(0)) + 1).first()[0])
    split = _split_corpus(spark, sf_dir).select("doc_id", "label", "split")
    rows = staged(grid.join(split, "doc_id"), "grids")  # mostly padding: small as columns
    return {name: rows.filter(F.col("split") == name) for name in SP.SPLITS}, int(words)


@register("tune_passes", sql="SELECT true AS one_kept, true AS kept_is_best, true AS stops_in_time, true AS resumed_equals_unbroken "
                             "FROM (SELECT count(*) FROM documents)")
def tune_passes(spark, sf_dir):
    """M2: passes over the training split with the validation loss after each; the
    best one is kept.  A fit that breaks off goes on from its state and ends like an unbroken one."""
    parts, words = _grids(spark, sf_dir)

    def fit(**options):
        return AT.fit(parts["train"], parts["validation"], words, key="doc_id", max_passes=SHORT_PASSES, **options)

    class Broken(Exception):
        pass

    def break_off(number):
        if number == BREAK_AT:
            raise Broken

    state = FS.staging_dir(spark, "attention-state")
    unbroken = fit()
    try:
        fit(state=state, after_pass=break_off)
    except Broken:
        pass  # the stand-in for a lost driver
    resumed = fit(state=state)
    same = resumed.history == unbroken.history and bool((resumed.flat == unbroken.flat).all())
    rounds = spark.createDataFrame([(i, *h) for i, h in enumerate(resumed.history)], "k int, loss double, held double, kept boolean")
    return rounds.agg((F.count_if("kept") == 1).alias("one_kept"), (F.min(F.when(F.col("kept"), F.col("held"))) == F.min("held")).alias("kept_is_best"),
                      (F.max("k") - F.max(F.when(F.col("kept"), F.col("k"))) <= AT.PATIENCE).alias("stops_in_time"),
                      F.lit(same).alias("resumed_equals_unbroken"))


@register("attention_weights", sql=f"""
WITH g AS ({HAN_SQL}), t AS ({TEST_SQL})
SELECT t.doc_id, CAST(len(list_filter(string_split(g.grid, '|'), lambda r: regexp_matches(r, '[1-9]'))) AS INTEGER) AS n_sentences,
       true AS sum_to_one, true AS adds_up, true AS accurate
FROM t JOIN g ON t.doc_id = g.doc_id
""")
def attention_weights(spark, sf_dir):
    """M8: the weight of every sentence (and word) of the test documents in a fitted
    two-level model; a document's weights sum to 1, its margin is the model's, and at
    least 96 % of the predictions are right."""
    parts, words = _grids(spark, sf_dir)
    model = AT.fit(parts["train"], parts["validation"], words, key="doc_id")
    scored = reliable_checkpoint(AT.score(model, parts["test"]))
    has = F.filter(F.arrays_zip(F.col("grid").alias("g"), F.col("sentence_weights").alias("w"), F.col("word_weights").alias("ws")),
                   lambda r: F.exists(r["g"], lambda i: i > 0))

    def total(array):
        return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)

    ones = (F.abs(total("sentence_weights") - 1) < 1e-9) & F.forall(has, lambda r: F.abs(total(r["ws"]) - 1) < 1e-9)
    # the margin is the predicted class's: its log probability, and no other class has more
    adds = F.element_at("probabilities", F.array_position(F.array(*[F.lit(x) for x in model.labels]), F.col("predicted_label")).cast("int")) == F.array_max("probabilities")
    right = scored.agg((F.avg((F.col("predicted_label") == F.col("label")).cast("double")) >= ACCURATE).alias("accurate"), F.lit(1).alias("_one"))
    out = scored.select("doc_id", F.size(has).alias("n_sentences"), F.when(F.size(has) > 0, ones).otherwise(True).alias("sum_to_one"),
                        (adds & F.col("margin").isNotNull()).alias("adds_up"), F.lit(1).alias("_one"))
    return out.join(F.broadcast(right), "_one").drop("_one")
