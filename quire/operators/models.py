"""Text classifiers on Spark ML.

The reference trains neural networks on one machine; the contract kept here
is class-weighted multiclass training on text, validation-based selection,
scoring with the original labels, evaluation and per-token explanations.
Training passes run on the executors (tree-aggregated gradients) over all
labelled rows; only model parameters - bounded by the vocabulary
cap and the number of classes - ever live on the driver.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.keywords import sentences
from quire.operators.reports import class_weights, report_of_pairs
from quire.operators.splits import stratified_holdout
from quire.session import reliable_checkpoint, staged

VOCAB_SIZE = 20000
TOKEN_PATTERN = r"[^\p{L}\p{N}]+"
#: Passes of every fit; it ends before when the objective moves by less than TOL.
MAX_ITER, TOL = 50, 1e-6
#: Penalties tried in turn by ``tune``; rounds without gain after which it stops.
REGS, PATIENCE = (1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001, 0.0), 5


def vocabulary(tokens: DataFrame, column: str = "tokens", size: int = VOCAB_SIZE) -> list[str]:
    """The ``size`` most frequent words of all rows, ties by the word; counts are
    summed per word before anything is ranked."""
    words = tokens.select(F.explode_outer(column).alias("word")).filter(F.col("word").isNotNull())
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]  # at most ``size`` rows
    if not top:
        raise ValueError("no words to fit on")
    return top


def word_counts(rows: DataFrame, text: str, keep: list[str], vocab_size: int = VOCAB_SIZE):
    """Tokeniser, vocabulary and inverse document frequencies fitted on all ``rows``, and the
    rows as ``keep`` and counts of words (``tf``), written once: what every fit reads,
    neither texts nor tokens."""
    tok = RegexTokenizer(inputCol=text, outputCol="tokens", pattern=TOKEN_PATTERN, toLowercase=True)
    tokens = tok.transform(rows)
    cv = CountVectorizerModel.from_vocabulary(vocabulary(tokens, size=vocab_size), inputCol="tokens", outputCol="tf")
    tf = staged(cv.transform(tokens).select("tf", *keep), "counts")
    return tok, cv, IDF(inputCol="tf", outputCol="features").fit(tf), tf


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """A3 weights joined on.  One row per class, as many as a fit's coefficients
    have, so they are broadcast: a join by class would put all rows of one in one task."""
    w = class_weights(df, label).select(label, "weight")
    return df.join(F.broadcast(w), label, "left")


def fit_sample(df: DataFrame, text: str = "text", rows: int | None = None) -> DataFrame:
    """All rows, unless the caller names how many at most: then the first by a hash of the text.  Counts per 16 more
    bits of the hash (at most 65,536 a round) find the cut, so texts are neither
    sorted nor gathered.  Of the copies of the text at the cut a random part is
    taken, four standard deviations below what is left."""
    if rows is None:
        return df
    place = F.xxhash64(text)
    hashes = df.select(place.alias("_h"))
    cut, left = None, rows
    for bits in (48, 32, 16, 0):
        inside = hashes if cut is None else hashes.filter(F.shiftright("_h", bits + 16) == cut)
        counts = sorted(tuple(r) for r in inside.groupBy(F.shiftright("_h", bits)).agg(F.count(F.lit(1))).collect())
        if cut is None and sum(n for _, n in counts) <= rows:
            return df
        for cut, n in counts:  # noqa: B007
            if n > left:
                break
            left -= n
    chance = max(0.0, left - 4 * math.sqrt(left)) / n
    return df.filter((place < cut) | ((place == cut) & (F.rand(42) < chance)))


def log_loss(scored: DataFrame, n_classes: int) -> float:
    """Mean of -log of the true class's probability (labels unseen in training left out)."""
    p = F.element_at(vector_to_array("probability"), F.col("label_idx").cast("int") + 1)
    known = scored.filter(F.col("label_idx") < n_classes)
    return known.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("x")).first()["x"]


def tune(df: DataFrame, label: str = "label", text: str = "text", validation: DataFrame | None = None,
         regs=REGS, patience: int = PATIENCE, max_iter: int = MAX_ITER, weighted: bool = True,
         seed: int = 42) -> tuple[PipelineModel, list[tuple[float, float, bool]]]:
    """M1-M3: fit on ``df``, choose by ``validation`` (or a stratified 10 % of
    ``df``): one fit per penalty, strongest first; the best model is kept and
    the search stops after ``patience`` rounds without gain.  Returns the model
    and (penalty, validation log loss, kept) per round.

    Tokeniser, vocabulary, inverse document frequencies and label index are
    fitted once; only the penalties' fits repeat."""
    data = df.withColumn(label, F.col(label).cast("string"))
    if validation is None and len(regs) > 1:
        parts = stratified_holdout(data.withColumn("_k", F.sha2(F.concat_ws("|", text, label), 256)), 0.1, label, "_k", seed)
        parts = parts.drop("_k")
        data, validation = (parts.filter(F.col("split") == x).drop("split") for x in ("train", "validation"))
    # all rows, dealt out evenly whatever the files' layout
    dealt = fit_sample(data.select(label, text), text).hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc", handleInvalid="error")
    try:
        indexer_model = indexer.fit(dealt)
        data = indexer_model.transform(with_class_weights(dealt, label) if weighted else dealt)
        tok, cv, idf, tf = word_counts(data, text, ["label_idx", *(["weight"] if weighted else [])])
    finally:
        dealt.unpersist()
    # scoring tables may hold labels unseen in training: index them past the end
    indexer_model.setHandleInvalid("keep")
    features = PipelineModel(stages=[indexer_model, tok, cv, idf])
    held = None
    if validation is not None:
        held = cv.transform(tok.transform(indexer_model.transform(validation.withColumn(label, F.col(label).cast("string")))))
        held = staged(held.select("label_idx", "tf"), "held-counts")
    history: list[tuple[float, float, bool]] = []
    best, best_loss, since = None, float("inf"), 0
    for reg in regs:
        lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter, tol=TOL, regParam=reg,
                                family="multinomial", weightCol="weight" if weighted else None)
        model = lr.fit(idf.transform(tf))
        loss = log_loss(model.transform(idf.transform(held)), len(indexer_model.labels)) if held is not None else 0.0
        history.append((float(reg), float(loss), False))
        if best is None or loss < best_loss:
            best, best_loss, since = model, loss, 0
            kept = len(history) - 1
        else:
            since += 1
        if since >= patience:
            break
    history[kept] = (*history[kept][:2], True)
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=indexer_model.labels)
    return PipelineModel(stages=[*features.stages, best, back]), history


def train(df: DataFrame, label: str = "label", text: str = "text", max_iter: int = MAX_ITER, reg: float = 0.01,
          weighted: bool = True) -> PipelineModel:
    """M1 with a given penalty; the last stage gives back original labels (M5)."""
    return tune(df, label, text, regs=(reg,), max_iter=max_iter, weighted=weighted)[0]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M5 + O4: predicted original label and the class probabilities; the
    input key columns are carried through (no positional alignment, J9)."""
    out = model.transform(df).withColumn("probabilities", vector_to_array("probability"))
    # O4 spelled out: 0-based position of the largest probability
    return out.withColumn("argmax", F.array_position("probabilities", F.array_max("probabilities")) - 1)


def evaluate(model: PipelineModel, df: DataFrame, label: str = "label") -> DataFrame:
    """M4 + A10: the per-class report with accuracy and averages, and rows
    ``log_loss`` and ``unseen labels`` (their value in ``f1``; their rows in
    ``support``).  The table is scored once, down to one row per (truth,
    prediction); rows with a label unseen in training are counted apart (Q14)."""
    labels = model.stages[0].labels
    scored = model.transform(df.withColumn(label, F.col(label).cast("string")))
    p = F.element_at(vector_to_array("probability"), F.least(F.col("label_idx").cast("int") + 1, F.lit(len(labels))))
    seen = F.col("label_idx") < len(labels)
    pairs = reliable_checkpoint(scored.groupBy(F.col(label).alias("label"), F.col("predicted_label").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(seen).alias("n_seen"),
        F.sum(F.when(seen, -F.log(F.greatest(p, F.lit(1e-15))))).alias("loss")))
    one = pairs.agg(F.sum("n").alias("n"), F.sum("n_seen").alias("seen"), F.sum("loss").alias("loss"))
    none = F.lit(None).cast("double")
    more = one.select(F.explode(F.array(
        F.struct(F.lit("log_loss").alias("class"), none.alias("precision"), none.alias("recall"),
                 (F.col("loss") / F.col("seen")).alias("f1"), F.col("seen").cast("long").alias("support")),
        F.struct(F.lit("unseen labels").alias("class"), none.alias("precision"), none.alias("recall"), none.alias("f1"),
                 (F.col("n") - F.col("seen")).cast("long").alias("support")))).alias("r")).select("r.*")
    return report_of_pairs(pairs.filter("n_seen > 0").select("label", "prediction", "n")).unionByName(more)


def model_tables(spark: SparkSession, model: PipelineModel) -> tuple[DataFrame, DataFrame]:
    """Vocabulary with idf, and the coefficient table ``(class, term,
    coef)`` - both bounded by the vocabulary cap x number of classes.  The
    class's intercept is its row for term -1."""
    cv, idf, lr = model.stages[2], model.stages[3], model.stages[4]
    idf_values = idf.idf.toArray()  # one JVM round trip, not one per term
    vocab = spark.createDataFrame([(w, i, float(idf_values[i])) for i, w in enumerate(cv.vocabulary)],
                                  "word string, term int, idf double")
    coef, start = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    rows = [(k, -1, float(start[k])) for k in range(len(start))]
    rows += [(k, j, float(coef[k, j])) for k in range(coef.shape[0]) for j in range(coef.shape[1])]
    return vocab, spark.createDataFrame(rows, "class int, term int, coef double")


def explain_tokens(spark: SparkSession, model: PipelineModel, df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """M8 (re-aimed): every distinct token of every document, ranked by how hard
    it pushes toward the predicted class: contribution = tf x idf x class
    coefficient, 0 for a word outside the vocabulary.  ``margin`` is the sum of
    a document's contributions and the class's intercept."""
    vocab, coef = model_tables(spark, model)
    scored = model.transform(df).select(key, "tokens", F.col("prediction").cast("int").alias("class"))
    tf = scored.select(key, "class", F.explode_outer("tokens").alias("word")).filter(F.col("word").isNotNull()) \
        .groupBy(key, "class", "word").agg(F.count(F.lit(1)).alias("tf"))
    # both as large as the model: a join by word or term would put all rows of a frequent one in one task
    j = tf.join(F.broadcast(vocab), "word", "left").join(F.broadcast(coef), ["class", "term"], "left")
    j = j.withColumn("contribution", F.coalesce(F.col("tf") * F.col("idf") * F.col("coef"), F.lit(0.0)))
    start = coef.filter("term = -1").select("class", F.col("coef").alias("intercept"))
    w = Window.partitionBy(key)
    j = j.join(F.broadcast(start), "class").withColumn("margin", F.sum("contribution").over(w) + F.col("intercept"))
    rank = F.row_number().over(w.orderBy(F.desc("contribution"), F.col("word")))
    return j.select(key, rank.alias("rank"), "word", "tf", "contribution", "margin")


def explain_sentences(spark: SparkSession, model: PipelineModel, df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """M8 at sentence level (re-aimed): every sentence, ranked by what its tokens
    add toward the predicted class (sum of idf x coefficient; 0 without a known
    word), with the document's ``margin`` as in ``explain_tokens``."""
    vocab, coef = model_tables(spark, model)
    scored = model.transform(df).select(key, text, F.col("prediction").cast("int").alias("class"))
    sents = scored.select(key, "class", F.posexplode_outer(sentences(F.col(text))).alias("sentence_pos", "sentence")) \
        .filter(F.col("sentence_pos").isNotNull())
    toks = sents.select(key, "class", "sentence_pos", "sentence",
                        F.explode_outer(F.split(F.lower("sentence"), TOKEN_PATTERN)).alias("word"))
    j = toks.join(F.broadcast(vocab), "word", "left").join(F.broadcast(coef), ["class", "term"], "left")
    per = j.groupBy(key, "class", "sentence_pos", "sentence").agg(
        F.sum(F.coalesce(F.col("idf") * F.col("coef"), F.lit(0.0))).alias("contribution"))
    start = coef.filter("term = -1").select("class", F.col("coef").alias("intercept"))
    w = Window.partitionBy(key)
    per = per.join(F.broadcast(start), "class").withColumn("margin", F.sum("contribution").over(w) + F.col("intercept"))
    rank = F.row_number().over(w.orderBy(F.desc("contribution"), F.col("sentence_pos")))
    return per.select(key, rank.alias("rank"), "sentence_pos", "sentence", "contribution", "margin")


# --- field presence (M6, M7, P8) ------------------------------------------------------

def train_presence(df: DataFrame, flags: list[str], text: str = "text", max_iter: int = MAX_ITER):
    """M6: one shared feature pipeline, one binary logistic regression per flag,
    over all rows."""
    rows = fit_sample(df.select(text, *flags), text).hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tok, cv, idf, tf = word_counts(rows, text, flags)
    finally:
        rows.unpersist()
    data = idf.transform(tf)
    models = {}
    for f in flags:
        lr = LogisticRegression(featuresCol="features", labelCol=f, maxIter=max_iter, tol=TOL,
                                probabilityCol=f"prob_{f}", rawPredictionCol=f"raw_{f}", predictionCol=f"pred_{f}")
        models[f] = lr.fit(data.withColumn(f, F.col(f).cast("double")))
    return PipelineModel(stages=[tok, cv, idf]), models


def predict_presence(feats: PipelineModel, models: dict, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M7 + P8: presence probability, and flag = probability strictly above the threshold."""
    out = feats.transform(df)
    for f, m in models.items():
        out = m.transform(out).withColumn(f"probability_{f}", vector_to_array(f"prob_{f}")[1])
        out = out.withColumn(f"predicted_{f}", (F.col(f"probability_{f}") > threshold).cast("int"))
        out = out.drop(f"prob_{f}", f"raw_{f}", f"pred_{f}")
    return out.drop("tokens", "tf", "features")
