"""Invariants and hand-written cases for the corpus, split, annotation,
vocabulary, OCR and spelling operators."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quire.functions import scalars as S
from quire.functions import segment as SG
from quire.operators import annotations as A
from quire.operators import corpus as C
from quire.operators import ocr as OC
from quire.operators import reports as R
from quire.operators import spell as SPL
from quire.operators import splits as SP
from quire.operators import vocab as V
from quire.operators.indexing import global_index
from quire.plans.fixtures import corpus


def test_global_index_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = global_index(df, ["k"], "i", num_partitions=7).collect()
    assert sorted(r.i for r in out) == list(range(5000))
    assert all(r.i == r.k for r in out)


def test_splits_disjoint_complete(spark, sf001):
    d = corpus(spark, sf001).select("id", F.col("lang").alias("label"))
    s = SP.stratified_split(d, "label", "id", 0.6, 0.2, 0.2, 42)
    n = d.count()
    assert s.count() == n and s.select("id").distinct().count() == n
    sizes = {r.split: r.n for r in s.groupBy("split").agg(F.count("*").alias("n")).collect()}
    import math
    assert sizes["test"] == math.ceil(0.2 * n)
    with pytest.raises(ValueError):
        SP.stratified_split(d, "label", "id", 0.7, 0.2, 0.2, 42)


def test_stratified_single_row_class(spark):
    df = spark.createDataFrame([(str(i), "a") for i in range(9)] + [("x", "b")], "id string, label string")
    s = SP.stratified_split(df, "label", "id", 0.8, 0.1, 0.1, 42)
    assert s.count() == 10
    assert s.filter(F.col("split") == "test").count() == 1


def test_split_701515_cuts(spark):
    df = spark.range(0, 100).select(F.col("id").cast("string").alias("id"))
    s = {r.split: r.n for r in SP.split_701515(df).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert s == {"train": 70, "valid": 15, "test": 15}


def test_append_keeps_batch_copies_and_is_idempotent(spark):
    existing = spark.createDataFrame([("a", "t1")], "id string, text string")
    batch = spark.createDataFrame([("a", "t1"), ("b", "t2"), ("b", "t2")], "id string, text string")
    once = C.append_new(existing, batch)
    assert sorted(r.id for r in once.collect()) == ["a", "b", "b"]
    twice = C.append_new(once, batch)
    assert twice.count() == once.count()
    empty = spark.createDataFrame([], "id string, text string")
    assert C.append_new(empty, batch).count() == 3


def test_class_index_parse(spark):
    lines = spark.createDataFrame([("0 bank_statements",), ("3 invoices",), ("bad",), ("x y",)], "value string")
    rows = sorted((r.class_id, r.name, r.display) for r in C.parse_class_index(lines).collect())
    assert rows == [(0, "bank_statements", "Bank_statements"), (3, "invoices", "Invoices")]


def test_scalars(spark):
    df = spark.createDataFrame([("dir/Report.PDF", 610.625 * 1024), ("noext", 100.0), (".bashrc", 5e9),
                                ("a..txt", 2048.0)], "p string, n double")
    rows = df.select(S.extension("p").alias("e"), S.route(S.extension("p")).alias("r"),
                     S.format_size("n").alias("s"), S.allowed_file("p").alias("ok"),
                     S.type_description(S.extension("p")).alias("t")).collect()
    assert [r.e for r in rows] == [".pdf", "", "", ".txt"]
    assert [r.r for r in rows] == ["pdf", "unsupported", "unsupported", "text"]
    assert rows[0].s == "610.62 KB" and rows[1].s == "100.00 B" and rows[2].s == "4.66 GB"
    assert [r.ok for r in rows] == [True, False, False, True]
    assert rows[0].t == "PDF Document" and rows[1].t == " File"
    d = spark.createDataFrame([("invoices",), ("Other",), ("misc",)], "c string")
    assert [r[0] for r in d.select(S.display_class("c")).collect()] == ["Invoice", "Other", "Misc"]
    n = spark.createDataFrame([("  my résumé/final v2?.txt ",)], "c string")
    assert n.select(S.safe_name("c")).first()[0] == "my_resume_final_v2.txt"


def test_annotations_build_and_flatten(spark):
    docs = spark.createDataFrame([
        ("d1", "INV-1", "", "", "Acme", "", ""),
        ("d2", "", "", "", "", "", ""),
    ], "id string, invoice_number string, invoice_date string, due_date string, issuer_name string, "
       "recipient_name string, total_amount string")
    images, anns = A.build(docs, "id")
    a = anns.orderBy("id").collect()
    assert [(r.id, r.image_id, r.category_id) for r in a][:2] == [(0, 0, 1), (1, 0, 4)]
    assert len(a) == 8 and all(r.is_placeholder for r in a[2:])
    assert a[2].text == "Sample value for category 1"


def test_to_wide_last_nonempty_wins_and_value_fallback(spark):
    images = spark.createDataFrame([(0, "d1")], "id long, file_name string")
    anns = spark.createDataFrame([
        (0, 0, 4, "First", None), (1, 0, 4, "Second", None), (2, 0, 1, None, " V-9 "),
        (3, 0, 2, "x", None), (4, 0, 2, "   ", None)],
        "id long, image_id long, category_id int, text string, value string")
    docs = spark.createDataFrame([("d1", "body", 3, 1)], "id string, text string, label int, pos int")
    w = A.to_wide(images, anns, A.categories(spark), docs).first()
    assert w.issuer_name == "Second"
    assert w.invoice_number == "V-9"
    assert w.invoice_date == ""  # whitespace-only value wins over "x", stored stripped


def test_vocab_rank_ties_by_first_appearance(spark):
    df = spark.createDataFrame([(0, "b a"), (1, "a c b"), (2, "d")], "d long, t string")
    toks = df.select("d", SG.flat_tokens("t").alias("w"))
    v = {r.word: r.idx for r in V.rank_vocabulary(toks, "d", "w", 2).collect()}
    assert v == {"b": 2, "a": 3, "c": 4, "d": 5}
    enc = V.encode_flat(toks, "d", "w", V.rank_vocabulary(toks, "d", "w", 2), num_words=4, maxlen=3)
    got = {r.d: r.ids for r in enc.collect()}
    assert got[1] == [3, 1, 2] and got[2] == [1, 0, 0]


def test_segment_edges(spark):
    df = spark.createDataFrame([(None,), ("",), ("Dear John. Total paid 5.00 today!",)], "t string")
    r = [x[0] for x in df.select(SG.segment("t")).collect()]
    assert r[0] == [[""]] and r[1] == [["UNK"]]
    assert r[2][0] == ["dear", "john", "DOC_CORRESPONDENCE"]
    assert r[2][1] == ["total", "paid", "5.00", "today", "DOC_FINANCIAL"]


def test_best_candidate_ties_and_table_text(spark):
    c = spark.createDataFrame([(1, 0, "a", "ab1"), (1, 1, "b", "xy2"), (2, 0, "a", "")],
                              "doc int, pos int, name string, text string")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc int")
    b = {r.doc: (r.name, r.text) for r in OC.best_candidate(c, "doc", "pos", docs=docs).collect()}
    assert b[1] == ("a", "ab1") and b[3][1] == OC.OCR_FAILED
    w = spark.createDataFrame([(1, 1, 30, 0, 90.0, "B"), (1, 1, 10, 1, 80.0, "A"), (1, 2, 5, 2, 0.0, "x"),
                               (1, 2, 7, 3, 50.0, " ")], "doc int, line_num int, left int, pos int, conf double, text string")
    t = OC.table_text(w, "doc").first().table_text
    assert t == OC.TABLE_START + "A  B\n" + OC.TABLE_END


def test_spell_brute_force(spark):
    dictionary = spark.createDataFrame([("hello", 10), ("help", 5), ("world", 7), ("word", 9)], "term string, cnt long")
    texts = spark.createDataFrame([(1, "helo wrld world xyzzy Hello"), (2, "")], "k int, text string")
    out = {r.k: r.text for r in SPL.correct(texts, ["k"], "text", dictionary).collect()}
    # helo: hello (d1, cnt 10) beats help (d1, cnt 5); wrld: world (d1) beats word (d2)
    assert out[1] == "hello world world xyzzy hello"
    assert out[2] == ""


def test_reports(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "y int, p int")
    rep = {r["class"]: r for r in R.classification_report(df, "y", "p").collect()}
    assert rep["0"].precision == 1.0 and rep["0"].recall == 0.5
    assert abs(rep["accuracy"].f1 - 0.75) < 1e-12
    q = R.exact_quantiles(spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v double"), "v",
                          [0.25, 0.5]).first()
    assert q.q25 == 1.75 and q.q50 == 2.5


def test_write_corpus_modes(spark, tmp_path):
    from quire.sources.files import write_corpus
    path = str(tmp_path / "corpus")
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    assert write_corpus(spark, rows, path, "production").count() == 2
    assert write_corpus(spark, rows, path, "append").count() == 2
    again = spark.createDataFrame([("b", "y"), ("c", "z"), ("c", "z")], "id string, text string")
    assert write_corpus(spark, again, path, "append").count() == 2
    assert spark.read.parquet(path).count() == 4
    write_corpus(spark, rows, path, "overwrite")
    assert spark.read.parquet(path).count() == 2


def test_unseen_label_reported(spark):
    from quire.operators import models as M
    train = spark.createDataFrame([(f"alpha beta {i}", "a") for i in range(20)] +
                                  [(f"gamma delta {i}", "b") for i in range(20)], "text string, label string")
    m = M.train(train, max_iter=10)
    test = spark.createDataFrame([("alpha beta", "a"), ("gamma", "b"), ("new words", "zzz")], "text string, label string")
    report = {r["class"]: r for r in M.evaluate(m, test).collect()}
    assert report["unseen labels"].support == 1 and report["accuracy"].f1 == 1.0
    assert report["a"].support == 1 and report["log_loss"].f1 < 0.7
    p = M.predict(m, test).select("predicted_label", "argmax").collect()
    assert [r.predicted_label for r in p][:2] == ["a", "b"]


def test_decode_drops_bad_bytes(spark):
    from quire.sources.files import decode_text
    df = spark.createDataFrame([(bytearray(b"ab\xffc\xc3\xa9"),)], "b binary")
    assert df.select(decode_text("b")).first()[0] == "abcé"


def test_global_index_with_hot_value(spark):
    # a third of the rows share one value: ties are broken by the unique key and
    # the range partitioner spreads the hot value over several partitions
    df = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"),
                                     F.col("id"))
    out = global_index(df, ["v", "id"], "i", num_partitions=6)
    rows = out.orderBy("i").collect()
    assert [r.i for r in rows] == list(range(9000))
    assert [(r.v, r.id) for r in rows] == sorted((r.v, r.id) for r in rows)
    per_part = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_part) > 1


def test_staged_forms_equal_column_forms(spark, sf001):
    from quire.functions import keywords as KW
    d = corpus(spark, sf001).select("doc_id", "text")
    a = d.select("doc_id", SG.segment("text").alias("segs"))
    b = SG.with_segments(d, "text", ["doc_id"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    k1 = d.select("doc_id", *KW.extract_fields_from_text("text"))
    k2 = KW.keyword_fields(d, "text", ["doc_id"])
    assert k1.exceptAll(k2).count() == 0 and k2.exceptAll(k1).count() == 0


def test_written_set_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "INV-1", "", "", "Acme", "", "")],
                                 "id string, invoice_number string, invoice_date string, due_date string, "
                                 "issuer_name string, recipient_name string, total_amount string")
    images, anns = A.build(docs, "id")
    A.write_set(spark, images, anns, str(tmp_path / "set"))
    imgs, back, cats = A.read_set(spark, str(tmp_path / "set"))
    assert imgs.count() == 1 and back.count() == 2 and cats.count() == 6
    assert imgs.columns == [f.name for f in A.IMAGE_TYPE]


def test_first_stored_row_wins(spark):
    docs = spark.createDataFrame([("d1", "aaa second", 1, 2), ("d1", "zzz first", 3, 1)], "id string, text string, label int, pos int")
    images = spark.createDataFrame([(0, "d1")], "id long, file_name string")
    anns = spark.createDataFrame([], "id long, image_id long, category_id int, text string, value string")
    w = A.to_wide(images, anns, A.categories(spark), docs).first()
    assert (w.text, w.label) == ("zzz first", 3)
    req = spark.createDataFrame([("d1",), ("d2",)], "k string")
    got = {r.k: r.text for r in C.lookup_text(req, docs, "k", "id", "pos").collect()}
    assert got == {"d1": "zzz first", "d2": ""}


def test_null_labels_split_like_a_class(spark):
    rows = [(str(i), None if i < 40 else "a") for i in range(200)]
    s = SP.stratified_split(spark.createDataFrame(rows, "id string, label string"), "label", "id", 0.8, 0.1, 0.1, 42)
    got = {(r.label, r.split): r.n for r in s.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {(None, "train"): 32, (None, "validation"): 4, (None, "test"): 4,
                   ("a", "train"): 128, ("a", "validation"): 16, ("a", "test"): 16}


def test_page_without_words_gets_no_table(spark):
    words = spark.createDataFrame([("a", 1, 5, 0, 90, "x"), ("b", 1, 5, 0, -1, "y")],
                                  "doc string, line_num int, left int, pos int, conf int, text string")
    pages = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "doc string, text string")
    got = {r.doc: r.text for r in OC.append_table_text(pages, OC.table_text(words, "doc"), "doc").collect()}
    assert got == {"a": "A\n" + OC.TABLE_START + "x\n" + OC.TABLE_END, "b": "B\n" + OC.TABLE_START + OC.TABLE_END, "c": "C"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_of_a_hot_value(spark):
    import numpy as np
    values = [5.0] * 900 + [float(i) for i in range(100)]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    q = R.exact_quantiles(df, "v", [0.25, 0.5, 0.95], "g").first()
    assert [q.q25, q.q50, q.q95] == list(np.quantile(values, [0.25, 0.5, 0.95]))
    # copies of a value are summed before the shuffle: no exchange sees the rows
    counts = R.value_counts(df, "v", "g")
    assert counts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] <= 100
    assert _plan(R.exact_quantiles(df, "v", [0.5], "g")).count("Scan") <= 2


def test_radix_quantiles_equal_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    groups = {"spread": rng.normal(0, 1e5, 501), "tiny": rng.normal(0, 1e-300, 40), "hot": np.array([7.25] * 4000 + [-1.0, 8.5]),
              "zeros": np.array([0.0, -0.0, 0.0]), "one": np.array([-3.5]), "signs": np.array([-1e308, 1e308, -1.0, 1.0]),
              "infinite": np.array([float("inf")] * 3 + [1.0]), None: rng.uniform(-5, 5, 30)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("spread", None), ("only null", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    out = {r[0]: r[1:] for r in R.radix_quantiles(df, "v", probs, "g").collect()}
    assert set(out) == set(groups)
    for g, vs in groups.items():
        if g != "infinite":
            assert np.allclose(out[g], np.quantile(vs, probs), rtol=1e-14, atol=0), g
    assert out["infinite"][2:] == (float("inf"),) * 3 and out["infinite"][0] == 1.0
    whole = R.radix_quantiles(df.filter("g = 'hot'"), "v", [0.5]).collect()
    assert [tuple(r) for r in whole] == [(7.25,)]
    assert R.radix_quantiles(df.limit(0), "v", probs, "g").count() == 0


def test_radix_selection_has_no_window_over_values(spark):
    df = spark.range(100_000).selectExpr("'a' AS g", "id * 1.5 AS v")
    five = R.amounts_by_class(df, "v", "g").first()
    assert (five["min"], five.q25, five.q50, five.q75, five["max"], five.n_outliers) == (0.0, 37499.625, 74999.25, 112498.875, 149998.5, 0)
    assert five.asDict() == R.five_numbers_by_class(df, "v", "g").first().asDict()


def test_vocabulary_is_a_hash_aggregate(spark):
    toks = spark.createDataFrame([(1, ["a", "b"])], "d long, w array<string>")
    e = toks.select(F.col("d").alias("_d"), F.posexplode_outer("w").alias("_p", "word"))
    place = F.col("_d").cast("decimal(20,0)") * F.lit(2 ** 31).cast("decimal(10,0)") + F.col("_p")
    plan = _plan(e.groupBy("word").agg(F.count(F.lit(1)), F.min(place)))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert V.vocabulary_size(toks, "w").first().n_words == 2


def test_tune_keeps_the_best_and_stops(spark):
    from quire.operators import models as M
    rows = spark.createDataFrame([(f"alpha beta {i}", "a") for i in range(40)] + [(f"gamma delta {i}", "b") for i in range(40)],
                                 "text string, label string")
    model, history = M.tune(rows, regs=(10.0, 0.01, 20.0, 30.0, 40.0), patience=2, max_iter=10)
    assert [h[0] for h in history] == [10.0, 0.01, 20.0, 30.0] and [h[2] for h in history] == [False, True, False, False]
    assert M.predict(model, rows).filter("predicted_label <> label").count() == 0


def test_explanations_list_everything(spark):
    from quire.operators import models as M
    rows = spark.createDataFrame([(i, f"alpha beta word{i}. Second here!", "ab"[i % 2]) for i in range(20)],
                                 "doc_id long, text string, label string")
    m = M.train(rows, max_iter=5)
    odd = spark.createDataFrame([(1, "unknownone alpha. Alpha unknowntwo? zzz")], "doc_id long, text string").withColumn("label", F.lit("a"))
    tokens = {r.word: r for r in M.explain_tokens(spark, m, odd, "doc_id").collect()}
    assert set(tokens) == {"unknownone", "alpha", "unknowntwo", "zzz"} and tokens["zzz"].contribution == 0 and tokens["alpha"].tf == 2
    found = M.explain_sentences(spark, m, odd, "doc_id").collect()
    assert sorted(r.sentence_pos for r in found) == [0, 1, 2]


def test_batch_isolates_bad_files(spark):
    from quire.operators import batch as B
    from quire.operators import models as M
    from quire.operators import models as M
    from quire.operators import reports
    train = spark.createDataFrame([(f"invoice no {i} total", "invoice") for i in range(20)] + [(f"dear friend {i} hello", "letter") for i in range(20)],
                                  "text string, label string")
    files = spark.createDataFrame([
        ("/x/a.txt", bytearray(b"Invoice No: A-12 total: $5.00")), ("/x/b.txt", bytearray(b"dear friend hello")),
        ("/x/c.exe", bytearray(b"invoice")), ("/x/d.txt", None), ("/x/e.txt", bytearray(b"\xff \n")), ("/x/f.pdf", bytearray(b"x"))],
        "path string, content binary")
    out = {r.filename: r for r in B.process_files(files, M.train(train, max_iter=10)).collect()}
    assert len(out) == 6 and out["a.txt"].classification == "Invoice" and out["a.txt"].fields["invoice_number"] == "A-12"
    assert out["b.txt"].classification == "Letter" and out["b.txt"].fields is None
    assert [out[n].error for n in ("c.exe", "d.txt", "e.txt", "f.pdf")] == [B.UNSUPPORTED, B.UNREADABLE, B.NO_TEXT, B.NEEDS_TEXT]
    stats = {r.classification: r.n for r in reports.run_stats(B.process_files(files, M.train(train, max_iter=10))).collect()}
    assert stats == {"Invoice": 1, "Letter": 1, "Error": 4}


DOC = "doc_id long, source string, text string, lang string"


def _arrive(spark, folder, name, rows, **options):
    """Rows arrive as a file; the stream runs until it is drained."""
    spark.createDataFrame([(k, "s", t, "en") for k, t in rows], DOC).coalesce(1).write.parquet(f"{folder}/in/{name}")
    return _drain(spark, folder, **options)


def _drain(spark, folder, **options):
    from quire.streaming import ingest
    schema = spark.createDataFrame([], DOC).schema
    q = ingest.start_ingest(spark, f"{folder}/in", schema, f"{folder}/corpus", f"{folder}/checkpoint", **options)
    q.awaitTermination()
    return sorted(r.filename for r in ingest.read_corpus(spark, f"{folder}/corpus").collect())


def test_stream_of_several_batches_and_a_replayed_one(spark, tmp_path):
    from quire.streaming.ingest import to_corpus_rows, write_batch
    folder = str(tmp_path)
    write_batch(to_corpus_rows(spark.createDataFrame([(1, "s", "old text", "en")], DOC)), f"{folder}/corpus", "stored")
    first = [(2, "new text"), (3, "new text"), (4, "old text"), (5, "other text"), (6, None), (7, "")]
    known = [f"s/doc_{k}.txt" for k in (1, 2, 3, 5, 6, 7)]  # copies in one batch stay, and a null text is an empty one
    assert _arrive(spark, folder, "a", first) == known

    def forget(batch):  # the run stopped before it had noted the batch as done
        for name in (f"{batch}", f".{batch}.crc"):
            os.remove(f"{folder}/checkpoint/commits/{name}")

    forget(0)
    assert _drain(spark, folder) == known
    assert _arrive(spark, folder, "b", [(8, "new text"), (9, "old text"), (10, "newest"), (11, "newest")]) == sorted([*known, "s/doc_10.txt", "s/doc_11.txt"])
    forget(1)
    # what the half-way batch has written is written anew
    files = [f for f in os.listdir(f"{folder}/corpus") if f.endswith("-1")]
    assert len(files) == 1
    assert _drain(spark, folder) == sorted([*known, "s/doc_10.txt", "s/doc_11.txt"])
    assert _drain(spark, folder) == sorted([*known, "s/doc_10.txt", "s/doc_11.txt"])


def test_stream_sends_a_hot_text_once_per_arrow_batch(spark):
    from quire.streaming.ingest import _GROUPED, _one_text_per_id
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) AS id", "'t' AS text", "cast(id as string) AS filename",
                                        "'en' AS label_name").coalesce(1)
    out = rows.mapInArrow(_one_text_per_id, _GROUPED).collect()
    assert sorted(len(r.filenames) for r in out)[-2:] == [1, 1000] and sum(len(r.filenames) for r in out) == 3000


def test_stream_scores_new_rows(spark, tmp_path):
    from quire.operators import models as M
    from quire.streaming import ingest
    train = spark.createDataFrame([(f"invoice no {i} total", "invoice") for i in range(20)] + [(f"dear friend {i} hello", "letter") for i in range(20)],
                                  "text string, label string")
    score = ingest.score_rows(M.train(train, max_iter=10))
    folder = str(tmp_path)
    _arrive(spark, folder, "a", [(1, "Invoice No: A-12 total: $5.00"), (2, "dear friend hello")], score=score)
    _arrive(spark, folder, "b", [(3, "dear friend hello"), (4, "Invoice No: B-7 total: $6.00")], score=score)
    out = {r.filename: r for r in ingest.read_corpus(spark, f"{folder}/corpus", scored=True).collect()}
    assert sorted(out) == ["s/doc_1.txt", "s/doc_2.txt", "s/doc_4.txt"]
    assert [out[f"s/doc_{k}.txt"].classification for k in (1, 2, 4)] == ["Invoice", "Letter", "Invoice"]
    assert out["s/doc_4.txt"].fields["invoice_number"] == "B-7" and out["s/doc_2.txt"].fields is None


def test_exchange_counts_one_edit(spark):
    pairs = [("abcd", "abdc", 1), ("abcd", "badc", 2), ("ca", "abc", 2), ("abc", "ca", 2), ("abcd", "abcd", 0), ("abcd", "axyd", 2),
             ("abcdef", "badcfe", None), ("a", "b", 1), ("abcd", "bacx", 2)]
    df = spark.createDataFrame(pairs, "a string, b string, d int")
    assert [r.x for r in df.select(SPL.edit_distance("a", "b").alias("x")).collect()] == [p[2] for p in pairs]


def test_fit_sample_gathers_no_texts(spark):
    from quire.operators import models as M
    data = spark.range(0, 5000, 1, 4).select(F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("a").alias("label"))
    plan = M.fit_sample(data, rows=1000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan
    got = {r.text for r in M.fit_sample(data, rows=1000).collect()}
    assert got == {r.text for r in data.orderBy(F.xxhash64("text")).limit(1000).collect()}
    assert M.fit_sample(data, rows=5000).count() == 5000 and M.fit_sample(data, rows=1000).rdd.getNumPartitions() == 4
    hot = data.withColumn("text", F.lit("same"))
    assert 0 < M.fit_sample(hot, rows=1000).count() <= 1000


def test_fractions_must_sum_to_one(spark):
    SP.check_fractions(0.7, 0.2, 0.1)
    SP.check_fractions(0.1 + 0.2, 0.7)  # as close as floats come
    df = spark.createDataFrame([("a", 1)], "id string, label int")
    for parts in ((0.7, 0.2, 0.2), (0.5, 0.2, 0.2)):
        with pytest.raises(ValueError, match="must sum to 1.0"):
            SP.check_fractions(*parts)
        with pytest.raises(ValueError, match="must sum to 1.0"):
            SP.stratified_split(df, train=parts[0], test=parts[1], validation=parts[2])


def test_whole_labels(spark):
    values = ["3", " 4 ", "5.0", "-2", None, "", "x", "1.5", "99999999999", "nan", "1e3"]
    rows, rejects = C.whole_labels(spark.createDataFrame([(v, v) for v in values], "came string, label string"))
    assert {r.came: r.label for r in rows.collect()} == {"3": 3, " 4 ": 4, "5.0": 5, "-2": -2, None: None, "1e3": 1000}
    assert {r.label: r.reason for r in rejects.collect()} == {"": "not a number", "x": "not a number", "1.5": "not whole",
                                                              "99999999999": "out of range", "nan": "not a number"}
    rows, rejects = C.whole_labels(spark.createDataFrame([(1.0,), (2.5,)], "label double"))
    assert [r.label for r in rows.collect()] == [1] and rejects.first().reason == "not whole"


def test_files_that_cannot_be_read_are_error_rows(spark, tmp_path):
    from quire.operators import batch as B
    from quire.operators import models as M
    from quire.operators import models as M
    spark.createDataFrame([(k, f"dear friend {k} hello") for k in range(4)], "k int, value string").repartition("k") \
        .write.partitionBy("k").text(str(tmp_path / "in"))
    (tmp_path / "in" / "odd.exe").write_bytes(b"x")
    files = {k: next((tmp_path / "in" / f"k={k}").glob("part-*.txt")) for k in range(4)}
    with open(files[1], "r+b") as file:  # its checksum is now another file's
        file.truncate(3)
    out = {r.path.split("in/")[1].split("/")[0]: r for r in B.read_folder(spark, str(tmp_path / "in"), between=files[2].unlink).collect()}
    assert {k: r.error for k, r in out.items()} == {"k=0": None, "k=1": B.LOST, "k=2": B.LOST, "k=3": None, "odd.exe": B.UNSUPPORTED}
    assert out["k=1"].file_type == "TXT" and out["k=1"].filename == files[1].name and out["k=0"].text == "dear friend o hello"
    train = spark.createDataFrame([(f"invoice no {i} total", "invoice") for i in range(20)] + [(f"dear friend {i} hello", "letter") for i in range(20)],
                                  "text string, label string")
    rows = B.process_folder(spark, str(tmp_path / "in"), M.train(train, max_iter=10)).collect()  # the file that has gone is not listed any more
    assert sorted((r.classification or "", r.error or "") for r in rows) == [("", B.LOST), ("", B.UNSUPPORTED), ("Letter", ""), ("Letter", "")]


def test_a_fit_reads_even_parts(spark, monkeypatch):
    from quire.operators import models as M
    seen, sampled = [], M.fit_sample

    def spy(df, *a, **k):
        out = sampled(df, *a, **k)
        seen.append(out.columns)
        return out.coalesce(1)

    cached = []
    of = M.StringIndexer._fit
    monkeypatch.setattr(M, "fit_sample", spy)
    monkeypatch.setattr(M.StringIndexer, "_fit", lambda self, df: cached.append(df) or of(self, df))
    text = " ".join(str(k) for k in range(2000))
    rows = spark.range(2000).select(F.concat(F.md5(F.col("id").cast("string")), F.lit(text)).alias("text"), (F.col("id") % 2).alias("label"), F.lit("x").alias("more"))
    M.train(rows, max_iter=2)
    plan = cached[0]._jdf.queryExecution().toString()
    assert seen == [["label", "text"]] and "REBALANCE" in plan.upper()


def test_files_already_read_are_not_read_again(spark):
    from quire.operators import batch as B
    from quire.operators import models as M
    files = spark.createDataFrame([(f"/in/{c}{k}.txt", bytearray(f"{c} {k} words", "utf-8"), c) for k in range(6) for c in ("invoice", "other")],
                                  "path string, content binary, label string")
    read = B.readable(files)
    model = M.train(read.select("text", "label"), max_iter=5)
    again = B.process_files(read.drop("content"), model)  # would fail if it decoded
    assert sorted(map(str, again.collect())) == sorted(map(str, B.process_files(files, model).collect()))


def test_rejected_words_are_not_shuffled(spark):
    words = spark.range(20000).select((F.col("id") % 7).alias("doc"), (F.col("id") % 90).alias("line_num"), F.col("id").alias("left"), F.col("id").alias("pos"),
                                      F.when(F.col("id") < 50, 1).otherwise(0).alias("conf"), F.md5(F.col("id").cast("string")).alias("text"))
    table = OC.table_text(words, "doc")
    plan = table._jdf.queryExecution().executedPlan().toString()
    # one exchange for the words of a page and one for the pages that have any
    assert plan.count("Exchange hashpartitioning") == 2
    got = {r.doc: r.table_text for r in table.collect()}
    assert len(got) == 7 and sum(t.count("\n") for t in got.values()) == sum(OC.table_text(words.filter("conf = 1"), "doc").agg(
        F.sum(F.length(F.regexp_replace("table_text", "[^\n]", "")))).first())


def test_class_weights_do_not_gather_a_class(spark):
    from quire.operators import models as M
    from quire.session import settings
    rows = spark.range(0, 400, 1, 4).select(F.when(F.col("id") < 390, "hot").otherwise("rare").alias("label"), F.col("id").cast("string").alias("text"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        weighted = M.with_class_weights(rows)
        assert weighted.rdd.getNumPartitions() == 4  # the rows stay where they are
    assert {r.label: round(r.weight, 6) for r in weighted.select("label", "weight").distinct().collect()} == {"hot": round(400 / 780, 6), "rare": 20.0}


def test_stream_holds_ids_without_python_per_id(spark, tmp_path):
    from quire.streaming import ingest
    spark.createDataFrame([("a",)], "id string").write.parquet(str(tmp_path / "stored"))
    spark.createDataFrame([("a", "f", "t", "l")], "id string, filename string, text string, label_name string").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id string, filename string, text string, label_name string").parquet(str(tmp_path / "in"))
    plan = ingest.arrivals(rows, spark.readStream.schema("id string").parquet(str(tmp_path / "stored")))._jdf.queryExecution().logical().toString()
    assert "Deduplicate" in plan and "TransformWithState" not in plan
    batch = spark.createDataFrame([("a", "t", ["f"], ["l"], 0), ("a", None, None, None, 1), ("a", None, None, None, 2),  # stored before
                                   ("b", "u", ["g"], ["l"], 0), ("b", "u", ["h"], ["l"], 0), ("b", None, None, None, 1),
                                   ("c", "v", ["i"], ["l"], 0)],  # in an earlier batch
                                  "id string, text string, filenames array<string>, labels array<string>, kind int")
    assert sorted(r.filename for r in ingest.unseen(batch).collect()) == ["g", "h"]


def test_letters_and_invoices_are_dealt_out(spark, sf001):
    from quire.plans import q_features
    from quire.plans.fixtures import invoice_text
    for df, n in ((q_features.letters(spark, sf001), 2), (invoice_text(spark, sf001), 1)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions") == n


def test_abbreviation_counts_are_of_uses(spark, monkeypatch):
    from quire.operators import abbreviations as AB
    plans, write = [], AB.staged
    monkeypatch.setattr(AB, "staged", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    rows = spark.createDataFrame([("(No. no no. x",), ("No. No., y",), (None,)], "text string")
    got = {r.word: (r.with_stop, r.without_stop) for r in AB.abbreviation_scores(rows).collect()}
    assert got == {"no": (4, 1)}
    assert len(plans) == 1 and "Aggregate [raw" in plans[0]  # texts are cut once, and forms counted before the patterns see them


def test_a_fit_reads_all_rows(spark):
    from quire.operators import models as M
    n = 1_001_000
    rows = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 2 == 0, "bill").otherwise("letter").alias("text"), (F.col("id") % 2).alias("label"))
    assert M.train(rows, max_iter=1).stages[3].numDocs == n
    feats, _ = M.train_presence(rows, ["label"], max_iter=1)
    assert feats.stages[2].numDocs == n


def test_the_vocabulary_is_the_most_frequent_words(spark):
    from quire.operators import models as M
    tokens = spark.createDataFrame([(["b", "a", "b"],), (["c", "a", "d"],), ([],), (None,)], "tokens array<string>")
    assert M.vocabulary(tokens) == ["a", "b", "c", "d"] and M.vocabulary(tokens, size=3) == ["a", "b", "c"]


def test_a_fit_of_passes_reads_all_rows(spark, monkeypatch):
    from quire.operators import attention as AT
    seen = []
    monkeypatch.setattr(AT, "_passes", lambda data, *a: seen.append(data.count()) or (0.0, 0.0, None))
    grids = spark.range(0, 201_000, 1, 8).select("id", F.array(F.array(F.lit(1).cast("long"))).alias("grid"), (F.col("id") % 2).cast("string").alias("label"))
    AT.fit(grids, grids.limit(10), 2)
    assert seen == [201_000]


def test_a_split_moves_only_the_rows_of_cut_buckets(spark):
    ids = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 7)).alias("label"))
    out = SP.stratified_split(ids, "label", "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    got = {r.id: r.split for r in out.collect()}
    by_class = {}
    for r in ids.collect():
        by_class.setdefault(r.label, []).append(r.id)
    for members in by_class.values():
        order = sorted(members, key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
        names = [got[i] for i in order]
        assert names == sorted(names, key=("test", "validation", "train").index) and set(names) == set(SP.SPLITS)
    assert len(got) == 3000 and sum(x == "test" for x in got.values()) == 300


def test_lemmas_are_the_same_in_place_and_joined(spark):
    from quire.operators import lemmas as LM
    table = spark.createDataFrame([("went", "go"), ("cats", "cat"), ("go", "go")], "word string, lemma string")
    rows = [(1, [["cats", "went", "x"], []]), (2, [["go"]]), (3, [["went"], ["cats", "y"]]), (3, [["cats", "a"]]), (None, [["cats"]]), (5, [])]
    rows += [(k, [["cats", str(k)]] * (k % 3)) for k in range(10, 40)]
    df = spark.createDataFrame(rows, "id int, segs array<array<string>>").coalesce(1)
    alone = df.filter("id IS NULL OR id <> 3")
    assert "Exchange" not in LM.lemmatise(alone, "id", "segs", table)._jdf.queryExecution().executedPlan().toString()
    for some in (df, alone, df.limit(3).filter("id = 2")):
        here, joined = (sorted(map(str, LM.lemmatise(some, "id", "segs", table, in_place=n).collect())) for n in (2, 0))
        assert here == joined and len(here) == some.select("id").distinct().count()
