"""Driver contract, plan shape and stream ingest."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from quire.plans.fixtures import corpus
from quire.sources.tables import table


def test_entry_and_catalogue(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "invoice_number", "invoice_date", "due_date", "issuer_name",
                          "recipient_name", "total_amount"]
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark, sf001):
    d = corpus(spark, sf001).filter(F.col("doc_id") > 10).select("doc_id", "text")
    plan = _plan(d)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,10)]" in plan


def test_anti_join_reads_only_key(spark, sf001):
    from quire.operators.corpus import append_new
    d = corpus(spark, sf001)
    out = append_new(d.filter(F.col("doc_id") < 50).select("id", "text"), d.select("id", "text"))
    assert out.count() == d.count()
    # three scans: stored rows, incoming rows, and the stored keys without their texts
    reads = [line for line in _plan(out).split("\n") if "ReadSchema" in line]
    assert sum("struct<doc_id:bigint>" in line for line in reads) == 1 and len(reads) == 3


def test_stream_ingest(spark, sf001):
    q = E.queries()["stream_ingest"](spark, sf001)
    docs = table(spark, sf001, "documents")
    first = docs.filter("doc_id % 2 = 0")
    # stored rows stay; of the others, those whose text was not stored come, copies included
    from quire.streaming.ingest import to_corpus_rows
    stored, rest = to_corpus_rows(first), to_corpus_rows(docs.filter("doc_id % 2 <> 0"))
    want = stored.count() + rest.join(stored.select("id").distinct(), "id", "left_anti").count()
    assert q.count() == want
