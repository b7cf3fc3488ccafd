"""Inputs derived from the driver's tables (Spark side).

``invoice_text``: one synthetic invoice per order, joined to its customer.
``corpus``: the ``documents`` table in the corpus shape the operators expect.
Each has a DuckDB twin in ``quire.plans.oracle`` so the oracle reads the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.tables import table

INVOICE_NO_OFFSET = 100000
DUE_DAYS = 30


def invoice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, o_custkey, text`` for every order.

    Plain equi-join on the customer key; Spark sizes the customer side at run
    time (AQE) and broadcasts it only while it is under the broadcast
    threshold, else sort-merges, splitting a hot customer's partition.  Orders are dealt
    out evenly while they are narrow: the texts are made and searched by all
    tasks, whatever the table's row groups.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").hint("rebalance")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    day = F.to_date("o_orderdate")
    text = F.concat(
        F.lit("INVOICE Invoice No: INV-"), (F.col("o_orderkey") + INVOICE_NO_OFFSET).cast("string"),
        F.lit(" Invoice Date: "), F.date_format(day, "yyyy-MM-dd"),
        F.lit(" Due Date: "), F.date_format(F.date_add(day, DUE_DAYS), "yyyy-MM-dd"),
        F.lit("\nSeller: Acme Ltd; Bill to: "), F.col("c_name"),
        F.lit("; Total: $"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
    )
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select("o_orderkey", "o_custkey", text.alias("text")))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a corpus: id, filename, text, label name, folder."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id"),
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.col("text"),
        F.col("lang"),
        F.col("source"),
        F.col("n_chars"),
    )
