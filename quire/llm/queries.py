"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quire.llm import (chat, conversation_repair, decontaminate, exact_dedup, ngram_join, packing, ranked_search, secrets, sharding,
                       tokenize, topk, toxicity, url_filter)
from quire.llm.common import read

WORD_FILE, RANK_FILE = "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"


def op1_secret_scan(spark, sf_dir):
    return secrets.summary(secrets.scan(read(spark, sf_dir, "documents")))


def op2_url_filter(spark, sf_dir):
    return url_filter.judge_urls(read(spark, sf_dir, "pages"))


def op3_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), keep="largest")


def op5_chat_formatting(spark, sf_dir):
    turns = chat.format_turns(chat.with_probe(read(spark, sf_dir, "conversations")))
    return chat.read_back(turns).withColumnRenamed("id", "conv_id")


def op6_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE))


def op7_byte_bpe(spark, sf_dir):
    path, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    return tokenize.decode_digest(tokenize.encode(read(spark, sf_dir, "documents"), path, pattern), path, pattern)


def op8_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), lambda key: toxicity.fold_of(key) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (toxicity.fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_sharding(spark, sf_dir):
    return sharding.shard(read(spark, sf_dir, "documents"), 24)


def op10_top_k(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0, 20)


def op11_conversation_repair(spark, sf_dir):
    damaged = conversation_repair.damaged(read(spark, sf_dir, "conversations"))
    return conversation_repair.repair_report(damaged, present_col="present")


def op12_ranked_search(spark, sf_dir):
    return ranked_search.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_decontaminate(spark, sf_dir):
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_url_filter, op3_ngram_jaccard_join, op4_exact_dedup, op5_chat_formatting, op6_packing,
    op7_byte_bpe, op8_toxicity, op9_sharding, op10_top_k, op11_conversation_repair,
    op12_ranked_search, op13_decontaminate)}

ORACLES = {
    "op2_url_filter": url_filter.oracle(),
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_chat_formatting": chat.OP5_SQL,
    "op10_top_k": topk.OP10_SQL,
    "op11_conversation_repair": conversation_repair.oracle(),
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_decontaminate": decontaminate.OP13_SQL,
}
