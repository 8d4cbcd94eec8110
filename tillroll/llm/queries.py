"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame.

Each query runs its operator over the whole given table and derives the
contract's columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.oracle import ORACLE_SQL  # noqa: F401  (read by __spark_entry__)
from tillroll.llm import decontaminate, divergence, filter_audit, html, langid, lm, mixing, packing, quality, simhash, tokens, toxicity, urls
from tillroll.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


@query
def op1_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.mix_report(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op2_urls(spark, sf_dir):
    """Rule and verdict of every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op3_token_counts(spark, sf_dir):
    """Tokens of every document, and how much of it fits the limit."""
    counted = tokens.prefix_counts(table(spark, sf_dir, "documents"), tokenizer_path(), budget=TOKEN_LIMIT, with_table=False)
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "budget_chars")


@query
def op4_lm(spark, sf_dir):
    """Unigram and maximum-entropy scores of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score_documents(docs, ~lm.held_out(F.col("doc_id")))
    return scored.select(F.col("id").alias("doc_id"), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@query
def op5_token_file(spark, sf_dir):
    """Documents as read back from a bit-packed token file."""
    path = work_dir(spark, "token-file")
    packing.write_token_file(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return packing.read_token_file(spark, path).withColumnRenamed("id", "doc_id")


@query
def op6_decontaminate(spark, sf_dir):
    """Benchmark windows inside every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"))


@query
def op7_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"),
                        "component_id")


@query
def op8_html(spark, sf_dir):
    """Main text of every page."""
    found = html.extract_text(table(spark, sf_dir, "pages"), keep=("url",))
    return found.withColumnRenamed("id", "page_id")


@query
def op9_quality(spark, sf_dir):
    """Counts and verdict of the quality cascade for every document."""
    # rejected_by is left out: which of several failing rules comes first follows measured costs
    return quality.quality_report(table(spark, sf_dir, "documents")).drop("rejected_by").withColumnRenamed("id", "doc_id")


@query
def op10_langid(spark, sf_dir):
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    found = langid.predict_language(docs, ~held)
    return found.select(F.col("id").alias("doc_id"), langid.held_out(F.col("id")).alias("held_out"),
                        "lang_pred", "score", "rejected")


@query
def op11_filter_audit(spark, sf_dir):
    """Outcome of every step of every filter order, per source."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_source_divergence(spark, sf_dir):
    """Divergence of every source from the others and from its language."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


@query
def op13_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score_toxicity(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    return found.select(F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score", "predicted",
                        F.size("matches").cast("long").alias("n_matches"))
