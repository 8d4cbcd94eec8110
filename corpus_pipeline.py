"""The corpus pipeline: five stages from raw documents to a token file.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``.  NULL and empty texts fail the quality
rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, mixing, packing, quality, simhash
from tillroll.llm.common import materialize
from tillroll.llm.queries import table, tokenizer_path
from tillroll.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.passes(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (the smallest doc_id)."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at the sources' target weights: a row per document and pass with
    the words that the pass takes."""
    return mixing.mixed_documents(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as a bit-packed token file: one row per document as read back."""
    path = work_dir(spark, "pipeline-tokens")
    packing.write_token_file(docs, path, tokenizer_path())
    return packing.read_token_file(spark, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("mixing_to_weights", mixed),
    ("token_output", token_file),
]

#: Fingerprints, permutations and tokenizers have no SQL form; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
