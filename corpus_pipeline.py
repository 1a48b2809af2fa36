"""The corpus pipeline: from raw documents to packed sequences, in five stages.

Each stage reads what the one before it wrote, and writes Parquet to the folder
that all executors share; a lost executor costs the running stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import mixing, nearcopies, packing, secrets, toxicity
from quern.llm.common import stage


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar rejects go; it is trained on labelled rows of the training folds."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by SimHash and then MinHash, each pair of five-word similarity 0.8 or more, the document of least doc_id stays."""
    return nearcopies.one_per_component(docs)


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secrets.redact(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: repeated, whole, cut at the end of a shard's take, or not at all."""
    return mixing.mixed_documents(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("near_dedup", _near_dedup),
    ("secrets", _secrets),
    ("mixing", _mixing),
    ("packing", _packing),
]

#: Tokens and the learned grammar are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
