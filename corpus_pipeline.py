"""The corpus pipeline: toxic documents out, copies out, benchmark passages out, then packing.

Each stage works on all that the one before it kept, written as Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import decontaminate, exact_dedup, near_dedup, queries, toxicity
from basketlens.llm.columns import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on the labelled ones, does not predict to be toxic.

    Scores go by the text alone, so rows are dropped where they are scored, without a join.
    """
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts, the row with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (Jaccard similarity 0.8 or more), the row with the smallest doc_id.

    64 bands of 8 miss a pair at exactly 0.8 with probability 8e-6.
    """
    return near_dedup.drop_near_duplicates(docs, least=(80, 100), bands=64, rows=8)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences."""
    return queries.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: The first stage is a trained model and the last a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"stage-{number}-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
