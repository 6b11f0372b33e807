"""From raw documents to packed training sequences: five stages, each an operator applied to all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, with the columns of documents but for the last. A stage's
rows are written as Parquet and read again as the next one's docs. Each stage handles null columns, empty texts and
empty tables as its operator says; further columns of documents are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import minhash_dups, mixing, packing, quality, secret_scan
from sievewright.llm.workspace import Workspace, documents

#: Pieces of text whose ids a worker keeps in the last stage, fewer than in the query: the workers of earlier stages still
#: hold memory. It costs time and changes no id.
KEPT_PIECES = 300_000

#: The classifier and the shingle sets have no SQL form.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labels, doesn't reject."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near-duplicates; rows without a doc_id stay, repeated rows go."""
    return minhash_dups.deduplicated(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars as it then is."""
    return secret_scan.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return packing.packed(docs.withColumn("doc_id", F.col("doc_id").cast("long")), kept=KEPT_PIECES)


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_duplicates", dedup_stage),
    ("secret_scan", secret_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k > 1:
            work.drop(f"{k - 2}-{STAGES[k - 2][0]}")
    return docs
