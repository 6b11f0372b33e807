"""Shared folders, as all operators use them, and the table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.workspace import Workspace, partitions, ship, shuffles_freed

__all__ = ["Workspace", "documents", "partitions", "ship", "shuffles_freed"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
