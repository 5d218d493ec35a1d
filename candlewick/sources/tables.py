"""Loading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.session import ensure_session

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; column pruning and filter pushdown reach the parquet scan."""
    ensure_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
