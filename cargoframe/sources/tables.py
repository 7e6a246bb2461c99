"""Column-pruned scans of the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table_path

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan; passing ``cols`` makes the pruning explicit in ``ReadSchema``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df
