"""Access to the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the driver tables: ``t.orders``, ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register(self) -> None:
        """Expose every table as a temp view (for SQL-text operators)."""
        for name in TABLES:
            load(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
