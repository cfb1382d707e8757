"""Batch scans of parquet tables (driver tables and our own outputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan ``<root>/<name>.parquet``; selecting columns here lets Catalyst
    prune the parquet read schema to exactly those columns."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df
