"""Readers for the fact tables the KPI modules consume (Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet table ``{base}/{name}.parquet``; selecting columns up front keeps ReadSchema narrow."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
