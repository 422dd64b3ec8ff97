"""Reading the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str | Column) -> DataFrame:
    """Table ``name`` of ``folder``; with ``columns`` only those are read from the files."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
