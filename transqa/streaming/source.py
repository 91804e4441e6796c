"""File streams over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream with its own schema."""
    schema = spark.read.parquet(f"{directory}/{name}.parquet").schema
    # A one-letter glob makes the source accept a single file as well as a folder.
    return spark.readStream.schema(schema).parquet(f"{directory}/{name}.parque[t]")
