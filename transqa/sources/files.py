"""Whole-file scans: one row per document file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.functions.text import col


def scan_files(
    spark: SparkSession, directory: str, glob: str = "*.pdf", recursive: bool = False
) -> DataFrame:
    """``(path, content)`` of every file in a directory whose name matches.

    The content is only read when a later step uses the column.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(directory)
        .select("path", "content")
    )


def table_as_files(df: DataFrame, path: Column | str, text: Column | str) -> DataFrame:
    """A table of texts in the shape of a file scan."""
    return df.select(
        col(path).alias("path"), F.encode(col(text), "UTF-8").alias("content")
    )


def write_text_files(df: DataFrame, text: str, directory: str) -> None:
    """Write every row as a file of its own, in one folder per task.

    The commit then moves a folder per task, where it would move each file on the driver, and
    no folder holds more than a task's files. Read them back with ``recursive``.
    """
    (
        df.select(F.col(text).alias("value"), F.spark_partition_id().alias("task"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 1)
        .partitionBy("task")
        .text(directory)
    )
