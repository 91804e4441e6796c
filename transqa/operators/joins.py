"""Left join that spreads hot keys over many partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_left_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, spread_by: Column
) -> DataFrame:
    """``left LEFT JOIN right ON key``, where the keys of ``hot`` are spread.

    ``hot`` is a narrow table ``(key, salts)`` of keys that very many rows share; each
    brings its own number of salts. It is broadcast: only keys of at least a fixed number
    of rows are in it, so it holds at most rows / that number. ``right`` must be unique on
    ``key``; its hot rows are repeated once per salt of their key, so each row on the left
    still meets its one partner. Without hot keys it is a plain join.
    """
    if hot is None:
        return left.join(right, key, "left")
    salts = F.broadcast(hot.select(F.col("key").alias(key), F.col("salts").alias("_salts")))
    salted_left = left.join(salts, key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(spread_by, F.col("_salts")).cast("int"), F.lit(0))
    ).drop("_salts")
    every_salt = F.when(
        F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts").cast("int") - 1)
    ).otherwise(F.array(F.lit(0)))
    salted_right = right.join(salts, key, "left").withColumn("_salt", F.explode(every_salt)).drop("_salts")
    return salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")


def salts_for(copies: Column, hot_rows: int) -> Column:
    """How far a key of ``copies`` rows is spread: one salt per ``hot_rows`` rows, two at least."""
    return F.greatest(F.lit(2), F.ceil(copies / F.lit(hot_rows))).cast("int")
