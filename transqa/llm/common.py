"""Shared small parts: stored intermediate tables and let-bindings in expressions."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.sources.tables import shared_root

#: A word: a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that all executors share."""
    return f"{shared_root(spark)}/{name}_{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the readers nothing, and what is used
    several times is computed once. The shuffle files of the write go with its end, not when
    the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    place = new_folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(place)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(place)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer file; ``PUBLIC_TOKENIZERS`` names another folder."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
