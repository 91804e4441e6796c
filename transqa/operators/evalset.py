"""The evaluation dataset: test cases with expectations, upserted over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transqa.config import Settings
from transqa.functions.text import is_english, prefix
from transqa.operators.routing import SKIPPED
from transqa.sources.tables import StageTables

EXPECTATIONS_TYPE = "struct<expected_language:string,should_translate:boolean>"


def evaluation_cases(translations: DataFrame, settings: Settings) -> DataFrame:
    """Current results as baseline cases: a prefix of the text and what should happen to it."""
    return translations.select(
        F.struct(
            prefix("extracted_text", settings.prefixes.dataset).alias("original_text"),
            F.col("detected_language"),
            *settings.identity(translations.columns),
        ).alias("inputs"),
        F.struct(
            F.col("detected_language").alias("expected_language"),
            (~is_english("detected_language")).alias("should_translate"),
        ).alias("expectations"),
    )


def case_id(inputs: Column | str = "inputs") -> Column:
    """Digest of a case's inputs: two cases are the same one when these agree."""
    return F.sha2(F.to_json(inputs), 256)


def merge_cases(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing cases, replaced where a new one has the same inputs, and the new ones.

    Repeated new cases are first reduced to one by an aggregate that combines on
    the map side; the anti join then moves digests of the new side only.
    """
    fresh = (
        new.withColumn("case", case_id())
        .groupBy("case")
        .agg(F.max(F.struct("expectations", "inputs")).alias("row"))
    )
    kept = existing.withColumn("case", case_id()).join(fresh.select("case"), "case", "left_anti")
    return kept.select("inputs", "expectations").unionByName(
        fresh.select("row.inputs", "row.expectations")
    )


def upsert_cases(tables: StageTables, table: str, new: DataFrame) -> DataFrame:
    """Merge cases into a dataset table, made on first use, and switch to the new version."""
    if not tables.exists(table):
        return tables.replace(merge_cases(_empty_like(new), new), table)
    return tables.replace(merge_cases(tables.read(table), new), table)


def check_against(dataset: DataFrame, routed: DataFrame, key: str) -> DataFrame:
    """How often a fresh run meets the expectations of the dataset.

    ``routed`` holds the fresh run's language and status per key. A case without a
    fresh result is counted as ``missing`` and as not met; of several results of one key the one
    of the smallest language and status counts.
    """
    expected = dataset.select(F.col(f"inputs.{key}").alias(key), "expectations.*")
    fresh = routed.groupBy(key).agg(F.min(F.struct("detected_language", "status")).alias("fresh"))
    both = expected.join(fresh, key, "left").select("*", "fresh.*")
    right_language = F.col("detected_language").eqNullSafe(F.col("expected_language"))
    right_action = (F.col("status") != SKIPPED).eqNullSafe(F.col("should_translate"))
    return both.agg(
        F.count("*").alias("cases"),
        F.count_if(F.col("fresh").isNull()).alias("missing"),
        F.avg((F.col("fresh").isNotNull() & right_language).cast("double")).alias("language_match"),
        F.avg((F.col("fresh").isNotNull() & right_action).cast("double")).alias("action_match"),
    )


def _empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], T.StructType(df.schema.fields))
