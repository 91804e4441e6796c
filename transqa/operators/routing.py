"""Status of each document, its counts, the review queue and the final table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transqa.functions.text import col, is_english
from transqa.operators.scoring import COMPLETENESS, SEMANTIC

# The statuses a document can get.
SKIPPED, APPROVED, REJECTED, NEEDS_REVIEW = "SKIPPED", "APPROVED", "REJECTED", "NEEDS_REVIEW"
FOR_REVIEW = (REJECTED, NEEDS_REVIEW)


def status(lang: Column | str, semantic: Column, complete: Column) -> Column:
    """English is skipped; both verdicts decide the rest, a missing one counts as failed."""
    meaning = F.coalesce(semantic, F.lit(False))
    whole = F.coalesce(complete, F.lit(False))
    return (
        F.when(is_english(lang), SKIPPED)
        .when(meaning & whole, APPROVED)
        .when(~meaning & ~whole, REJECTED)
        .otherwise(NEEDS_REVIEW)
    )


def route(
    evaluated: DataFrame, keep: Sequence[str | Column], lang: Column | str = "detected_language"
) -> DataFrame:
    """Narrow result per document: status and the two rationales."""
    return evaluated.select(
        *keep,
        status(lang, F.col(f"{SEMANTIC}.value"), F.col(f"{COMPLETENESS}.value")).alias("status"),
        F.col(f"{SEMANTIC}.rationale").alias("semantic_preservation_rationale"),
        F.col(f"{COMPLETENESS}.rationale").alias("completeness_rationale"),
    )


def status_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("status").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "status")


def for_review(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("status").isin(*FOR_REVIEW))


def review_queue(routed: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first documents for a reviewer, as a top-k by key that sorts no table."""
    return (
        for_review(routed)
        .select(key, "status", "semantic_preservation_rationale", "completeness_rationale")
        .orderBy(key)
        .limit(rows)
    )


def attach_results(translations: DataFrame, routed: DataFrame, key: str) -> DataFrame:
    """Put statuses and rationales onto the translations by key, never by position."""
    results = routed.select(
        key, "status", "semantic_preservation_rationale", "completeness_rationale"
    )
    return translations.join(results, key, "left")


def first_documents(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The first rows by key: the same ones on every run."""
    return df.orderBy(col(key)).limit(rows)
