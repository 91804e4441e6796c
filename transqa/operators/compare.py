"""Comparison of model endpoints over the same documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transqa.config import PROMPT_OVERHEAD_TOKENS, Settings
from transqa.functions.text import estimate_tokens, guarded_ratio, or_empty, round_half_even
from transqa.operators.extract import with_text
from transqa.operators.infer import Inference
from transqa.operators.routing import first_documents
from transqa.operators.scoring import (
    completeness_scorer,
    evaluate,
    evaluation_records,
    guidelines_scorer,
    scorer_metrics,
    tidy_scores,
)
from transqa.operators.translate import translate_task

UNKNOWN_LANGUAGE = "unknown"


def sample_documents(documents: DataFrame, settings: Settings, count: int | None) -> DataFrame:
    """Documents to compare on: the first ones by key, or all of them."""
    kept = with_text(documents, settings.min_chars).select(settings.key, "extracted_text")
    return kept if count is None else first_documents(kept, settings.key, count)


def across_endpoints(sample: DataFrame, endpoints: Sequence[str]) -> DataFrame:
    """Every document once per endpoint; the fan-out happens in place, without a join."""
    return sample.withColumn("endpoint", F.explode(F.array(*[F.lit(e) for e in endpoints])))


def translate_by_endpoint(
    sample: DataFrame, inference: Inference, settings: Settings
) -> DataFrame:
    """Translate the sample with every endpoint in a single inference pass.

    Each endpoint is a task of its own over the sample, and rows fan out when they have
    their answers, so that a text moves once and not once per endpoint.
    """
    plain = replace(settings, skip_english=False, name_source_language=False)
    endpoints = settings.endpoints.comparison
    tasks = [
        replace(translate_task(plain, endpoint=e), out=f"_translated_{i}")
        for i, e in enumerate(endpoints)
    ]
    each = F.array(*[
        F.struct(F.lit(e).alias("endpoint"), F.col(f"{t.out}.answer").alias("english_translation"))
        for e, t in zip(endpoints, tasks)
    ])
    return inference.run(sample, tasks).select(*sample.columns, F.explode(each).alias("_each")).select(
        *sample.columns, "_each.endpoint", "_each.english_translation"
    )


def token_usage(translated: DataFrame) -> DataFrame:
    """Estimated tokens in, out and in total per endpoint."""
    used = translated.groupBy("endpoint").agg(
        F.count("*").alias("num_documents"),
        F.sum(PROMPT_OVERHEAD_TOKENS + estimate_tokens("extracted_text")).alias("estimated_input_tokens"),
        F.sum(estimate_tokens(or_empty("english_translation"))).alias("estimated_output_tokens"),
    )
    return used.withColumn(
        "estimated_total_tokens",
        F.col("estimated_input_tokens") + F.col("estimated_output_tokens"),
    )


def endpoint_durations(spans: DataFrame) -> DataFrame:
    """Seconds that each endpoint was busy: the sum over its calls.

    Calls of several endpoints share their tasks, so first start and last end tell the
    length of the whole pass and not an endpoint's speed.
    """
    return spans.groupBy("endpoint").agg((F.sum("duration_ms") / 1000).alias("duration_s"))


def throughput(usage: DataFrame, durations: DataFrame) -> DataFrame:
    """Add total and mean duration and tokens per second; both inputs hold a row per endpoint."""
    seconds = F.coalesce(F.col("duration_s"), F.lit(0.0))
    joined = usage.join(durations, "endpoint", "left")
    return joined.select(
        *usage.columns,
        round_half_even(seconds, 1).alias("translation_duration_s"),
        round_half_even(guarded_ratio(seconds, F.col("num_documents"), 1), 1).alias(
            "avg_duration_per_doc_s"
        ),
        round_half_even(guarded_ratio(F.col("estimated_total_tokens"), seconds, 0.1), 0).alias(
            "tokens_per_second"
        ),
    )


def quality_by_endpoint(
    translated: DataFrame, inference: Inference, settings: Settings
) -> DataFrame:
    """Pass rates per endpoint of the scorers that need no back-translation.

    The language is not known here, so no document passes for being English.
    """
    rows = translated.withColumns(
        {
            "detected_language": F.lit(UNKNOWN_LANGUAGE),
            "english_translation": or_empty("english_translation"),
            "back_translation": F.lit(""),
        }
    )
    records = evaluation_records(rows, settings, keep=["endpoint"], cut=settings.prefixes.compare)
    scorers = [completeness_scorer(), guidelines_scorer(settings)]
    evaluated = evaluate(records, scorers, inference, ["endpoint"])
    scores = tidy_scores(evaluated, [s.name for s in scorers], ["endpoint"])
    return scorer_metrics(scores, by=["endpoint"])


def side_by_side(report: DataFrame, endpoints: Sequence[str]) -> DataFrame:
    """One row per metric and one column per endpoint."""
    metrics = [c for c in report.columns if c != "endpoint"]
    long = report.select(
        "endpoint",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in metrics
                ]
            )
        ).alias("m"),
    ).select("endpoint", "m.metric", "m.value")
    return long.groupBy("metric").pivot("endpoint", list(endpoints)).agg(F.first("value"))
