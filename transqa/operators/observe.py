"""Traces, runs and timings as tables."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.operators.infer import AnswerStore, HotKeys, Task
from transqa.operators.joins import spread_left_join

LLM, CHAIN = "LLM", "CHAIN"
ROOT_SPAN = "translation_pipeline"
RUNS_SCHEMA = "run_id string, run_name string, kind string, key string, value string"


def call_spans(
    df: DataFrame,
    tasks: Sequence[Task],
    store: AnswerStore,
    trace_id: str,
    version: str,
    hot: HotKeys = HotKeys(),
    metadata: Sequence[str] = (),
) -> DataFrame:
    """One span per document and model call behind it.

    A call shared by several documents shows up in each of their traces. Only keys
    and measures are joined, no text; ``hot`` spreads calls that very many share.
    ``metadata`` names columns, such as a file name, to tag every span with.
    """
    calls = F.explode(
        F.array(*[F.struct(F.lit(t.name).alias("name"), t.key.alias("key")) for t in tasks])
    )
    measures = ("started_at", "duration_ms", "in_chars", "out_chars", "error", "endpoint")
    order = F.struct(F.col("error").isNull().alias("good"), F.col("started_at"))
    latest = (
        store.for_tasks(tasks)
        .groupBy("key")
        .agg(F.max_by(F.struct(*measures), order).alias("m"))
    )
    made = (
        df.select(F.col(trace_id).cast("string").alias("trace_id"), *metadata, calls.alias("c"))
        .select("trace_id", *metadata, "c.name", "c.key")
        .where(F.col("key").isNotNull())
    )
    answered = spread_left_join(made, latest, "key", hot.table, F.xxhash64("trace_id"))
    return (
        answered.where(F.col("m").isNotNull())
        .select(
            "trace_id",
            F.lit(ROOT_SPAN).alias("parent"),
            "name",
            F.lit(LLM).alias("span_type"),
            *[F.col(f"m.{m}").alias(m) for m in measures],
            *metadata,
            F.lit(version).alias("pipeline_version"),
        )
    )


def root_spans(spans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The parent span of every trace, summed up from its children.

    The aggregate keeps a fixed-size state per trace, so a trace of any length
    is combined on the map side and never gathered.
    """
    ended = F.unix_millis("started_at") + F.col("duration_ms")
    return spans.groupBy("trace_id", *by).agg(
        F.min("started_at").alias("started_at"),
        (F.max(ended) - F.min(F.unix_millis("started_at"))).alias("duration_ms"),
        F.sum("duration_ms").alias("busy_ms"),
        F.count("*").alias("children"),
        F.sum("in_chars").alias("in_chars"),
        F.sum("out_chars").alias("out_chars"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    ).select(
        "trace_id", *by, F.lit(None).cast("string").alias("parent"), F.lit(ROOT_SPAN).alias("name"),
        F.lit(CHAIN).alias("span_type"), "started_at", "duration_ms", "busy_ms", "children",
        "in_chars", "out_chars", "errors",
    )


def span_tree(spans: DataFrame) -> DataFrame:
    """Parents and children in one table, linked by ``parent``."""
    return spans.unionByName(root_spans(spans), allowMissingColumns=True)


def run_rows(
    spark: SparkSession, run_id: str, run_name: str, params: Mapping[str, object],
    metrics: Mapping[str, float] | None = None,
) -> DataFrame:
    """Parameters and metrics of a run, one row each."""
    rows = [(run_id, run_name, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, run_name, "metric", k, str(v)) for k, v in (metrics or {}).items()]
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def metric_rows(
    report: DataFrame, run_id: str, run_name: Column | str, metrics: Sequence[str]
) -> DataFrame:
    """Columns of a report as run metrics, one row per report row and metric."""
    name = run_name if isinstance(run_name, Column) else F.lit(run_name)
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("key"), F.col(m).cast("double").alias("value"))
                for m in metrics
            ]
        )
    )
    return report.select(
        F.lit(run_id).alias("run_id"), name.alias("run_name"), F.lit("metric").alias("kind"),
        pairs.alias("p"),
    ).select("run_id", "run_name", "kind", "p.key", F.col("p.value").cast("string").alias("value"))


@dataclass
class StageClock:
    """Wall-clock seconds of each stage of a run."""

    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        started = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = time.perf_counter() - started

    def metrics(self, baseline_s: float | None = None) -> dict[str, float]:
        """Seconds by stage and in total, with the speed-up over a baseline."""
        total = sum(self.seconds.values())
        result = {f"{name}_s": round(s, 1) for name, s in self.seconds.items()}
        result["total_s"] = round(total, 1)
        if baseline_s is not None:
            result["speedup"] = round(baseline_s / max(total, 1), 1)
        return result
