"""Continuous scoring of new traces, with sampling, trends and alerts.

A trace has ``trace_id``, ``ts``, ``inputs`` and ``outputs``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from transqa.config import Settings
from transqa.functions.text import col
from transqa.operators.infer import Inference
from transqa.operators.scoring import (
    Scorer,
    completeness_scorer,
    evaluate,
    guidelines_scorer,
    semantic_scorer,
    tidy_scores,
)
from transqa.sources.tables import StageTables

MONITORS = "monitors"
MONITORS_SCHEMA = "name string, scorer string, sample_rate double"


@dataclass(frozen=True)
class Monitor:
    """A scorer registered under a name, applied to a share of all traces."""

    name: str
    scorer: Scorer
    sample_rate: float = 1.0


def default_monitors(settings: Settings) -> list[Monitor]:
    """The three scorers; the costly one at half rate."""
    return [
        Monitor("translation_semantic_preservation", semantic_scorer(settings), 1.0),
        Monitor("translation_completeness", completeness_scorer(), 1.0),
        Monitor("translation_guidelines_monitor", guidelines_scorer(settings), 0.5),
    ]


def monitor_table(spark: SparkSession, monitors: Sequence[Monitor]) -> DataFrame:
    """The registered monitors as rows."""
    return spark.createDataFrame(
        [(m.name, m.scorer.name, float(m.sample_rate)) for m in monitors], MONITORS_SCHEMA
    )


def register_monitors(tables: StageTables, monitors: Sequence[Monitor]) -> DataFrame:
    """Store the registered monitors; registering a name again replaces its entry."""
    new = monitor_table(tables.spark, monitors)
    if tables.exists(MONITORS):
        kept = tables.read(MONITORS).join(new, "name", "left_anti")
        new = kept.select(*new.columns).unionByName(new)
    return tables.replace(new, MONITORS)


def unregister_monitors(tables: StageTables, names: Sequence[str]) -> DataFrame:
    """Take monitors off the registry; those that read it stop with their next batch."""
    return tables.replace(tables.read(MONITORS).where(~F.col("name").isin(list(names))), MONITORS)


def registered_monitors(tables: StageTables, scorers: Sequence[Scorer]) -> list[Monitor]:
    """The registry's monitors at their rates; each needs its scorer among those given."""
    known = {s.name: s for s in scorers}
    rows = tables.read(MONITORS).orderBy("name").collect()
    missing = sorted({r["scorer"] for r in rows} - set(known))
    if missing:
        raise ValueError(f"registered monitors need the scorers {', '.join(missing)}")
    return [Monitor(r["name"], known[r["scorer"]], r["sample_rate"]) for r in rows]


def is_sampled(monitor: str, key: Column | str, rate: float) -> Column:
    """Whether a monitor takes a trace: a digest below the rate.

    The answer depends on the monitor and the trace alone, so it repeats under any
    partitioning, and a lower rate takes a part of what a higher one takes.
    """
    digest = F.md5(F.concat_ws("|", F.lit(monitor), col(key).cast("string")))
    point = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return point < F.lit(int(rate * 2**32)).cast("bigint")


def score_traces(
    traces: DataFrame, monitors: Sequence[Monitor], inference: Inference | None = None,
    keep: Sequence[str] = ("trace_id", "ts"),
) -> DataFrame:
    """One row per trace and monitor that samples it.

    A judge is asked for the sampled traces only.
    """
    scorers, rates = [], {}
    for m in monitors:
        rates[m.name] = m.sample_rate
        tasks = m.scorer.tasks
        if m.sample_rate < 1.0:
            sampled = is_sampled(m.name, "trace_id", m.sample_rate)
            tasks = tuple(t.only(sampled) for t in tasks)
        scorers.append(replace(m.scorer, name=m.name, tasks=tasks))
    evaluated = evaluate(traces, scorers, inference, keep)
    scores = tidy_scores(evaluated, [m.name for m in monitors], keep)
    chosen = F.lit(False)
    for name, rate in rates.items():
        chosen = chosen | ((F.col("scorer") == name) & is_sampled(name, "trace_id", rate))
    return scores.where(chosen).withColumnRenamed("scorer", "monitor")


def new_traces(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Every trace once: repeats within the lateness and rows beyond it are dropped."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["trace_id"])


def start_monitoring(
    stream: DataFrame, monitors: Sequence[Monitor] | Callable[[], Sequence[Monitor]],
    inference: Inference | None, path: str, lateness: str = "1 hour", available_now: bool = False,
) -> StreamingQuery:
    """Score every new trace as it arrives; traces and scores land under ``path``.

    Each micro-batch is written before it is scored, so the stateful part of
    the stream runs once and scoring works on a table. A batch that is replayed
    overwrites its own folder, and its answers are already stored. Give the inference
    a store with ``reuse_days``, so that a batch does not search all past answers.
    ``monitors`` may be a function, which is asked anew for every batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        place = f"{path}/traces/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(place)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(place)
        now = monitors() if callable(monitors) else monitors
        if not now or stored.isEmpty():
            return
        scores = score_traces(stored, now, inference)
        scores.write.mode("overwrite").parquet(f"{path}/scores/batch_id={batch_id}")

    writer: DataStreamWriter = (
        new_traces(stream, lateness)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{path}/checkpoint")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_registered(
    stream: DataFrame, tables: StageTables, scorers: Sequence[Scorer], inference: Inference | None,
    path: str, lateness: str = "1 hour", available_now: bool = False,
) -> StreamingQuery:
    """Monitor by the registry: every batch is scored by the monitors registered at its time."""
    return start_monitoring(
        stream, lambda: registered_monitors(tables, scorers), inference, path, lateness, available_now
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/scores")


def quality_trend(scores: DataFrame, period: str = "1 day", by: Sequence[str] = ("monitor",)) -> DataFrame:
    """Pass rate per period.

    Adding ``pipeline_version`` to ``by`` compares versions of a model.
    """
    return _with_rate(_period_counts(scores, period, by))


def _period_counts(scores: DataFrame, period: str, by: Sequence[str]) -> DataFrame:
    counts = scores.groupBy(F.window("ts", period), *by).agg(
        F.count("value").alias("scored"),
        F.count_if(F.col("value")).alias("passed"),
    )
    return counts.select(
        F.col("window.start").alias("period_start"), F.col("window.end").alias("period_end"),
        *by, "scored", "passed",
    )


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "pass_rate", F.when(F.col("scored") > 0, F.col("passed") / F.col("scored"))
    )


def pass_rate_alerts(trend: DataFrame, threshold: float) -> DataFrame:
    """Periods whose pass rate is below the threshold."""
    return trend.where(F.col("pass_rate") < threshold)


def stream_trend(
    scores: DataFrame, path: str, period: str = "1 day", by: Sequence[str] = ("monitor",),
    available_now: bool = False,
) -> StreamingQuery:
    """Keep a trend up to date, open periods and late scores included.

    Each micro-batch adds its counts per period, few rows however many scores it has, in a
    folder of its own that a replay overwrites; ``read_trend`` sums them up. No state is
    held between batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("ts", F.col("ts").cast("timestamp"))
        counts = _period_counts(timed, period, by)
        counts.write.mode("overwrite").parquet(f"{path}/trend/batch_id={batch_id}")

    writer: DataStreamWriter = scores.writeStream.foreachBatch(handle).option(
        "checkpointLocation", f"{path}/trend_checkpoint"
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_trend(spark: SparkSession, path: str, by: Sequence[str] = ("monitor",)) -> DataFrame:
    """The trend of all batches so far; alerts on it cover the open period too."""
    counts = spark.read.parquet(f"{path}/trend").groupBy("period_start", "period_end", *by).agg(
        F.sum("scored").alias("scored"), F.sum("passed").alias("passed")
    )
    return _with_rate(counts)
