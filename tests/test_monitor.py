from datetime import datetime

import pytest
from pyspark.sql import functions as F

from transqa.config import Settings
from transqa.operators import scoring
from transqa.sources.tables import shared_root
from transqa.streaming import monitor

SETTINGS = Settings(key="doc_id")
TRACE = (
    "trace_id string, ts timestamp_ntz, "
    "inputs struct<original_text:string,detected_language:string,doc_id:bigint>, "
    "outputs struct<english_translation:string,back_translation:string>"
)


def trace(name, day, hour, translation="translated"):
    return (name, datetime(2024, 1, day, hour), ("original text", "fr", 1), (translation, "back"))


def test_sampling_nests_and_repeats(spark):
    ids = spark.range(5000).withColumn("trace_id", F.col("id").cast("string"))
    taken = {
        rate: {r[0] for r in ids.where(monitor.is_sampled("m", "trace_id", rate)).select("id").collect()}
        for rate in (0.0, 0.25, 0.5, 1.0)
    }
    assert not taken[0.0] and len(taken[1.0]) == 5000
    assert taken[0.25] <= taken[0.5] and 2300 < len(taken[0.5]) < 2700
    again = ids.repartition(7).where(monitor.is_sampled("m", "trace_id", 0.5))
    assert {r[0] for r in again.select("id").collect()} == taken[0.5]
    other = ids.where(monitor.is_sampled("n", "trace_id", 0.5))
    assert {r[0] for r in other.select("id").collect()} != taken[0.5]


def test_default_monitors(spark):
    rows = monitor.monitor_table(spark, monitor.default_monitors(SETTINGS)).collect()
    assert [(r["scorer"], r["sample_rate"]) for r in rows] == [
        ("semantic_preservation", 1.0), ("completeness_check", 1.0), ("translation_quality", 0.5),
    ]


def test_registering_again_replaces_a_monitor(spark, tables):
    short = scoring.completeness_scorer()
    monitor.register_monitors(tables, [monitor.Monitor("a", short), monitor.Monitor("b", short, 0.5)])
    rows = monitor.register_monitors(tables, [monitor.Monitor("b", short, 0.1)]).collect()
    assert sorted((r["name"], r["sample_rate"]) for r in rows) == [("a", 1.0), ("b", 0.1)]


def test_judges_are_asked_for_sampled_traces_only(spark, counting, inference):
    calls = counting(lambda e, p: '{"passed": true, "rationale": "ok"}')
    rows = [trace(str(i), 1, 0, f"t{i}") for i in range(40)]
    traces = spark.createDataFrame(rows, TRACE)
    guided = scoring.guidelines_scorer(SETTINGS)
    monitors = [monitor.Monitor("half", guided, 0.5), monitor.Monitor("all", scoring.completeness_scorer())]
    scores = monitor.score_traces(traces, monitors, inference(calls)).collect()
    sampled = [r["trace_id"] for r in scores if r["monitor"] == "half"]
    assert 0 < len(sampled) < 40 and len(calls.prompts) == len(sampled)
    assert sum(r["monitor"] == "all" for r in scores) == 40
    assert all(r["value"] is not None for r in scores)


def test_the_registry_drives_the_stream(spark, tables, folder):
    short = scoring.completeness_scorer()
    monitor.register_monitors(tables, [monitor.Monitor("a", short), monitor.Monitor("b", short)])

    def scored():
        stream = spark.readStream.schema(TRACE).parquet(f"{folder}/in")
        monitor.start_registered(stream, tables, [short], None, folder, available_now=True).awaitTermination()
        return sorted((r["trace_id"], r["monitor"]) for r in monitor.read_scores(spark, folder).collect())

    add(spark, folder, [trace("x", 2, 0)])
    assert scored() == [("x", "a"), ("x", "b")]
    monitor.unregister_monitors(tables, ["b"])
    add(spark, folder, [trace("y", 2, 1)])
    assert scored() == [("x", "a"), ("x", "b"), ("y", "a")]
    monitor.unregister_monitors(tables, ["a"])
    add(spark, folder, [trace("z", 2, 2)])
    assert len(scored()) == 3
    monitor.register_monitors(tables, [monitor.Monitor("c", scoring.semantic_scorer(SETTINGS))])
    with pytest.raises(ValueError, match="semantic_preservation"):
        monitor.registered_monitors(tables, [short])


@pytest.fixture
def folder(spark, tables):
    return f"{shared_root(spark)}/{tables.schema}"


def add(spark, folder, rows, schema=TRACE):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, monitors, inference=None):
    stream = spark.readStream.schema(TRACE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = monitor.start_monitoring(stream, monitors, inference, folder, available_now=True)
    query.awaitTermination()
    return monitor.read_scores(spark, folder)


def test_new_traces_are_scored_once(spark, folder, counting, inference):
    calls = counting(lambda e, p: '{"passed": true, "rationale": "ok"}')
    judge = inference(calls)
    monitors = [
        monitor.Monitor("complete", scoring.completeness_scorer()),
        monitor.Monitor("meaning", scoring.semantic_scorer(SETTINGS)),
    ]
    add(spark, folder, [trace("a", 2, 0), trace("b", 2, 1), trace("a", 2, 1)])
    assert run(spark, folder, monitors, judge).count() == 4
    # A repeat within the lateness and a row far behind the watermark are dropped.
    add(spark, folder, [trace("b", 2, 1), trace("old", 1, 0), trace("c", 2, 2)])
    scores = run(spark, folder, monitors, judge)
    assert {r["trace_id"] for r in scores.collect()} == {"a", "b", "c"}
    assert scores.count() == 6
    # Starting again without new traces adds nothing and asks nobody.
    before = len(calls.prompts)
    assert run(spark, folder, monitors, judge).count() == 6
    assert len(calls.prompts) == before


def test_stream_trend_equals_batch_trend(spark, folder):
    schema = "ts timestamp_ntz, monitor string, value boolean"
    rows = [
        (datetime(2024, 1, 1 + i % 5, i % 24), "a" if i % 3 else "b", None if i % 7 == 0 else i % 2 == 0)
        for i in range(400)
    ]
    rows.sort(key=lambda r: r[0])
    for start in range(0, 400, 100):
        add(spark, folder, rows[start : start + 100], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    monitor.stream_trend(stream, folder, available_now=True).awaitTermination()
    got = monitor.read_trend(spark, folder)
    scores = spark.read.parquet(f"{folder}/in").withColumn("ts", F.col("ts").cast("timestamp"))
    want = monitor.quality_trend(scores)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.count() == 10
    # A score that comes late is counted in its period.
    add(spark, folder, [(datetime(2024, 1, 1, 3), "a", True)], schema)
    monitor.stream_trend(stream, folder, available_now=True).awaitTermination()
    late = monitor.read_trend(spark, folder)
    assert late.agg(F.sum("scored")).first()[0] == want.agg(F.sum("scored")).first()[0] + 1


def test_alerts_and_versions(spark):
    rows = [(datetime(2024, 1, 1, 5), "m", f"v{i % 2}", i % 4 == 0) for i in range(8)]
    scores = spark.createDataFrame(rows, "ts timestamp, monitor string, pipeline_version string, value boolean")
    trend = monitor.quality_trend(scores, by=["monitor", "pipeline_version"])
    rates = {r["pipeline_version"]: r["pass_rate"] for r in trend.collect()}
    assert rates == {"v0": 0.5, "v1": 0.0}
    assert [r["pipeline_version"] for r in monitor.pass_rate_alerts(trend, 0.5).collect()] == ["v1"]
