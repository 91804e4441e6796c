from datetime import datetime

import pytest
from pyspark.sql import functions as F

from transqa.config import Settings
from transqa.operators import compare, evalset, observe, translate
from transqa.plans.workflow import RUNS
from transqa.sources.tables import preview

SETTINGS = Settings(key="doc_id")


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, extracted_text string")


def test_every_endpoint_sees_the_same_sample(spark, counting, inference):
    calls = counting(lambda e, p: None if e == "mini" else p[-6:] * (1 if e == "standard" else 2))
    sample = compare.sample_documents(docs(spark, ["a" * 40, None, "b" * 9, "c"]), SETTINGS, 2)
    translated = compare.translate_by_endpoint(sample, inference(calls), SETTINGS)
    assert len(calls.prompts) == 6
    usage = {r["endpoint"]: r for r in compare.token_usage(translated).collect()}
    assert {r["num_documents"] for r in usage.values()} == {2}
    assert {r["estimated_input_tokens"] for r in usage.values()} == {50 + 10 + 50 + 2}
    assert [usage[e]["estimated_output_tokens"] for e in SETTINGS.endpoints.comparison] == [0, 2, 6]
    assert usage["premium"]["estimated_total_tokens"] == 118


def test_comparison_passes_no_document_for_being_english(spark, counting, inference):
    calls = counting(lambda e, p: '{"passed": true, "rationale": "ok"}')
    rows = docs(spark, ["x" * 100]).withColumns(
        {"endpoint": F.lit("mini"), "english_translation": F.lit("y" * 10)}
    )
    quality = compare.quality_by_endpoint(rows, inference(calls), SETTINGS).collect()
    rates = {r["scorer"]: r["pass_rate"] for r in quality}
    assert rates == {"completeness_check": 0.0, "translation_quality": 1.0}


def test_throughput_guards_its_divisions(spark):
    usage = spark.createDataFrame(
        [("a", 3, 1000), ("b", 0, 10), ("c", 2, 7)],
        "endpoint string, num_documents long, estimated_total_tokens long",
    )
    seconds = spark.createDataFrame([("a", 7.0), ("b", 0.0)], "endpoint string, duration_s double")
    got = {r["endpoint"]: tuple(r)[3:] for r in compare.throughput(usage, seconds).collect()}
    assert got == {"a": (7.0, 2.3, 143.0), "b": (0.0, 0.0, 100.0), "c": (0.0, 0.0, 70.0)}
    side = compare.side_by_side(usage, ["a", "b", "c"]).orderBy("metric").collect()
    assert [tuple(r) for r in side] == [
        ("estimated_total_tokens", 1000.0, 10.0, 7.0), ("num_documents", 3.0, 0.0, 2.0),
    ]


def cases(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, extracted_text string, detected_language string")
    return evalset.evaluation_cases(df, SETTINGS)


def flat(dataset):
    rows = dataset.select("inputs.doc_id", "inputs.original_text", "expectations.*").collect()
    return sorted(map(tuple, rows))


def test_cases_and_idempotent_upsert(spark, tables):
    first = cases(spark, [(0, "a" * 4000, "fr"), (1, "b", "en"), (1, "b", "en")])
    once = flat(evalset.upsert_cases(tables, "cases", first))
    assert once == [(0, "a" * 4000, "fr", True), (1, "b", "en", False)]
    assert flat(evalset.upsert_cases(tables, "cases", first)) == once
    changed = cases(spark, [(1, "b", "en"), (2, None, None)]).withColumn(
        "expectations", F.struct(F.lit("xx").alias("expected_language"), F.lit(True).alias("should_translate"))
    )
    assert flat(evalset.upsert_cases(tables, "cases", changed.where("inputs.doc_id = 1"))) == [
        once[0], (1, "b", "xx", True),
    ]
    assert evalset.upsert_cases(tables, "cases", changed).count() == 3


def test_dataset_as_benchmark(spark):
    dataset = cases(spark, [(0, "a", "fr"), (1, "b", "en"), (2, "c", "de"), (3, "d", "es")])
    fresh = spark.createDataFrame(
        [(0, "fr", "APPROVED"), (1, "en", "SKIPPED"), (2, "nl", "REJECTED"), (3, "en", "SKIPPED")],
        "doc_id long, detected_language string, status string",
    )
    assert tuple(evalset.check_against(dataset, fresh, "doc_id").first()) == (4, 0, 0.5, 0.75)
    part = evalset.check_against(dataset, fresh.limit(0), "doc_id").first()
    assert tuple(part) == (4, 4, 0.0, 0.0)


def test_stage_is_rebuilt_from_itself_and_old_versions_go(spark, tables):
    stage = tables.replace(spark.range(3).toDF("n"), "stage")
    tables.replace(stage.withColumn("m", F.col("n") * 2), "stage")
    assert stage.count() == 3
    tables.replace(tables.read("stage").withColumn("k", F.col("m") + 1), "stage")
    assert len(tables.versions("stage")) == 3
    assert tables.read(tables.versions("stage")[0]).columns == ["n"]
    tables.prune("stage", 2)
    assert len(tables.versions("stage")) == 2
    assert [tuple(r) for r in tables.read("stage").orderBy("n").collect()] == [(0, 0, 1), (1, 2, 3), (2, 4, 5)]
    tables.use()
    assert spark.table("stage").count() == 3
    spark.catalog.setCurrentDatabase("default")
    assert [r["n"] for r in preview(tables.read("stage"), ["n"], "n", 2).collect()] == [0, 1]
    tables.drop("stage")
    assert not tables.exists("stage") and not tables.versions("stage")


def test_dataset_table_is_made_once(spark, tables):
    schema = "a string, b int"
    assert tables.create_or_load("t", schema).count() == 0
    tables.append(spark.createDataFrame([("x", 1)], schema), "t")
    assert tables.create_or_load("t", schema).count() == 1


def test_spans_of_shared_calls_and_their_tree(spark, counting, inference):
    run = inference(counting(lambda e, p: "fr"))
    df = docs(spark, ["same", "same", "other"]).withColumn("file_name", F.lit("x.pdf"))
    tasks = [translate.detect_task(SETTINGS), translate.translate_task(SETTINGS)]
    run.answer(df, tasks)
    spans = observe.call_spans(df, tasks, run.store, "doc_id", "v2", metadata=["file_name"])
    assert spans.count() == 6
    assert {(r["file_name"], r["pipeline_version"]) for r in spans.collect()} == {("x.pdf", "v2")}
    tree = observe.span_tree(spans)
    roots = {r["trace_id"]: r for r in tree.where("parent is null").collect()}
    assert set(roots) == {"0", "1", "2"} and {r["children"] for r in roots.values()} == {2}
    assert {r["span_type"] for r in roots.values()} == {"CHAIN"}
    assert roots["0"]["in_chars"] == roots["1"]["in_chars"] != roots["2"]["in_chars"]


def test_spans_of_a_hot_call_are_complete(spark, counting, inference):
    run = inference(counting(lambda e, p: "fr"), hot_rows=20)
    df = docs(spark, ["same" if i % 3 else str(i) for i in range(90)])
    tasks = [translate.translate_task(SETTINGS)]
    hot = run.answer(df, tasks)
    assert hot.table.count() >= 1
    spans = observe.call_spans(df, tasks, run.store, "doc_id", "v2", hot)
    assert spans.count() == 90 and spans.select("trace_id").distinct().count() == 90


def test_root_spans_sum_up_children(spark):
    rows = [
        ("t", datetime(2024, 1, 1, 0, 0, 0), 1500, 10, 1, None),
        ("t", datetime(2024, 1, 1, 0, 0, 1), 2000, 20, 2, "down"),
    ]
    spans = spark.createDataFrame(
        rows, "trace_id string, started_at timestamp, duration_ms long, in_chars int, out_chars int, error string"
    )
    root = observe.root_spans(spans).first()
    assert (root["duration_ms"], root["busy_ms"], root["children"], root["errors"]) == (3000, 3500, 2, 1)


def test_runs_hold_params_metrics_and_speedup(spark, tables):
    clock = observe.StageClock({"one": 10.0, "two": 21.45})
    assert clock.metrics(629) == {"one_s": 10.0, "two_s": 21.4, "total_s": 31.4, "speedup": 20.0}
    assert observe.StageClock({"one": 0.1}).metrics(629)["speedup"] == 629.0
    tables.append(observe.run_rows(spark, "r", "eval", {"docs": 2}, clock.metrics()), RUNS)
    report = spark.createDataFrame([("mini", 5)], "endpoint string, num_documents long")
    tables.append(observe.metric_rows(report, "r", F.concat(F.lit("cmp_"), "endpoint"), ["num_documents"]), RUNS)
    rows = {(r["run_name"], r["kind"], r["key"]): r["value"] for r in tables.read(RUNS).collect()}
    assert rows[("eval", "param", "docs")] == "2"
    assert rows[("cmp_mini", "metric", "num_documents")] == "5.0"
    with pytest.raises(ZeroDivisionError), clock.stage("three"):
        1 / 0
    assert "three" in clock.seconds
