"""Shapes of plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from transqa.config import Settings
from transqa.doubles import DoubleClient
from transqa.operators import compare, translate
from transqa.operators.infer import attach_answers
from transqa.plans.workflow import PHASE_ONE, Workflow

SETTINGS = Settings(key="doc_id")


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.col("text").alias("extracted_text"), "lang"
    )


def test_prompts_move_twice_and_answers_as_digests(spark, counting, inference, no_broadcast):
    run = inference(counting(lambda e, p: "fr"))
    plan = plan_of(run.unanswered(documents(spark), [translate.translate_task(SETTINGS)]))
    # One shuffle by digest for dropping copies and the join that marks answered prompts
    # (answered ones stay, to count hot calls), one to spread the calls, one of stored digests.
    assert plan.count("Exchange") == 3
    assert "partial_first" in plan and "LeftOuter" in plan
    stored = plan[plan.index("answers["):]
    assert "ReadSchema: struct<key:string,error:string>" in stored
    assert "struct<text:string>" in plan


def test_attached_rows_are_shuffled_once(spark, counting, inference, no_broadcast):
    run = inference(counting(lambda e, p: "fr"))
    docs = documents(spark).where("extracted_text is not null")
    tasks = [translate.detect_task(SETTINGS), translate.translate_task(SETTINGS)]
    run.answer(docs, tasks)
    plan = plan_of(attach_answers(docs, tasks, run.store))
    scans = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    # Whole rows are read for the join, the digests from the text alone. A second reading
    # looks for rows without text, and skips every row group that has none.
    assert scans.count("doc_id:bigint,text:string,lang:string") <= 2
    assert plan.count("Exchange") == 5
    for idle in plan.split("Union")[1:]:
        assert "PushedFilters: [IsNotNull(text), IsNull(text)]" in idle


def test_phase_two_reads_each_row_once(spark, tables):
    flow = Workflow(tables, DoubleClient, SETTINGS)
    flow.phase_one(documents(spark))
    back = translate.back_translate(tables.read(PHASE_ONE), flow.inference, SETTINGS)
    filters = {p.split("]")[0] for p in plan_of(back).split("PartitionFilters: [")[1:]}
    filters = {re.sub(r"#\d+", "", f) for f in filters if "needs_back" in f}
    column = "needs_back_translation"
    assert filters == {f"isnotnull({column}), {column}", f"isnotnull({column}), NOT {column}"}


def test_endpoints_fan_out_without_a_join(spark):
    plan = plan_of(compare.across_endpoints(documents(spark), ["a", "b", "c"]))
    assert "Generate explode" in plan and "Join" not in plan and "Exchange" not in plan


def test_final_join_moves_no_text(spark, tables, no_broadcast):
    from transqa.operators import routing, scoring
    from transqa.plans.workflow import EVALUATION, PHASE_TWO

    settings = Settings(key="doc_id", rows_per_bucket=50)
    flow = Workflow(tables, DoubleClient, settings)
    flow.phase_one(documents(spark))
    flow.phase_two()
    flow.evaluate([scoring.semantic_scorer(settings), scoring.completeness_scorer()])
    final = routing.attach_results(tables.read(PHASE_TWO), tables.read(EVALUATION), "doc_id")
    plan = plan_of(final)
    # Both sides are bucketed by key with one count (200 rows, 50 a bucket): the join
    # needs no exchange, on the side with texts or any other.
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert final.count() == tables.read(PHASE_TWO).count()
    assert final.where("status is null").count() == 0


def test_a_text_moves_once_for_all_endpoints(spark, counting, inference, no_broadcast):
    run = inference(counting(lambda e, p: f"{e} of {len(p)}"))
    sample = documents(spark).select("doc_id", "extracted_text")
    done = compare.translate_by_endpoint(sample, run, SETTINGS)
    # Rows fan out above the join that attaches the answers.
    plan = plan_of(done)
    assert "Generate explode" in plan.split("Exchange")[0]
    assert done.count() == 3 * sample.count()
    assert {r[0] for r in done.select(F.substring_index("english_translation", " ", 1)).distinct().collect()
            } == {*SETTINGS.endpoints.comparison}


def test_detection_is_written_before_translation_reads_it(spark, tables):
    from dataclasses import replace

    flow = Workflow(tables, DoubleClient, replace(SETTINGS, skip_english=True))
    plan = plan_of(translate.detect_and_translate(
        documents(spark).drop("lang"), flow.inference, flow.settings))
    assert flow.tables.exists("answers_detected") and "answers_detected" in plan
