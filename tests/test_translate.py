from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from transqa.config import Settings
from transqa.doubles import DoubleClient
from transqa.operators import translate
from transqa.plans.workflow import Workflow

SETTINGS = Settings(key="doc_id")
TEXTS = [
    "the cat and the dog", "le chat et le chien", "der Hund und die Katze", "le chat et le chien",
    None, "it's 'quoted' \\ back\nnew 😀 que los",
]


def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, extracted_text string")


def answer(endpoint, prompt):
    if prompt.startswith("Identify"):
        text = prompt.split("return en. Text: ")[1]
        return "en\n" if " and " in text else " fr " if "chat" in text else "\tde" if "Hund" in text else "es"
    return f"{endpoint}<{prompt[-12:]}>"


def kinds(calls):
    heads = {"Identify": "detect", "following English": "back", "to English": "translate"}
    return [next(v for k, v in heads.items() if k in p[:120]) for _, p in calls.prompts]


def test_two_phases_ask_for_each_distinct_need_once(spark, tables, counting):
    calls = counting(answer)
    flow = Workflow(tables, calls.factory(), SETTINGS)
    one = flow.phase_one(docs(spark))
    # NULL text is dropped; the repeated French text is asked once.
    assert one.count() == 5
    asked = kinds(calls)
    assert asked.count("detect") == 4 and asked.count("translate") == 4
    two = flow.phase_two()
    # English is copied and not sent.
    assert kinds(calls).count("back") == 3
    rows = {r["doc_id"]: r for r in two.collect()}
    assert len(rows) == 5
    assert rows[0]["detected_language"] == "en"
    assert rows[0]["back_translation"] == rows[0]["english_translation"]
    assert [rows[i]["detected_language"] for i in (1, 2, 3, 5)] == ["fr", "de", "fr", "es"]
    assert rows[1]["back_translation"].startswith("standard<")
    # The endpoint of the easy task is its own.
    assert {e for e, p in calls.prompts if p.startswith("Identify")} == {"fast"}
    before = len(calls.prompts)
    flow.phase_one(docs(spark))
    flow.phase_two().count()
    assert len(calls.prompts) == before


def test_the_row_form_spares_english_and_names_the_language(spark, tables, counting):
    calls = counting(answer)
    settings = replace(SETTINGS, skip_english=True, name_source_language=True)
    flow = Workflow(tables, calls.factory(), settings)
    flow.phase_one(docs(spark))
    rows = {r["doc_id"]: r for r in flow.phase_two().collect()}
    assert rows[0]["english_translation"] == rows[0]["back_translation"] == TEXTS[0]
    asked = [p for _, p in calls.prompts if "to English" in p[:120] and "Source" in p]
    assert len(asked) == 3 and any("Source language: fr\n" in p for p in asked)


def test_missing_language_or_translation_is_neither_sent_nor_lost(spark, counting, inference):
    calls = counting()
    rows = [(0, None, "x"), (1, "fr", None), (2, "fr", "y"), (3, "en", None), (4, "en", "z")]
    df = spark.createDataFrame(rows, "doc_id long, detected_language string, english_translation string")
    result = translate.back_translate(df, inference(calls), SETTINGS).orderBy("doc_id").collect()
    assert len(calls.prompts) == 1
    assert [r["back_translation"] is None for r in result] == [True, True, False, True, False]
    assert result[4]["back_translation"] == "z"


def test_a_sample_is_cut_before_anything_is_asked(spark, counting, inference):
    calls = counting(answer)
    result = translate.translate_documents(docs(spark), inference(calls), SETTINGS, sample=1)
    assert result.count() == 1
    assert kinds(calls) == ["detect", "translate"]


def test_detection_and_translation_see_the_whole_text(spark, counting, inference):
    calls = counting(answer)
    df = spark.createDataFrame([(0, "x" * 2500 + "END")], "doc_id long, extracted_text string")
    translate.translate_documents(df, inference(calls), SETTINGS)
    sent = {k: p for k, (_, p) in zip(kinds(calls), calls.prompts)}
    assert sent["detect"].count("x") == 2500 + "Identify the primary language of the following text".count("x") + 1
    assert sent["translate"].endswith("END")


@pytest.mark.parametrize("min_chars,kept", [(0, 6), (1, 5)])
def test_min_chars(spark, tables, min_chars, kept):
    rows = docs(spark).where("extracted_text is not null")
    rows = rows.unionByName(spark.createDataFrame([(9, "")], rows.schema))
    flow = Workflow(tables, DoubleClient, replace(SETTINGS, min_chars=min_chars))
    assert flow.phase_one(rows).count() == kept


def test_whole_workflow_from_parsed_documents(spark, tables):
    parsed = docs(spark).where("extracted_text is not null").select(
        # All files are named alike and told apart by their folders.
        F.concat(F.lit("/in/"), "doc_id", F.lit("/same.pdf")).alias("source_path"),
        F.to_variant_object(
            F.struct(F.struct(F.array(F.struct(
                F.lit("text").alias("type"), F.col("extracted_text").alias("content")
            )).alias("elements")).alias("document"))
        ).alias("parsed_result"),
    )
    flow = Workflow(tables, DoubleClient)
    flow.parse(parsed)
    final = flow.run()
    assert final.columns == [
        "source_path", "file_name", "extracted_text", "detected_language", "english_translation",
        "back_translation", "status", "semantic_preservation_rationale", "completeness_rationale",
    ]
    assert final.count() == 5
    assert {r["file_name"] for r in final.select("file_name").collect()} == {"same.pdf"}
    assert flow.grow_dataset().count() == 5
    assert flow.grow_dataset().count() == 5
    report = flow.compare(count=2).collect()
    assert {r["endpoint"] for r in report} == {"mini", "standard", "premium"}
    assert {r["num_documents"] for r in report} == {2}
    runs = flow.log_run("evaluation", 5, 629.0)
    keys = {r["key"] for r in runs.collect()}
    assert {"llm_endpoint", "num_documents", "pipeline_version", "phase_one_s", "total_s", "speedup"} <= keys
    names = {r["run_name"] for r in runs.where("kind = 'metric' AND key = 'tokens_per_second'").collect()}
    assert names == {"comparison_mini", "comparison_standard", "comparison_premium"}
    assert runs.where("run_name = 'evaluation_completeness_check' AND key = 'scored'").first()["value"] == "5.0"
