import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transqa.functions import text as tx
from transqa.functions.detect import detect_language


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_strip_equals_python(spark):
    space = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    values = ["en ", "en\n", " fr\t", "EN", f"{space}a b{space}", space, "", "\u200bx", None]
    assert column(spark, values, tx.strip("x")) == [v and v.strip() for v in values]


def test_trim_takes_spaces_only(spark):
    assert column(spark, [" fr ", "fr\n"], tx.trim_spaces("x")) == ["fr", "fr\n"]


def test_english_is_decided_after_stripping_and_never_null(spark):
    values = ["en", " en\n", "EN", "fr", None]
    assert column(spark, values, tx.is_english("x")) == [True, True, False, False, False]


@pytest.mark.parametrize(
    "path,name", [("/a/b/c.pdf", "c.pdf"), ("c.pdf", "c.pdf"), ("/a/b/", ""), ("s3://b/ü x.pdf", "ü x.pdf")]
)
def test_file_name(spark, path, name):
    assert column(spark, [path], tx.file_name("x")) == [name]


def test_tokens_and_prefix_count_characters(spark):
    values = ["", None, "abc", "abcd", "é" * 9, "😀" * 8]
    assert column(spark, values, tx.estimate_tokens("x")) == [0, 0, 0, 1, 2, 2]
    assert column(spark, ["😀é" * 3], tx.prefix("x", 3)) == ["😀é😀"]


def test_percent_rounds_like_python(spark):
    values = [i / 1000 for i in range(1001)] + [12.345, 0.125, 0.375, 3.0]
    assert column(spark, values, tx.percent(F.col("x")), "double") == [f"{v:.0%}" for v in values]


def test_round_half_even(spark):
    values = [2.25, 2.35, 0.5, 1.5, 2.75]
    assert column(spark, values, tx.round_half_even(F.col("x"), 1), "double") == [round(v, 1) for v in values]


def test_guarded_ratio(spark):
    assert column(spark, [0, 4], tx.guarded_ratio(F.lit(6), F.col("x"), 1), "int") == [6.0, 1.5]


def python_fence(text):
    clean = text.strip()
    if clean[:3] == "```":
        rest = clean[clean.find("\n") + 1:] if "\n" in clean else clean
        cut = rest.rfind("```")
        clean = (rest[:cut] if cut >= 0 else rest).strip()
    return clean


FENCED = [
    '{"a": 1}', '```json\n{"a": 1}\n```', '```\n{"a": 1}\n```\n', '```json {"a": 1} ```',
    '```json\n{"a": 1}', '  ```\n\n{"a": "```"}\n``` ', "```", "``` ```", "", "text ```x```", "```\n```",
    '```json\n{"a":\n 1}\n```\ntrailing',
]


def test_code_fence(spark):
    assert column(spark, FENCED, tx.strip_code_fence("x")) == [python_fence(v) for v in FENCED]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="`\n {}a", max_size=12), min_size=1, max_size=40))
def test_code_fence_on_any_text(spark, values):
    assert column(spark, values, tx.strip_code_fence("x")) == [python_fence(v) for v in values]


def test_prompts_keep_any_character(spark):
    text = "it's \"c:\\temp\" $1 ${x}\n😀"
    assert column(spark, [text, None], tx.render("Say ${t} in ${t}.", t="x")) == [
        f"Say {text} in {text}.", None,
    ]


def test_french_sentence_is_french(spark):
    text = "Bonjour le monde, ceci est un test de détection de langue."
    assert column(spark, [text], detect_language("x")) == ["fr"]


def test_detection_edges(spark):
    values = ["", "12 34", None, "the and der und", "la la la", "x " * 1000 + " the"]
    # Ties go to the first code; stop words beyond a wanted prefix do not count.
    assert column(spark, values, detect_language("x")) == ["und", "und", None, "de", "es", "en"]
    assert column(spark, values, detect_language("x", 2000)) == ["und", "und", None, "de", "es", "und"]


def test_detection_has_no_shuffle_and_prunes_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = docs.select("doc_id", detect_language("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", plan)
