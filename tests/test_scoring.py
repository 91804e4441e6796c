from dataclasses import replace

from pyspark.sql import functions as F

from transqa.config import Prefixes, Settings
from transqa.operators import scoring

SETTINGS = Settings(key="doc_id")


def records(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "doc_id long, extracted_text string, detected_language string, "
        "english_translation string, back_translation string",
    )
    return scoring.evaluation_records(df, SETTINGS)


def verdicts(evaluated, name):
    rows = evaluated.orderBy("inputs.doc_id").select(f"{name}.*").collect()
    return [tuple(r) for r in rows]


def test_completeness_edges(spark):
    rows = [
        ("", "fr", "", ""), ("", "fr", "abcde", ""), ("x" * 100, "fr", "y" * 29, ""),
        ("x" * 100, "fr", "y" * 30, ""), ("x" * 20000, "fr", "y" * 5000, ""),
        ("x" * 100, " en\n", "", ""), (None, "fr", "a", ""), ("a", "fr", None, ""), ("a", None, "a", ""),
        (None, "en", None, ""),
    ]
    got = verdicts(scoring.evaluate(records(spark, rows), [scoring.completeness_scorer()]), scoring.COMPLETENESS)
    assert [v[0] for v in got] == [False, True, False, True, False, True, None, None, None, True]
    assert [v[2] for v in got] == [None] * 6 + ["null_input"] * 3 + [None]
    assert got[2][1] == "Translation is only 29% the length of original — likely content omitted."
    assert got[1][1] == "Translation length ratio: 500% — within acceptable range."
    assert got[4][1] == "Translation is only 25% the length of original — likely content omitted."
    assert got[5][1] == "Document already in English."


def judge(endpoint, prompt):
    original = prompt.split("\nORIGINAL (")[1].split("):\n")[1].split("\n\nBACK")[0]
    back = prompt.split("BACK-TRANSLATION (")[1].split("):\n")[1].split("\n\nRespond")[0]
    if original == "broken":
        return "no json"
    same = str(original == back).lower()
    return f'```json\n{{"passed": {same}, "rationale": "compared"}}\n```'


def test_semantic_judge(spark, counting, inference):
    calls = counting(judge)
    text = "Bonjour le monde. Ceci est un document de test pour la traduction."
    rows = [
        (text, "fr", "Hello world. This is a test document for translation.", text),
        (text, "fr", "Hello.", "Salut."), ("Hello", "en", "Hello", "Hello"),
        ("broken", "fr", "x", "y"), (text, "fr", "Hello", None), (text, None, "Hello", text),
    ]
    scorer = scoring.semantic_scorer(SETTINGS)
    got = verdicts(scoring.evaluate(records(spark, rows), [scorer], inference(calls)), scorer.name)
    assert got == [
        (True, "compared", None), (False, "compared", None),
        (True, "Document already in English, no translation needed.", None),
        (None, None, "judge_json"), (None, None, "null_input"), (None, None, "null_input"),
    ]
    assert len(calls.prompts) == 3


def test_judge_sees_prefixes(spark, counting, inference):
    calls = counting(lambda e, p: '{"passed": true}')
    scorer = scoring.semantic_scorer(replace(SETTINGS, prefixes=Prefixes.reference()))
    rows = [("~" * 9000, "fr", "y", "^" * 4000)]
    scoring.evaluate(records(spark, rows), [scorer], inference(calls))
    (_, prompt), = calls.prompts
    assert prompt.count("~") == 3000 and prompt.count("^") == 3000


def rules(endpoint, prompt):
    rule, rest = prompt.split("RULE:\n")[1].split("\n\nORIGINAL:\n")
    if "failing" in rest:
        raise RuntimeError("down")
    return f'{{"passed": {str(rule not in rest).lower()}, "rationale": "broke {rule}"}}'


def test_guidelines_need_all_rules(spark, counting, inference):
    calls = counting(rules)
    scorer = scoring.guidelines_scorer(SETTINGS, "rules", ["one", "two", "three"], per_rule=True)
    rows = [("text", "fr", "fine", ""), ("text", "en", "one two", ""), ("failing", "fr", "x", ""), ("t", "fr", None, "")]
    got = verdicts(scoring.evaluate(records(spark, rows), [scorer], inference(calls)), "rules")
    assert got == [
        (True, "All guidelines are met.", None), (False, "broke one; broke two", None),
        (None, None, "RuntimeError: down"), (None, None, "null_input"),
    ]
    assert len(calls.prompts) == 9


def test_joint_guidelines_are_one_call(spark, counting, inference):
    calls = counting(lambda e, p: '{"passed": true, "rationale": "ok"}')
    scorer = scoring.guidelines_scorer(SETTINGS)
    evaluated = scoring.evaluate(records(spark, [("a", "fr", "b", "c")]), [scorer], inference(calls))
    assert verdicts(evaluated, scorer.name)[0][0] is True
    (_, prompt), = calls.prompts
    assert all(rule in prompt for rule in SETTINGS.guidelines)


def test_results_tidy_flat_and_wide(spark):
    @scoring.scorer("short")
    def short(inputs, outputs):
        return scoring.feedback(F.length(outputs["english_translation"]) < 3, "measured")

    boom = scoring.python_scorer("boom", lambda i, o: (i["doc_id"] == 0, str(1 // i["doc_id"])))
    rows = [("a", "fr", "b", "c"), ("a", "fr", "long text", "c")]
    scorers = [short, boom]
    names = [s.name for s in scorers]
    evaluated = scoring.evaluate(
        records(spark, rows), scorers, keep=[F.col("inputs.doc_id").alias("doc_id")]
    )
    scores = scoring.tidy_scores(evaluated, names, ["doc_id"])
    got = {(r["doc_id"], r["scorer"]): (r["value"], r["rationale"]) for r in scores.collect()}
    assert got == {
        (0, "short"): (True, "measured"), (1, "short"): (False, "measured"),
        (0, "boom"): (None, None), (1, "boom"): (False, "1"),
    }
    flat = scoring.flat_results(evaluated, names)
    wide = scoring.pivot_scores(scores, names, "doc_id")
    assert flat.columns == wide.columns
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, wide.collect()))
    metrics = {r["scorer"]: r for r in scoring.scorer_metrics(scores).collect()}
    assert (metrics["short"]["pass_rate"], metrics["short"]["scored"]) == (0.5, 2)
    assert (metrics["boom"]["pass_rate"], metrics["boom"]["errors"], metrics["boom"]["scored"]) == (0.0, 1, 1)


def test_scoring_by_key_shuffles_no_text(spark, counting, inference):
    calls = counting(judge)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.col("text").alias("extracted_text"), F.col("lang").alias("detected_language"),
        F.col("text").alias("english_translation"), F.col("text").alias("back_translation"),
    )
    scorers = [scoring.semantic_scorer(SETTINGS), scoring.completeness_scorer()]
    keep = [F.col("inputs.doc_id").alias("doc_id")]
    evaluated = scoring.evaluate(scoring.evaluation_records(df, SETTINGS), scorers, inference(calls), keep)
    left = joined_columns(evaluated._jdf.queryExecution().optimizedPlan())
    assert "_set" in left and "doc_id" in left
    assert not left & {"inputs", "outputs", "extracted_text", "text"}


def joined_columns(plan):
    """Names of the columns that enter the first join from the left."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if plan.nodeName() == "Join":
        output = children[0].output()
        return {output.apply(i).name() for i in range(output.size())}
    return next((found for c in children if (found := joined_columns(c))), set())
