"""Scorers and evaluation.

A scorer lists the prompts it needs and gives its verdict as a column
expression over the row and the answers. ``evaluate`` gathers the prompts of
all scorers into one inference pass, so rows are scanned and shuffled once
however many judges there are.

Rows carry ``inputs`` (original_text, detected_language, key) and ``outputs``
(english_translation, back_translation).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transqa.config import (
    COMPLETENESS_ENGLISH_RATIONALE,
    COMPLETENESS_FAIL,
    COMPLETENESS_PASS,
    GUIDELINE_PROMPT,
    JUDGE_PROMPT,
    MIN_LENGTH_RATIO,
    SEMANTIC_ENGLISH_RATIONALE,
    Settings,
)
from transqa.functions.judgment import FEEDBACK_TYPE, NULL_INPUT, feedback, parse_judgment
from transqa.functions.text import guarded_ratio, is_english, percent, prefix, render
from transqa.operators.infer import Inference, Task

SEMANTIC = "semantic_preservation"
COMPLETENESS = "completeness_check"
GUIDELINES = "translation_quality"

ORIGINAL = "inputs.original_text"
LANGUAGE = "inputs.detected_language"
ENGLISH_TEXT = "outputs.english_translation"
BACK_TEXT = "outputs.back_translation"


@dataclass(frozen=True)
class Scorer:
    """A named verdict: a column of type ``struct<value,rationale,error>``.

    ``direct`` is the verdict that needs no model; where it is NULL, ``judged`` reads
    the answers of ``tasks``.
    """

    name: str
    direct: Column | None = None
    tasks: tuple[Task, ...] = ()
    judged: Column | None = None


def scorer(name: str) -> Callable[[Callable[[Column, Column], Column]], Scorer]:
    """Make a scorer from a function of the ``inputs`` and ``outputs`` columns."""

    def make(function: Callable[[Column, Column], Column]) -> Scorer:
        return Scorer(name, function(F.col("inputs"), F.col("outputs")))

    return make


def python_scorer(
    name: str, function: Callable[[dict, dict], tuple[bool | None, str | None]]
) -> Scorer:
    """Make a scorer from a Python function of two dicts, sent over in Arrow batches."""

    @F.pandas_udf(FEEDBACK_TYPE)
    def score(inputs: pd.DataFrame, outputs: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for i, o in zip(inputs.to_dict("records"), outputs.to_dict("records")):
            try:
                value, rationale = function(i, o)
                rows.append((value, rationale, None))
            except Exception as failure:  # noqa: BLE001 - an error is a result here
                rows.append((None, None, f"{type(failure).__name__}: {failure}"))
        return pd.DataFrame(rows, columns=["value", "rationale", "error"], dtype=object)

    return Scorer(name, score(F.col("inputs"), F.col("outputs")))


def completeness_check(inputs: Column, outputs: Column) -> Column:
    """Fail a translation shorter than 0.3 of its original; English passes."""
    original, translation = inputs["original_text"], outputs["english_translation"]
    ratio = guarded_ratio(F.length(translation), F.length(original), 1)
    text = percent(ratio)
    failed, passed = COMPLETENESS_FAIL, COMPLETENESS_PASS
    return (
        F.when(inputs["detected_language"].isNull(), feedback(None, None, NULL_INPUT))
        .when(is_english(inputs["detected_language"]), feedback(True, COMPLETENESS_ENGLISH_RATIONALE))
        .when(ratio.isNull(), feedback(None, None, NULL_INPUT))
        .when(ratio < MIN_LENGTH_RATIO, feedback(False, F.concat(F.lit(failed[0]), text, F.lit(failed[1]))))
        .otherwise(feedback(True, F.concat(F.lit(passed[0]), text, F.lit(passed[1]))))
    )


def completeness_scorer() -> Scorer:
    return scorer(COMPLETENESS)(completeness_check)


def semantic_scorer(settings: Settings) -> Scorer:
    """A judge compares original and back-translation; English passes unasked."""
    cut = settings.prefixes.judge
    prompt = render(
        JUDGE_PROMPT, lang=LANGUAGE, original=prefix(ORIGINAL, cut), back=prefix(BACK_TEXT, cut)
    )
    english = is_english(LANGUAGE)
    task = Task(
        SEMANTIC, settings.endpoints.judge, prompt, "_semantic",
        ~english & _present(LANGUAGE, ORIGINAL, BACK_TEXT),
    )
    unasked = F.when(english, feedback(True, SEMANTIC_ENGLISH_RATIONALE))
    return Scorer(SEMANTIC, unasked, (task,), _judged(task))


def guidelines_scorer(
    settings: Settings,
    name: str = GUIDELINES,
    guidelines: Sequence[str] | None = None,
    per_rule: bool = False,
) -> Scorer:
    """A judge checks a translation against rules; it must keep all of them.

    All rules go into one call. With ``per_rule`` each is a call of its own, and the
    rationale tells the broken ones: as many calls and copies of the texts as rules.
    """
    rules = list(settings.guidelines if guidelines is None else guidelines)
    if not per_rule:
        rules = ["\n".join(rules)]
    tasks = tuple(
        Task(
            name,
            settings.endpoints.judge,
            render(GUIDELINE_PROMPT, rule=F.lit(rule), original=ORIGINAL, translation=ENGLISH_TEXT),
            f"_{name}_{i}",
            _present(ORIGINAL, ENGLISH_TEXT),
        )
        for i, rule in enumerate(rules)
    )
    verdicts = F.array(*[_judged(task) for task in tasks])
    errors = F.filter(verdicts, lambda v: v["error"].isNotNull())
    broken = F.filter(verdicts, lambda v: ~v["value"])
    reasons = F.concat_ws("; ", F.transform(broken, lambda v: v["rationale"]))
    verdict = (
        F.when(F.size(errors) > 0, feedback(None, None, errors[0]["error"]))
        .when(F.size(broken) > 0, feedback(False, reasons))
        .otherwise(feedback(True, "All guidelines are met."))
    )
    return Scorer(name, None, tasks, verdict)


def default_scorers(settings: Settings) -> list[Scorer]:
    return [semantic_scorer(settings), completeness_scorer(), guidelines_scorer(settings)]


def evaluation_records(
    df: DataFrame, settings: Settings, keep: Sequence[str] = (), cut: int | None = None
) -> DataFrame:
    """Nest rows into ``inputs`` and ``outputs``, texts cut before anything moves."""
    chars = settings.prefixes.evaluate if cut is None else cut
    return df.select(
        *keep,
        F.struct(
            prefix("extracted_text", chars).alias("original_text"),
            F.col("detected_language"),
            *settings.identity(df.columns),
        ).alias("inputs"),
        F.struct(
            prefix("english_translation", chars).alias("english_translation"),
            prefix("back_translation", chars).alias("back_translation"),
        ).alias("outputs"),
    )


def evaluate(
    records: DataFrame,
    scorers: Sequence[Scorer],
    inference: Inference | None = None,
    keep: Sequence[Column | str] = ("inputs", "outputs"),
) -> DataFrame:
    """Apply all scorers to all rows: the ``keep`` columns and one verdict per scorer.

    Verdicts that need no model are taken before the answers are joined, and
    judges need no text after it. With keys alone in ``keep``, no document text is
    shuffled for scoring.
    """
    tasks = [task for s in scorers for task in s.tasks]
    if tasks and inference is None:
        raise ValueError("these scorers ask a model: give an inference")
    kept = records.select(*keep).columns
    direct = [s.direct.alias(s.name) for s in scorers if s.direct is not None]
    rest = [c for c in records.columns if c not in kept]
    rows = records.select(*rest, *keep, *direct)
    if not tasks:
        return rows.select(*kept, *[s.name for s in scorers])
    carry = [*kept, *[s.name for s in scorers if s.direct is not None]]
    answered = inference.run(rows, tasks, carry)
    return answered.select(*kept, *[_verdict(s).alias(s.name) for s in scorers])


def tidy_scores(evaluated: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per document and scorer."""
    scores = F.array(
        *[F.struct(F.lit(n).alias("scorer"), F.col(n).alias("verdict")) for n in names]
    )
    return evaluated.select(*keys, F.explode(scores).alias("s")).select(
        *keys, "s.scorer", "s.verdict.value", "s.verdict.rationale", "s.verdict.error"
    )


def scorer_metrics(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pass rate, counts and errors per scorer, errors left out of the rate."""
    return scores.groupBy(*by, "scorer").agg(
        F.avg(F.col("value").cast("double")).alias("pass_rate"),
        F.count("value").alias("scored"),
        F.count_if(F.col("value")).alias("passed"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )


def flat_results(evaluated: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns ``<scorer>/value`` and ``<scorer>/rationale`` beside the request."""
    others = [c for c in evaluated.columns if c not in names]
    flat = [
        F.col(f"{n}.{part}").alias(f"{n}/{part}") for n in names for part in ("value", "rationale")
    ]
    return evaluated.select(*others, *flat)


def pivot_scores(scores: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Tidy scores back to one row per document, under the flat column names."""
    return scores.groupBy(key).agg(
        *[
            F.max(F.when(F.col("scorer") == n, F.col(part))).alias(f"{n}/{part}")
            for n in names
            for part in ("value", "rationale")
        ]
    )


def _judged(task: Task) -> Column:
    """The verdict in an answer, or the reason there is none."""
    reply = F.col(task.out)
    return (
        F.when(reply.isNull(), feedback(None, None, NULL_INPUT))
        .when(reply["error"].isNotNull(), feedback(None, None, reply["error"]))
        .otherwise(parse_judgment(reply["answer"]))
    )


def _verdict(scorer: Scorer) -> Column:
    if scorer.direct is None:
        return scorer.judged
    taken = F.col(scorer.name)
    return taken if scorer.judged is None else F.coalesce(taken, scorer.judged)


def _present(*columns: str) -> Column:
    result = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        result = result & F.col(name).isNotNull()
    return result
