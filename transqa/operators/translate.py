"""Language detection, translation to English and back-translation by a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transqa.config import (
    BACK_TRANSLATE_PROMPT,
    DETECT_PROMPT,
    TRANSLATE_PROMPT,
    TRANSLATE_PROMPT_WITH_SOURCE,
    Settings,
)
from transqa.functions.text import is_english, prefix, render, strip
from transqa.operators.infer import Inference, Task

DETECT = "detect_language"
TRANSLATE = "translate_to_english"
BACK_TRANSLATE = "back_translate"
NEEDS_BACK = "needs_back_translation"


def detect_task(settings: Settings, text: str = "extracted_text") -> Task:
    prompt = render(DETECT_PROMPT, text=prefix(text, settings.prefixes.detect))
    return Task(DETECT, settings.endpoints.detect, prompt, "_detected", F.col(text).isNotNull())


def translate_task(
    settings: Settings,
    text: str = "extracted_text",
    lang: str = "detected_language",
    endpoint: str | Column | None = None,
) -> Task:
    when = F.col(text).isNotNull()
    if settings.name_source_language:
        prompt = render(TRANSLATE_PROMPT_WITH_SOURCE, text=text, lang=lang)
        when = when & F.col(lang).isNotNull()
    else:
        prompt = render(TRANSLATE_PROMPT, text=text)
    if settings.skip_english:
        when = when & ~is_english(lang)
    chosen = settings.endpoints.translate if endpoint is None else endpoint
    return Task(TRANSLATE, chosen, prompt, "_translated", when)


def needs_back_translation(
    english: str = "english_translation", lang: str = "detected_language"
) -> Column:
    """Whether there is something to send back: never NULL."""
    return ~is_english(lang) & F.col(lang).isNotNull() & F.col(english).isNotNull()


def back_translate_task(
    settings: Settings,
    english: str = "english_translation",
    lang: str = "detected_language",
    when: Column | None = None,
) -> Task:
    prompt = render(BACK_TRANSLATE_PROMPT, text=english, lang=lang)
    needed = needs_back_translation(english, lang) if when is None else when
    return Task(BACK_TRANSLATE, settings.endpoints.translate, prompt, "_back", needed)


def detect(df: DataFrame, inference: Inference, settings: Settings) -> DataFrame:
    """Add ``detected_language``, stripped of all whitespace around the code."""
    task = detect_task(settings)
    return inference.run(df, [task]).select(*df.columns, _language(task))


def translate(df: DataFrame, inference: Inference, settings: Settings) -> DataFrame:
    """Add ``english_translation``; with ``skip_english`` English text is kept as it is."""
    task = translate_task(settings)
    translated = F.col(f"{task.out}.answer")
    if settings.skip_english:
        translated = F.when(is_english("detected_language"), F.col("extracted_text")).otherwise(translated)
    return inference.run(df, [task]).select(*df.columns, translated.alias("english_translation"))


def detect_and_translate(df: DataFrame, inference: Inference, settings: Settings) -> DataFrame:
    """Both in one pass over the documents, as the two calls are independent.

    They are not when the prompt names the source language or English is skipped;
    then detection runs first and its rows are written, as translation reads them several times.
    """
    if settings.skip_english or settings.name_source_language:
        stage = f"{inference.store.table}_detected"
        detected = inference.store.tables.replace(detect(df, inference, settings), stage)
        return translate(detected, inference, settings)
    detected, translated = detect_task(settings), translate_task(settings)
    return inference.run(df, [detected, translated]).select(
        *df.columns,
        _language(detected),
        F.col(f"{translated.out}.answer").alias("english_translation"),
    )


def back_translate(df: DataFrame, inference: Inference, settings: Settings) -> DataFrame:
    """Add ``back_translation``; for English it is the translation itself.

    English rows are neither sent nor joined. A row without a language or a translation has
    nothing to send and gets no back-translation. Where the table is partitioned by
    ``needs_back_translation``, both kinds of rows are read once, each from its own files.
    """
    needed = F.col(NEEDS_BACK) if NEEDS_BACK in df.columns else None
    task = back_translate_task(settings, when=needed)
    back = F.when(is_english("detected_language"), F.col("english_translation")).otherwise(
        F.col(f"{task.out}.answer")
    )
    return inference.run(df, [task]).select(*df.columns, back.alias("back_translation"))


def translate_documents(
    df: DataFrame, inference: Inference, settings: Settings, sample: int | None = None
) -> DataFrame:
    """Detection, translation and back-translation in one chain.

    ``sample`` keeps the first documents by key before anything is asked, for
    looking into single documents.
    """
    if sample is not None:
        df = df.orderBy(settings.key).limit(sample)
    df = detect_and_translate(df, inference, settings)
    return back_translate(df, inference, settings)


def _language(task: Task) -> Column:
    return strip(f"{task.out}.answer").alias("detected_language")
