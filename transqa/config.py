"""Settings of the workflow: endpoints, prefix lengths, thresholds and text templates.

Everything here is a value, not code, so a run can replace any of it through
``Settings`` without touching an operator.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. Prompts, rationales and limits decide what a model answers and
# what a report says, so they are kept word for word. ``${name}`` marks a column.
# ---------------------------------------------------------------------------
DETECT_PROMPT = (
    "Identify the primary language of the following text. "
    "Return ONLY the ISO 639-1 language code (e.g., fr, de, ja, zh, es). "
    "If English, return en. Text: ${text}"
)
TRANSLATE_PROMPT = (
    "You are a professional translator. Translate the following text to English. "
    "Maintain the original meaning, tone, and structure. "
    "Preserve technical terminology. Only output the translated text.\n\nText:\n${text}"
)
TRANSLATE_PROMPT_WITH_SOURCE = (
    "You are a professional translator. Translate the following text to English. "
    "Maintain the original meaning, tone, and structure. "
    "Preserve technical terminology. Only output the translated text.\n\n"
    "Source language: ${lang}\n\nText:\n${text}"
)
BACK_TRANSLATE_PROMPT = (
    "You are a professional translator. Translate the following English text to "
    "${lang}. Maintain meaning, tone, and structure. "
    "Only output the translated text.\n\nText:\n${text}"
)
JUDGE_PROMPT = (
    "You are a translation quality judge. Compare the original text with its "
    "back-translation (original → English → original language).\n\n"
    "Determine if the back-translation preserves the MEANING of the original. "
    "Minor stylistic differences are acceptable. Focus on: semantic accuracy, "
    "completeness (no omissions), and factual correctness.\n\n"
    "ORIGINAL (${lang}):\n${original}\n\n"
    "BACK-TRANSLATION (${lang}):\n${back}\n\n"
    'Respond with JSON: {"passed": true/false, "rationale": "..."}'
)
TRANSLATION_GUIDELINES = (
    "The translation should preserve all factual information from the original.",
    "Technical terminology should be translated accurately or kept in original form.",
    "The translation should maintain the document's logical structure and flow.",
    "No content should be added that was not present in the original.",
)
SEMANTIC_ENGLISH_RATIONALE = "Document already in English, no translation needed."
COMPLETENESS_ENGLISH_RATIONALE = "Document already in English."
COMPLETENESS_FAIL = ("Translation is only ", " the length of original — likely content omitted.")
COMPLETENESS_PASS = ("Translation length ratio: ", " — within acceptable range.")
NO_RATIONALE = "No rationale provided"
ENGLISH = "en"
TEXT_ELEMENT_TYPES = ("text", "title", "section_header")
MIN_LENGTH_RATIO = 0.3
PROMPT_OVERHEAD_TOKENS = 50
CHARS_PER_TOKEN = 4
# ---------------------------------------------------------------------------

# Our own wording: the rule judge of the reference lives in a closed library.
GUIDELINE_PROMPT = (
    "Decide whether a translation follows a rule.\n\n"
    "RULE:\n${rule}\n\n"
    "ORIGINAL:\n${original}\n\n"
    "TRANSLATION:\n${translation}\n\n"
    'Respond with JSON: {"passed": true/false, "rationale": "..."}'
)


@dataclass(frozen=True)
class Endpoints:
    """Which model endpoint serves which task: a cheap one for easy tasks."""

    detect: str = "fast"
    translate: str = "standard"
    judge: str = "standard"
    comparison: tuple[str, ...] = ("mini", "standard", "premium")


@dataclass(frozen=True)
class Prefixes:
    """Characters kept of a text at each place where one may be cut; None keeps it whole.

    A cut is for a model whose window is short. Completeness compares whole lengths only where
    ``evaluate`` is None.
    """

    detect: int | None = None
    evaluate: int | None = None
    judge: int | None = None
    dataset: int | None = None
    compare: int | None = None

    @classmethod
    def reference(cls) -> Prefixes:
        """The fixed lengths of the published pipeline."""
        return cls(detect=2000, evaluate=5000, judge=3000, dataset=3000, compare=3000)


@dataclass(frozen=True)
class Settings:
    """One run's configuration, passed to the plans.

    ``key`` identifies a document. A file name does not: two folders may hold the
    same one. It is carried along as ``file_name`` where a table has it.
    """

    endpoints: Endpoints = field(default_factory=Endpoints)
    prefixes: Prefixes = field(default_factory=Prefixes)
    key: str = "source_path"
    skip_english: bool = False
    name_source_language: bool = False
    min_chars: int = 0
    parallelism: int | None = None
    threads_per_task: int = 4
    call_rounds: int = 1
    reuse_days: int | None = None
    hot_rows: int = 200_000
    rows_per_bucket: int = 1_000_000
    pipeline_version: str = "v2"
    guidelines: tuple[str, ...] = TRANSLATION_GUIDELINES

    def identity(self, columns: Sequence[str]) -> list[str]:
        """The columns that name a document, of those a table has."""
        return [self.key, *[c for c in ("file_name",) if c in columns and c != self.key]]
