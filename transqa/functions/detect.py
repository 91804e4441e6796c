"""Model-free language detection by stop-word counts, as one narrow expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from transqa.functions.text import bind, col, prefix

# The commonest function words of each language, from the public
# Snowball stop-word lists.
STOP_WORDS: Mapping[str, tuple[str, ...]] = {
    "de": (
        "aber", "auch", "auf", "aus", "bei", "das", "dem", "den", "der", "des", "die", "ein",
        "eine", "für", "ich", "im", "ist", "mit", "nicht", "sich", "und", "von", "wie", "zu",
    ),
    "en": (
        "a", "and", "are", "as", "at", "be", "by", "for", "from", "have", "in", "is",
        "it", "not", "of", "on", "or", "that", "the", "this", "to", "was", "which", "with",
    ),
    "es": (
        "al", "como", "con", "de", "del", "el", "en", "es", "la", "las", "lo", "los",
        "más", "no", "para", "pero", "por", "que", "se", "su", "un", "una", "y", "ya",
    ),
    "fr": (
        "au", "avec", "ce", "ceci", "dans", "de", "des", "du", "elle", "en", "est", "et",
        "il", "la", "le", "les", "ne", "pas", "pour", "que", "qui", "sur", "un", "une",
    ),
    "it": (
        "anche", "che", "come", "con", "da", "dal", "del", "della", "di", "e", "gli", "il",
        "in", "la", "le", "ma", "nel", "non", "per", "più", "si", "sono", "su", "una",
    ),
    "nl": (
        "aan", "dat", "de", "die", "een", "en", "er", "het", "hij", "ik", "in", "is",
        "met", "niet", "om", "op", "te", "uit", "van", "voor", "was", "wat", "ze", "zijn",
    ),
}
UNDETERMINED = "und"


def words(text: Column | str) -> Column:
    """Lower-case words of a text: maximal runs of letters."""
    return F.split(F.lower(col(text)), r"[^\p{L}]+")


def detect_language(
    text: Column | str,
    chars: int | None = None,
    profiles: Mapping[str, tuple[str, ...]] = STOP_WORDS,
) -> Column:
    """The language whose stop words occur most often in a text, or in its first ``chars``.

    Ties go to the code that sorts first; no hit at all gives ``und``.
    The profile is a literal inside the expression, so there is no join, no
    explode and no shuffle: detection runs in the scan stage at any size.
    """
    best = bind(words(prefix(text, chars)), lambda tokens: _best(tokens, profiles))
    return (
        F.when(col(text).isNull(), F.lit(None).cast("string"))
        .when(best["hits"] > 0, best["code"])
        .otherwise(F.lit(UNDETERMINED))
    )


def _best(tokens: Column, profiles: Mapping[str, tuple[str, ...]]) -> Column:
    """The profile with most hits; the order breaks ties."""
    ranked = [
        F.struct(
            F.size(_among(tokens, profiles[code])).alias("hits"),
            F.lit(-rank).alias("order"),
            F.lit(code).alias("code"),
        )
        for rank, code in enumerate(sorted(profiles))
    ]
    return F.array_max(F.array(*ranked))


def _among(tokens: Column, chosen: tuple[str, ...]) -> Column:
    return F.filter(tokens, lambda word: word.isin(*chosen))
