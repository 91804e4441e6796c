"""String and number scalars. All are built-in expressions that stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from transqa.config import CHARS_PER_TOKEN, ENGLISH

# The code points Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
FILE_NAME_PATTERN = "([^/]+)$"
FENCE = "```"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Higher-order functions do not share common subexpressions; a lambda's variable
    does the sharing.
    """
    return F.transform(F.array(value), body)[0]


def file_name(path: Column | str) -> Column:
    """Last segment of a path; '' when the path ends in a slash."""
    return F.regexp_extract(col(path), FILE_NAME_PATTERN, 1)


def trim_spaces(text: Column | str) -> Column:
    return F.trim(col(text))


def strip(text: Column | str) -> Column:
    """Remove all leading and trailing Unicode whitespace."""
    return F.btrim(col(text), F.lit(PYTHON_WHITESPACE))


def prefix(text: Column | str, chars: int | None) -> Column:
    """The first characters of a text, or all of it."""
    return col(text) if chars is None else F.substring(col(text), 1, chars)


def or_empty(text: Column | str) -> Column:
    return F.coalesce(col(text), F.lit(""))


def guarded_ratio(numerator: Column, denominator: Column, floor: float) -> Column:
    """``numerator / max(denominator, floor)``, which never divides by zero.

    A missing denominator gives NULL, where ``greatest`` would skip it.
    """
    return numerator / F.when(denominator < floor, F.lit(floor)).otherwise(denominator)


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def percent(ratio: Column) -> Column:
    """A ratio as whole percent text, rounded half to even."""
    return F.concat(F.bround(ratio * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def is_english(lang: Column | str) -> Column:
    """Never NULL, so the two branches of a split keep every row."""
    return strip(lang).eqNullSafe(F.lit(ENGLISH))


def estimate_tokens(text: Column | str) -> Column:
    """Whole tokens at four characters each; 0 for empty or missing text."""
    tokens = (F.length(col(text)) / F.lit(CHARS_PER_TOKEN)).cast("bigint")
    return F.coalesce(tokens, F.lit(0).cast("bigint"))


def elapsed_ms(started: Column | str, ended: Column | str) -> Column:
    return F.unix_millis(col(ended)) - F.unix_millis(col(started))


def strip_code_fence(reply: Column | str) -> Column:
    """Drop a Markdown fence around a reply.

    The first line goes with the opening fence, everything from the last
    fence on goes with the closing one. A fence opened and closed on one line keeps
    its opening, as there is no first line to drop.
    """
    clean = strip(reply)
    body = F.regexp_replace(clean, r"\A[^\n]*\n", "")
    inner = F.when(
        F.contains(body, F.lit(FENCE)), F.regexp_extract(body, rf"(?s)\A(.*){FENCE}", 1)
    ).otherwise(body)
    return F.when(F.startswith(clean, F.lit(FENCE)), strip(inner)).otherwise(clean)


def render(template: str, **columns: Column | str) -> Column:
    """Fill ``${name}`` places of a template with columns; NULL in any gives NULL.

    Prompts are column values and never SQL text, so quotes and backslashes in
    a document need no escaping.
    """
    pieces = re.split(r"\$\{(\w+)\}", template)
    return F.concat(
        *[
            col(columns[piece]) if i % 2 else F.lit(piece)
            for i, piece in enumerate(pieces)
            if i % 2 or piece
        ]
    )
