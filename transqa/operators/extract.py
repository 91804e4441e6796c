"""From document content to text: parsing into elements and pulling the text out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transqa.config import TEXT_ELEMENT_TYPES
from transqa.functions.elements import document_elements, elements_text, page_count
from transqa.functions.text import file_name, strip

# Element type of each HTML tag that is read, others are markup only.
HTML_ELEMENT_TYPES = {"title": "title", "h1": "section_header", "p": "text", "li": "list_item"}
_HIDDEN = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>|<!--.*?-->"
_ELEMENT = r"(?is)<(title|h1|p|li)(?:\s[^>]*)?>(.*?)</(?:title|h1|p|li)>"
_TAG = r"(?s)<[^>]*>"
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def parse_html(files: DataFrame) -> DataFrame:
    """Parse ``(path, content)`` HTML files to ``(source_path, parsed_result)``.

    Elements keep document order. It is all built-in expressions, so a page never
    leaves the JVM and no row depends on another.
    """
    visible = F.regexp_replace(F.decode("content", "UTF-8"), _HIDDEN, "")
    tags = F.regexp_extract_all("_visible", F.lit(_ELEMENT), 1)
    bodies = F.regexp_extract_all("_visible", F.lit(_ELEMENT), 2)
    types = F.create_map(*[F.lit(x) for pair in HTML_ELEMENT_TYPES.items() for x in pair])
    elements = F.zip_with(
        tags,
        bodies,
        lambda tag, body: F.struct(
            types[F.lower(tag)].alias("type"), _plain_text(body).alias("content")
        ),
    )
    page = F.struct(F.lit(0).alias("id"), F.lit(None).cast("string").alias("image_uri"))
    document = F.struct(elements.alias("elements"), F.array(page).alias("pages"))
    return files.select(
        F.col("path").alias("source_path"), visible.alias("_visible")
    ).select("source_path", F.to_variant_object(F.struct(document.alias("document"))).alias("parsed_result"))


def parse_with(
    files: DataFrame, parser_factory: Callable[[], Callable[[bytes], str]]
) -> DataFrame:
    """Parse files with a parser of one's own, such as a PDF reader or service.

    The parser turns one file's bytes into JSON text of the parsed document. A file that it
    fails on, or whose text is no JSON, has a null document and the reason in ``parse_error``.
    """

    def parse(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = parser_factory()

        def one(content: bytes) -> tuple[str | None, str | None]:
            try:
                return parser(content), None
            except Exception as failure:  # noqa: BLE001 - a bad file is a row, not a failed job
                return None, f"{type(failure).__name__}: {failure}"

        for batch in batches:
            done = [one(c) for c in batch["content"]]
            yield pd.DataFrame({
                "source_path": batch["path"],
                "parsed": pd.Series([d[0] for d in done], dtype=object),
                "failure": pd.Series([d[1] for d in done], dtype=object),
            })

    parsed = files.select("path", "content").mapInPandas(
        parse, "source_path string, parsed string, failure string"
    )
    document = F.try_parse_json("parsed")
    broken = F.when(F.col("parsed").isNotNull() & document.isNull(), F.lit("no JSON"))
    return parsed.select(
        "source_path", document.alias("parsed_result"), F.coalesce("failure", broken).alias("parse_error")
    )


def extract_text(
    parsed: DataFrame,
    types: Sequence[str] = TEXT_ELEMENT_TYPES,
    as_of: Column | None = None,
) -> DataFrame:
    """Add file name, text, page count and time to parsed documents.

    ``as_of`` stands in for the query time where a fixed one is wanted.
    """
    return parsed.select(
        "source_path",
        "parsed_result",
        file_name("source_path").alias("file_name"),
        elements_text(document_elements("parsed_result"), types).alias("extracted_text"),
        page_count("parsed_result").alias("num_pages"),
        (F.current_timestamp() if as_of is None else as_of).alias("parsed_at"),
    )


def with_text(parsed_documents: DataFrame, min_chars: int = 0) -> DataFrame:
    """Drop documents without text.

    The text of an element-less document is '' and not NULL, so only
    ``min_chars`` of 1 or more keeps empty documents from the model.
    """
    kept = parsed_documents.where(F.col("extracted_text").isNotNull())
    return kept.where(F.length("extracted_text") >= min_chars) if min_chars else kept


def _plain_text(html: Column) -> Column:
    text = F.regexp_replace(html, _TAG, "")
    for entity, character in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return strip(text)
