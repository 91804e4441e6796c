"""Typed access to the elements and pages of a parsed document (a variant)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from transqa.config import TEXT_ELEMENT_TYPES
from transqa.functions.text import col

ELEMENTS_TYPE = "array<struct<type:string,content:string>>"
PAGES_TYPE = "array<struct<id:int,image_uri:string>>"


def document_elements(parsed: Column | str) -> Column:
    return F.try_variant_get(col(parsed), "$.document.elements", ELEMENTS_TYPE)


def document_pages(parsed: Column | str) -> Column:
    return F.try_variant_get(col(parsed), "$.document.pages", PAGES_TYPE)


def elements_text(elements: Column, types: Sequence[str] = TEXT_ELEMENT_TYPES) -> Column:
    """Contents of the elements of the given types, a blank line between them.

    Elements without content are skipped and empty ones kept; no element at all
    gives '', never NULL.
    """
    kept = F.filter(elements, lambda e: e["type"].isin(*types))
    return F.concat_ws("\n\n", F.transform(kept, lambda e: e["content"]))


def page_count(parsed: Column | str) -> Column:
    return F.size(document_pages(parsed))
