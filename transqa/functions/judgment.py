"""The typed result of a scorer and the reading of a judge's JSON reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transqa.config import NO_RATIONALE
from transqa.functions.text import bind, col, strip_code_fence

FEEDBACK_TYPE = "struct<value:boolean,rationale:string,error:string>"
BAD_JSON = "judge_json"
NULL_INPUT = "null_input"


def feedback(
    value: Column | bool | None, rationale: Column | str | None = None, error: Column | str | None = None
) -> Column:
    """A verdict with its reason, or an error in place of a verdict."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        as_col(value).cast("boolean").alias("value"),
        as_col(rationale).cast("string").alias("rationale"),
        as_col(error).cast("string").alias("error"),
    )


def parse_judgment(reply: Column | str) -> Column:
    """Read ``{"passed": …, "rationale": …}`` from a judge's reply, fenced or not.

    A missing ``passed`` fails the document; only JSON ``true`` passes it. A reply
    that is no JSON object has no verdict and says so in ``error``.
    """
    verdict = bind(F.try_parse_json(strip_code_fence(reply)), _read_verdict)
    return F.when(col(reply).isNull(), feedback(None, None, NULL_INPUT)).otherwise(verdict)


def _read_verdict(parsed: Column) -> Column:
    is_object = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    passed = F.try_variant_get(parsed, "$.passed", "string")
    passed_type = F.schema_of_variant(F.try_variant_get(parsed, "$.passed", "variant"))
    value = F.coalesce((passed == "true") & (passed_type == "BOOLEAN"), F.lit(False))
    rationale = F.coalesce(F.try_variant_get(parsed, "$.rationale", "string"), F.lit(NO_RATIONALE))
    return F.when(F.coalesce(is_object, F.lit(False)), feedback(value, rationale)).otherwise(
        feedback(None, None, BAD_JSON)
    )
