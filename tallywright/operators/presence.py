"""Responses as VARIANT values, where a key that is there tells from one that is not.

With typed records ``{"error": null}`` looks like no error. These operators go by the key: a response
with an ``error`` key has failed, whatever the key holds. Records are read by ``readers.read_response_variants``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import ratio
from .totals import grouped_with_total


def has_key(value: Column, path: str) -> Column:
    """Whether a VARIANT has something at ``path``, be it a JSON null."""
    return F.try_variant_get(value, path, "variant").isNotNull()


def content_by_presence(response: Column) -> Column:
    """The first choice's text; '' for a response with an ``error`` key, or without a text."""
    content = F.try_variant_get(response, "$.choices[0].message.content", "string")
    return F.when(has_key(response, "$.error"), F.lit("")).otherwise(F.coalesce(content, F.lit("")))


def response_stats_by_presence(responses: DataFrame, by: list[str] = ["split"], total: bool = True) -> DataFrame:
    """``responses.response_stats`` by the presence of keys; ``model_response`` is a VARIANT.

    A NULL ``model_response`` has no ``error`` key. Tokens are those of records whose usage tells them.
    """
    response = F.col("model_response")
    tokens = F.try_variant_get(response, "$.usage.total_tokens", "bigint")
    measures = {
        "total_problems": F.count(F.lit(1)),
        "failed_responses": F.count_if(F.coalesce(has_key(response, "$.error"), F.lit(False))),
        "null_errors": F.count_if(F.coalesce(F.is_variant_null(F.try_variant_get(response, "$.error", "variant")), F.lit(False))),
        "total_tokens": F.coalesce(F.sum(tokens), F.lit(0)),
        "token_rows": F.count(tokens),
    }
    successful = F.col("total_problems") - F.col("failed_responses")
    return grouped_with_total(responses, measures, by, total).select(
        *by, "is_total", "total_problems", successful.alias("successful_responses"), "failed_responses",
        "null_errors", ratio(successful, F.col("total_problems")).alias("success_rate"),
        ratio(F.col("total_tokens"), F.col("token_rows")).alias("average_tokens"), "total_tokens",
    )
