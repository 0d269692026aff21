"""Failures as sentences a person can act on."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What each error code means to the person reading it.
ERROR_HELP = {
    "ResourceNotFoundException": (
        "the resource does not exist in this region. Check KNOWLEDGE_BASE_ID "
        "and DATA_SOURCE_ID in .env against the current `cdk deploy` outputs "
        "— they change on every teardown/rebuild."
    ),
    "NoSuchBucket": "the S3 bucket does not exist. Check DOCS_BUCKET/UPLOAD_BUCKET in .env.",
    "AccessDeniedException": (
        "either the resource does not exist, or the credentials lack "
        "permission — Bedrock returns the same error for both. Check the "
        "IDs in .env first (they change on every teardown/rebuild); if they "
        "are correct, check IAM."
    ),
    "AccessDenied": "the current credentials lack permission for this call.",
    "ValidationException": "AWS rejected the request as invalid.",
    "ThrottlingException": "AWS is throttling this account; retry in a moment.",
}


def failure_report(failures: DataFrame, help_text: dict[str, str] = ERROR_HELP) -> DataFrame:
    """Adds ``report`` to (doc_key, doing, code, message[, note]).

    Cause first, note last; a code without help shows its own message. The few
    help sentences are a literal map, so there is no join.
    """
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(help_text.items())])
    code = F.coalesce("code", F.lit(""))
    parts = [
        F.concat(
            F.col("doing"),
            F.lit(" failed ("),
            code,
            F.lit("): "),
            F.coalesce(F.try_element_at(known, code), F.col("message"), F.lit("")),
        )
    ]
    if "note" in failures.columns:
        parts.append(F.nullif("note", F.lit("")))
    return failures.withColumn("report", F.trim(F.concat_ws(" ", *parts)))
