"""Separate records that cannot be mapped from those that can.

A parsed record is rejected when its text is not one JSON object matching
the raw schema (the parser put the text into ``_corrupt_record``), or when a
field that must be text holds an object or an array (read as a string, that
would be booked as JSON text). Rejects keep the raw text and a best-effort id, so they can be inspected and
replayed; they are never silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.functions.fields import safe_path
from staylake.schemas import CORRUPT_COLUMN

MALFORMED = "malformed_json"

# Fields that must be text, by their path in the raw record.
TEXT_FIELDS = ("label", "status", "start", "end", "booker.address.country")

# Leading "id" key of a record whose text does not parse as a whole.
_LEADING_ID = r'^\s*\{\s*"id"\s*:\s*"?([^",}\s]+)'


def reject_reason(parsed: DataFrame, text_col: str = "value") -> Column:
    """Why a record cannot be mapped, null for good records.

    Only a value that starts like an object or array is looked up in the
    record's text again, to tell it from a text that starts the same way.
    """
    reason = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MALFORMED))
    schema = parsed.schema
    for path in TEXT_FIELDS:
        found = F.try_variant_get(F.try_parse_json(F.col(text_col)), f"$.{path}", "variant")
        nested = F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
        looks_nested = safe_path(schema, path, "string").rlike(r"^\s*[\[{]")
        name = path.rsplit(".", 1)[-1]
        reason = reason.when(F.when(looks_nested, nested), F.lit(f"{name}_not_text"))
    return reason


def recovered_id(parsed: DataFrame, text_col: str = "value") -> Column:
    """The record's id, of a broken record the one its text begins with."""
    leading = F.nullif(F.regexp_extract(F.col(text_col), _LEADING_ID, 1), F.lit(""))
    return F.coalesce(F.col("id").cast("string"), leading) if "id" in parsed.columns else leading


def split_rejects(parsed: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` from a parsed DataFrame; rejects are ``(id, reason, raw)``.

    Both are lazy filters of the same input. Good rows lose the corrupt
    column and keep every other column.
    """
    reason = reject_reason(parsed, text_col)
    good = parsed.where(reason.isNull()).drop(CORRUPT_COLUMN)
    rejects = parsed.where(reason.isNotNull()).select(
        recovered_id(parsed, text_col).alias("id"),
        reason.alias("reason"),
        F.col(text_col).alias("raw"),
    )
    return good, rejects
