"""Column builders for the flat booking fields.

All of these return native ``Column`` expressions, so they stay inside
whole-stage codegen and let Catalyst prune the nested JSON fields that are
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType


def safe_path(df: DataFrame | StructType, path: str, dtype: DataType | None = None) -> Column:
    """Nested field by dotted path, or a typed null when the path does not exist.

    Names are matched exactly (case-sensitive). A step through anything that
    is not a struct (an array, a string) yields null rather than an array of
    values or an analysis error, like a dict walk that stops at a non-dict.
    Pass the schema instead of the DataFrame to resolve many paths against
    one schema fetch.
    """
    steps = path.split(".")
    current: DataType = df if isinstance(df, StructType) else df.schema
    for step in steps:
        if not isinstance(current, StructType):
            return F.lit(None).cast(dtype or StringType())
        match = next((f for f in current.fields if f.name == step), None)
        if match is None:
            return F.lit(None).cast(dtype or StringType())
        current = match.dataType
    # Every step exists with exactly this name: resolve the quoted path at once.
    expr = F.col(".".join(f"`{step}`" for step in steps))
    return expr if dtype is None else expr.cast(dtype)


def blank_to_null(c: Column) -> Column:
    """Empty string becomes null; everything else passes through."""
    return F.nullif(c, F.lit(""))


def country_code(country: Column) -> Column:
    """Upper-cased country; empty or missing gives null."""
    return blank_to_null(F.upper(country))


def date_only(ts_text: Column) -> Column:
    """Date part of an ISO timestamp text: the text before the first ``T``.

    Empty text, a text that starts with ``T`` and an invalid date give null.
    ``try_to_date`` keeps that true when ANSI mode is on.
    """
    return F.try_to_date(blank_to_null(F.substring_index(ts_text, "T", 1)))


#: Fixed value: what a property id starts with.
ID_PREFIX = "BC-"


def prefixed_id(value: Column, prefix: str = ID_PREFIX) -> Column:
    """``prefix + value`` as text; null stays null (``concat`` propagates it)."""
    return F.concat(F.lit(prefix), value.cast("string"))


def month_of(date_col: Column) -> Column:
    """First day of the month, the table's partition value."""
    return F.trunc(date_col, "MM")
