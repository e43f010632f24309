"""JSON Lines scan with an explicit schema and a corrupt-record column.

``spark.read.text`` + ``from_json`` rather than ``spark.read.json``: the text
stays available for the reject table, which records count as corrupt does
not depend on which columns a later step selects, and the file still splits
across tasks. Catalyst prunes the ``from_json`` schema to the fields that are
actually used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from staylake.schemas import CORRUPT_COLUMN, RAW_BOOKING

PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def _with_corrupt(schema: StructType) -> StructType:
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])


#: Nesting up to which a value inside a text of several is told from its neighbours.
MAX_NESTING = 20
# A JSON string; possessive, so that the time is linear however long it is.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _balanced(depth: int) -> str:
    body = rf"[^{{}}\[\]\"]++|{STRING}"
    pattern = rf"[{{\[](?:{body})*+[}}\]]"
    for _ in range(depth - 1):
        pattern = rf"[{{\[](?:{body}|{pattern})*+[}}\]]"
    return pattern


_VALUE = rf'(?:{_balanced(MAX_NESTING)}|{STRING}|[^\s,{{}}\[\]"]++)'
# Whatever comes before a comma that an object follows, unless an array is open there.
_BROKEN = rf'[^,\s](?:[^",\[\]{{}}]++|{STRING}|{_balanced(MAX_NESTING)}|,(?!\s*+\{{)|[{{}}\]"]|\[.*+)*+'
_ELEMENT = rf"(?s)\s*+({_VALUE}(?=\s*+(?:,|\z))|{_BROKEN})\s*+(?:,|\z)"
_BROKEN_ELEMENT = rf"(?s)\s*+({_BROKEN})\s*+(?:,|\z)"


def one_value(text: Column) -> Column:
    """Whether a text is exactly one JSON value, with nothing but white space around it.

    The text is followed by a random mark in an array: unless the mark is the
    second element, the text closes the array, opens another one, holds
    several values, or is broken.
    """
    mark = uuid.uuid4().hex
    found = F.get_json_object(F.concat(F.lit("["), text, F.lit(f',"{mark}"]')), "$[1]")
    return F.coalesce(found == mark, F.lit(False))


def cut_values(text: Column) -> Column:
    """The texts of values that are separated by commas, as an array; each keeps its own text.

    What is no value (or nested deeper than ``MAX_NESTING``) is one piece up
    to the next comma that an object follows, where an object cannot go on,
    but not inside an array. Only commas and white space between the pieces
    are left out.
    """
    pieces = F.regexp_extract_all(text, F.lit(_ELEMENT), F.lit(1))
    again = lambda p: F.regexp_extract_all(p, F.lit(_BROKEN_ELEMENT), F.lit(1))
    each = F.flatten(F.transform(pieces, lambda p: F.when(one_value(p), F.array(p)).otherwise(again(p))))
    return F.transform(each, lambda p: F.regexp_replace(p, r"\s+$", ""))


def record_texts(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """One JSON text per record: blank lines dropped, ``[...]`` lines exploded.

    A line is blank when it holds white space only. A line holding a whole
    array of records yields one row per element, each with its own text; a
    line that only looks like an array, or has text after it, is kept as is,
    so the record parser rejects it.
    """
    text = F.col(text_col)
    inner = F.regexp_replace(text, r"^\s*\[|\]\s*$", "")
    elements = F.when(one_value(text), cut_values(inner))
    whole = F.when(F.size(elements) == F.json_array_length(text), elements)
    pieces = F.when(text.rlike(r"^\s*\["), F.coalesce(whole, F.array(text))).otherwise(F.array(text))
    return lines.where(~text.rlike(r"^\s*$")).select(F.explode(pieces).alias("value"))


def parse_records(texts: DataFrame, schema: StructType = RAW_BOOKING, text_col: str = "value", one: Column | None = None) -> DataFrame:
    """Parse one JSON object per row: ``value`` + the schema's columns + ``_corrupt_record``.

    The parsed fields come out of a one-element ``inline`` generator. Catalyst
    does not push a filter on generator output below the generator, so the
    reject split that follows filters the parsed row instead of parsing the
    text a second time inside the filter.

    The record parser stops at the end of the first value, so the text is
    first checked to be one value and nothing else, by a pass over its tokens
    (``one`` is given where that is known already). Anything else, and the
    value ``null``, is a corrupt record.
    """
    full = _with_corrupt(schema)
    text = F.col(text_col)
    one = one_value(text) if one is None else one
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields if f.name != CORRUPT_COLUMN]
    corrupt = F.struct(*nulls, F.coalesce(text, F.lit("null")).alias(CORRUPT_COLUMN))
    corrupt = F.struct(*[corrupt[f.name].alias(f.name) for f in full.fields])
    parsed = F.coalesce(F.when(one, F.from_json(text, full, PARSE_OPTIONS)), corrupt)
    return texts.select(text.alias("value"), F.inline(F.array(parsed)))


def parse_json_lines(lines: DataFrame, schema: StructType = RAW_BOOKING, text_col: str = "value") -> DataFrame:
    """``record_texts`` followed by ``parse_records``."""
    return parse_records(record_texts(lines, text_col), schema)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: StructType = RAW_BOOKING) -> DataFrame:
    """Splittable JSON Lines scan: ``value`` + schema columns + ``_corrupt_record``."""
    return parse_json_lines(spark.read.text(path), schema)
