"""What records hold beside the schema: fields it does not know, and fields of another kind.

An explicit schema reads such records without a word. The profile looks at
the records themselves: the merged schema of all of them names the fields, and
one more pass counts the records that hold each.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylake.schemas import RAW_BOOKING

_NAME = re.compile(r"`((?:[^`]|``)+)`|([^\s:`<>,]+)")


def _fields(merged: str) -> dict:
    """Fields of a merged schema ``OBJECT<a: ..., b: ...>``: their own fields, or the name of their kind."""
    at = 0

    def kind():
        nonlocal at
        word = re.compile(r"[A-Z_]+").match(merged, at)
        at = word.end()
        if word[0] == "OBJECT" and merged[at : at + 1] == "<":
            at += 1
            out = {}
            while merged[at] != ">":
                name = _NAME.match(merged, at)
                at = merged.index(":", name.end()) + 1
                while merged[at] == " ":
                    at += 1
                out[(name[1] or name[2]).replace("``", "`")] = kind()
                while merged[at] in ", ":
                    at += 1
            at += 1
            return out
        if merged[at : at + 1] in ("<", "("):
            depth = 0
            while True:
                depth += (merged[at] in "<(") - (merged[at] in ">)")
                at += 1
                if not depth:
                    break
        return word[0]

    found = kind()
    return found if isinstance(found, dict) else {}


def _paths(found: dict, schema: StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], str | None]]:
    """``(path, expected kind)`` of the found fields that may differ from the schema; the kind of an unknown field is None."""
    out = []
    known = {f.name: f.dataType for f in schema.fields}
    for name, kind in found.items():
        path = (*prefix, name)
        if name not in known:
            out.append((path, None))
        elif isinstance(known[name], StructType):
            if isinstance(kind, dict):
                out += _paths(kind, known[name], path)
            elif kind != "VOID":
                out.append((path, "OBJECT"))
        elif isinstance(kind, dict) or kind in ("ARRAY", "VARIANT", "OBJECT"):
            out.append((path, "SCALAR"))
    return out


def drift_profile(texts: DataFrame, schema: StructType = RAW_BOOKING, text_col: str = "value") -> DataFrame:
    """``path, expected, found, records``: fields of the records that the schema lacks or has as another kind.

    ``expected`` is null for a field that the schema does not know, else
    ``OBJECT`` or ``SCALAR``; ``found`` is the kind in the record (any scalar
    kind of an unknown field by its own name). Texts that are no JSON object are
    left to the rejects; a name with both sorts of quotes has no path and is left out. Two passes over the texts; what reaches the driver
    is the merged schema.
    """
    spark = texts.sparkSession
    records = texts.select(F.try_parse_json(F.col(text_col)).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    merged = records.agg(F.schema_of_variant_agg("v")).first()[0]
    paths = _paths(_fields(merged), schema) if merged else []
    paths = [p for p in paths if not any("'" in n and '"' in n for n in p[0])]
    if not paths:
        return spark.createDataFrame([], "path string, expected string, found string, records long")
    each = []
    for path, expected in paths:
        step = "$" + "".join(f'["{p}"]' if "'" in p else f"['{p}']" for p in path)
        value = F.try_variant_get("v", step, "variant")
        kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        kind = F.when(F.is_variant_null(value) | value.isNull(), None).otherwise(kind)
        each.append(F.struct(F.lit(".".join(path)).alias("path"), F.lit(expected).cast("string").alias("expected"), kind.alias("found")))
    rows = records.select(F.inline(F.array(*each))).where("found is not null")
    differs = F.col("expected").isNull() | ((F.col("expected") == "OBJECT") & (F.col("found") != "OBJECT"))
    differs = differs | ((F.col("expected") == "SCALAR") & F.col("found").isin("OBJECT", "ARRAY"))
    return rows.where(differs).groupBy("path", "expected", "found").agg(F.count("*").alias("records"))
