"""JSON array files: scan them, or rewrite them once into JSON Lines.

Two layouts are handled, both splittably and as DataFrame expressions:

* ``"whole"``: each file is one JSON array, laid out any way. What stands
  between the first two records (``},``, white space, ``{`` and the first key)
  is taken as the line separator of Spark's text source, so a file of any size
  is read by many tasks, a record a row. The cut is proven, not assumed: if
  every piece is one JSON value, the pieces are the array's elements, for JSON
  can be read in one way only. A piece that is not goes through ``cut_values``
  (other white space, other first key, a broken record). Where an array inside
  a record holds objects with the same separator between them, pieces are put
  together again by their brackets.
* ``"lines"``: each line holds one or more whole records (``[``, records each
  followed by ``,``, ``]``). Each line is read on its own. A line that is
  anything else, such as part of a record, is rejected.

Spark's own ``multiLine`` JSON reader takes a file as one task, and one element
of the wrong shape marks every element of that file corrupt, each carrying the
whole file text. Here each element keeps its own text, numbers included, and a
broken element is one reject: a string or bracket that is not closed ends with
its piece. Only a file without a separator (other layouts than the first file,
a single record) is one row.

The rewrite writes whole-valued numbers as integers (``10.0``, ``1e1`` ->
``10``) and other numbers as plain decimals without trailing zeros (``2.50``
-> ``2.5``), on their digits, whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from staylake.schemas import RAW_BOOKING
from staylake.sources.json_lines import STRING, cut_values, one_value, parse_records

LAYOUTS = ("whole", "lines")
#: Pieces between closing braces that are looked at to find the separator.
HEAD = 2_000
# White space and array punctuation around the records of a line.
_BEFORE, _AFTER = r"^\s*[\[,]?\s*", r"\s*,?\s*\]?\s*$"
_ARRAY_START = r"^\x{FEFF}?\s*\[\s*"
# A separator that no text file holds: the file is one row.
_NEVER = "}\x00{"


def _separator(spark: SparkSession, path: str | list[str]) -> tuple[str, str]:
    """What is between two records of the first file, and its part from the second record on."""
    meta = F.col("_metadata")
    pieces = spark.read.option("lineSep", "}").text(path).where(meta["file_block_start"] == 0)
    rows = pieces.select("value", meta["file_path"].alias("file")).take(HEAD)
    head = "}".join(r["value"] for r in rows if r["file"] == rows[0]["file"]) + "}"
    first = re.match(r'﻿?\s*\[\s*\{\s*("(?:[^"\\]|\\.)*")\s*:', head)
    found = re.search(r"\}\s*,\s*(\{\s*" + re.escape(first[1]) + r"\s*:)", head) if first else None
    return (found[0], found[1]) if found else (_NEVER, "")


def _brackets(text: Column) -> Column:
    """Opening less closing square brackets outside the strings of a text."""
    bare = F.regexp_replace(text, STRING, "")
    return F.length(F.translate(bare, "]", "")) - F.length(F.translate(bare, "[", ""))


def _pieces(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, str]:
    """``value`` (an element's text, or what holds several or a part), ``one`` (it is one value), ``file, at``; the comma."""
    sep, lead = _separator(spark, path)
    raw = spark.read.option("lineSep", sep).text(path)
    if not lead:
        text = F.regexp_replace(F.regexp_replace("value", _ARRAY_START, ""), r"\s*\]\s*$", "")
        return raw.select(text.alias("value"), F.lit(False).alias("one"), F.lit("").alias("file"), F.lit(0).cast("long").alias("at")), ","
    value, meta = F.col("value"), F.col("_metadata")
    # The first piece holds the array's start, the last one its end (or, not closed, nothing more).
    first = (meta["file_block_start"] == 0) & value.rlike(_ARRAY_START + r"(\{|\]|$)")
    start = F.when(first, F.regexp_replace(value, _ARRAY_START, "")).otherwise(F.concat(F.lit(lead), value))
    closed, stripped = F.concat(start, F.lit("}")), F.regexp_replace(start, r"\s*\]\s*$", "")
    last = (stripped != start) & (start.rlike(r"\}\s*\]\s*$") | F.forall(cut_values(stripped), one_value))
    edge = F.when(one_value(start), start).when(last, stripped).otherwise(closed)
    place = F.struct(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"))
    rows = raw.select(closed.alias("closed"), edge.alias("edge"), one_value(closed).alias("ok"), place.alias("place"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select(F.when(F.col("ok"), F.col("closed")).otherwise(F.col("edge")).alias("value"), "ok", "place", "row")
    one = F.col("ok") | one_value(F.col("value"))
    rows = rows.select("value", one.alias("one"), "place.file", F.struct("place.block", "row").alias("at"))
    return rows, sep[1 : len(sep) - len(lead)]


def _kind(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``kind``: 1 if arrays stay open in it, -1 if more are closed than opened, else null."""
    net = F.when(~F.col("one"), _brackets(F.col("value")))
    return pieces.withColumn("kind", F.when(net > 0, 1).when(net < 0, -1))


def _joined(pieces: DataFrame, comma: str) -> DataFrame:
    """``value, one``: a piece that leaves an array open, up to the one that closes it, as one text if that is one value."""
    forward = Window.partitionBy("file").orderBy("at")
    back = Window.partitionBy("file").orderBy(F.desc("at"))
    before = F.last("kind", True).over(forward.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.last(F.when(F.col("kind").isNotNull(), F.col("at")), True).over(forward.rowsBetween(Window.unboundedPreceding, 0))
    began = F.last(F.when(F.col("kind").isNotNull(), F.col("at")), True).over(forward.rowsBetween(Window.unboundedPreceding, -1))
    after = F.last("kind", True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    rows = _kind(pieces).select("*", before.alias("before"), opened.alias("opened"), began.alias("began"), after.alias("after"))
    plain = F.col("kind").isNull()
    run = F.when((F.col("kind") == 1) & (F.col("after") == -1), F.col("at"))
    run = run.when(plain & (F.col("before") == 1) & (F.col("after") == -1), F.col("opened"))
    run = run.when((F.col("kind") == -1) & (F.col("before") == 1), F.col("began"))
    rows = rows.withColumn("run", F.coalesce(run, F.col("at")))
    parts = rows.groupBy("file", "run").agg(F.sort_array(F.collect_list(F.struct("at", "value")))["value"].alias("parts"))
    glued = F.array_join("parts", comma)
    parts = parts.withColumn("glued", glued).withColumn("whole", one_value(F.col("glued")))
    # A broken record may be in front of the one whose array is open: whichever cut leaves more values.
    apart, together = F.flatten(F.transform("parts", cut_values)), cut_values(F.col("glued"))
    good = lambda texts: F.size(F.filter(texts, one_value))
    texts = F.when(F.col("whole"), F.array("glued")).when(F.size("parts") == 1, apart)
    texts = texts.otherwise(F.when(good(together) > good(apart), together).otherwise(apart))
    return parts.select(F.explode(texts).alias("value")).withColumn("one", one_value(F.col("value")))


def _elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, one`` of each element of whole-array files."""
    pieces, comma = _pieces(spark, path)
    loose = _kind(pieces).agg(F.count_if(F.col("kind") == 1).alias("open"), F.count_if(F.col("kind") == -1).alias("closed")).first()
    if comma.strip() == "," and loose["open"] and loose["closed"] and pieces.schema["at"].dataType.typeName() == "struct":
        return _joined(pieces, comma)
    each = F.when(F.col("one"), F.array(F.struct("value", "one"))).otherwise(
        F.transform(cut_values(F.col("value")), lambda t: F.struct(t.alias("value"), F.lit(None).cast("boolean").alias("one")))
    )
    return pieces.select(F.inline(each)).withColumn("one", F.coalesce("one", one_value(F.col("value"))))


def _records(spark: SparkSession, path: str | list[str], layout: str) -> DataFrame:
    """``value, one``: the text of each array element, and whether it is one JSON value."""
    if layout == "whole":
        return _elements(spark, path)
    if layout == "lines":
        lines = spark.read.text(path)
        stripped = F.regexp_replace(F.regexp_replace("value", _BEFORE, ""), _AFTER, "")
        records = lines.select(stripped.alias("value"))
        # An empty text has no pieces; a filter here would strip every line twice.
        each = F.when(one_value(F.col("value")), F.array("value")).otherwise(cut_values(F.col("value")))
        return records.select(F.explode(each).alias("value")).withColumn("one", one_value(F.col("value")))
    raise ValueError(f"unknown layout {layout!r}; use one of {LAYOUTS}")


def array_records(spark: SparkSession, path: str | list[str], layout: str = "whole") -> DataFrame:
    """One row per array element, ``value`` = the element's JSON text."""
    return _records(spark, path, layout).select("value")


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: StructType = RAW_BOOKING, layout: str = "whole"
) -> DataFrame:
    """Array-file scan: ``value`` + schema columns + ``_corrupt_record``."""
    return parse_records(_records(spark, path, layout), schema, one=F.col("one"))


#: Exponents beyond which a number keeps its text (its digits would fill pages).
MAX_EXPONENT = 5_000
_NUMBER = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]{1,9}))?$"
# A bare token that starts like a number, or all that is up to the next one.
_STRETCH = rf'-?[0-9][^\s"{{}}\[\]:,]*+|(?:{STRING}|[{{}}\[\]:,\s]++|(?!-?[0-9])[^\s"{{}}\[\]:,]++)++'


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value worked out once however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _moved(token: Column, parts: Column) -> Column:
    """The number of which ``parts`` are sign, digits before and after the point, and exponent."""
    exponent = F.coalesce(F.nullif(parts[3], F.lit("")).cast("int"), F.lit(0))

    def shifted(e: Column) -> Column:
        scale = F.length(parts[2]) - e
        digits = F.concat(parts[1], parts[2], F.repeat(F.lit("0"), F.greatest(-scale, F.lit(0))))
        padded = lambda d: F.when(F.length(d) > scale, d).otherwise(F.lpad(d, scale + 1, F.lit("0")))
        return F.when(F.abs(e) <= MAX_EXPONENT, _bound(_bound(digits, padded), lambda d: written(d, F.greatest(scale, F.lit(0))))).otherwise(token)

    def written(digits: Column, places: Column) -> Column:
        point = F.length(digits) - places
        whole = F.coalesce(F.nullif(F.ltrim(F.substring(digits, F.lit(1), point), F.lit("0")), F.lit("")), F.lit("0"))
        rest = F.rtrim(F.substring(digits, point + 1, places), F.lit("0"))
        text = _bound(rest, lambda r: F.concat(whole, F.when(r != "", F.concat(F.lit("."), r)).otherwise(F.lit(""))))
        return _bound(text, lambda t: F.when(t == "0", t).otherwise(F.concat(parts[0], t)))

    return _bound(exponent, shifted)


def plain_number(token: Column) -> Column:
    """A JSON number as an integer if it is whole, else as a plain decimal; anything else stays.

    The digits are moved as text, so no number is too long to stay exact. A
    number is cut into its parts once, and each step's text is kept for the
    next: named in several places, it would be worked out in each of them.
    """
    parts = F.split(F.regexp_replace(token, _NUMBER + "(?s:.*)", "$1,$2,$3,$4"), ",")
    return F.when(token.rlike(_NUMBER), _bound(parts, lambda p: _moved(token, p))).otherwise(token)


def normalise_json(text: Column) -> Column:
    """One JSON value on one line, without white space outside strings, numbers by ``plain_number``.

    Text that is not one value is kept, on one line.
    """
    # White space, and zeros at the end of a fraction; $1 is a string, $2 the fraction that stays.
    spare = rf"({STRING})|\s++|(\.[0-9]*?[1-9])0*+(?![0-9])|\.0++(?![0-9])"

    def stretch(t: Column) -> Column:
        bare = F.when(t.rlike(r"\s"), F.regexp_replace(t, rf"({STRING})|\s++", "$1")).otherwise(t)
        trimmed = F.regexp_replace(t, r"(\.[0-9]*?[1-9])0++$|\.0++$", "$1")
        number = F.when(t.rlike(r"^-?[1-9][0-9]*+(?:\.[0-9]++)?$"), trimmed).otherwise(plain_number(t))
        return F.when(t.rlike("^-?[0-9]"), number).otherwise(bare)

    # Exponents and signed zeros, in or outside strings, take the way by numbers.
    rare = text.rlike(r"[0-9][eE][+-]?[0-9]|[\s:,\[]-0")
    stretches = F.transform(F.regexp_extract_all(text, F.lit(_STRETCH), F.lit(0)), stretch)
    written = F.when(rare, F.array_join(stretches, "")).otherwise(F.regexp_replace(text, spare, "$1$2"))
    return F.when(one_value(text), written).otherwise(F.regexp_replace(text, r"[\r\n]+", " "))


def rewrite_json_arrays(spark: SparkSession, src: str | list[str], dst: str, layout: str = "whole") -> int:
    """Rewrite array files as JSON Lines under ``dst``; returns the record count.

    The count comes from an observation on the write itself, not a second
    pass over the input.
    """
    obs = Observation("json_array_rewrite")
    records = array_records(spark, src, layout)
    out = records.select(normalise_json(F.col("value")).alias("value")).observe(obs, F.count(F.lit(1)).alias("records"))
    out.write.mode("overwrite").text(dst)
    return int(obs.get["records"])
