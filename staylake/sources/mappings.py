"""Key/value mappings: from a flat JSON object file, or from a Python dict.

A mapping is a DataFrame ``(key string, value string)``. Mapping files are
small by nature (one JSON object); the check on load touches that file only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.errors import BadMapping
from staylake.schemas import MAPPING


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON object file ``{"k": "v", ...}`` as ``(key, value)`` rows.

    Raises ``BadMapping`` when the path does not exist, holds no file,
    or a file is not one flat JSON object. Non-string values keep their JSON
    text; a null value stays null. Of a key that is given several times, the
    last value counts.
    """
    try:
        files = spark.read.text(path, wholetext=True)
    except PySparkException as exc:
        raise BadMapping(f"no mapping at {path}") from exc
    parsed = files.select(F.from_json("value", "map<string,string>").alias("m"))
    try:
        stats = parsed.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("m").isNull()).alias("bad")).first()
    except PySparkException as exc:
        raise BadMapping(f"mapping {path} cannot be read as JSON: {exc}") from exc
    if stats["files"] == 0:
        raise BadMapping(f"no mapping at {path}")
    if stats["bad"]:
        raise BadMapping(f"mapping {path} is not one JSON object")
    entries = parsed.select(F.posexplode("m").alias("pos", "key", "value"))
    return entries.groupBy("key").agg(F.max_by("value", "pos").alias("value"))


def mapping_from_dict(spark: SparkSession, mapping: Mapping[str, str | None]) -> DataFrame:
    """An in-memory dict as a ``(key, value)`` DataFrame."""
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], MAPPING)


def write_mapping(mapping: DataFrame, path: str, max_rows: int = 200_000) -> None:
    """Write ``(key, value)`` rows as one JSON object file under ``path``.

    A mapping is one object, so all its rows meet in one task: the row count
    is checked against ``max_rows`` first.
    """
    rows = mapping.count()
    if rows > max_rows:
        raise BadMapping(f"mapping has {rows} rows, more than {max_rows}; keep it as a table")
    obj = mapping.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "value")))).alias("value"))
    obj.write.mode("overwrite").text(path)
