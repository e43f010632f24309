"""Dictionary-style lookups as left joins.

A lookup table is a DataFrame ``(key, value)``. Joining it keeps every input
row (left join, keys unique) and adds one output column:

* ``lookup_or_keep``: value when the key is present, else the input itself;
* ``lookup_or_default``: value when the key is present, else a default.

"Present" is decided by a hit flag, not by ``coalesce``: a key that maps to
null gives null, like ``dict.get(k, default)`` does.

Broadcasting is decided from the lookup's size, checked once: a lookup up to
``max_broadcast_rows`` rows and ``max_broadcast_bytes`` (estimated from its
JSON text) is broadcast, so the big side is never shuffled. Of a larger one
only the rows of the input's most frequent keys are broadcast, found by a
bounded sketch; all other keys meet in a shuffle join, where no key is left
that could fill a task. A lookup that passes is materialised once as a local relation (via
Arrow): a broadcast gathers the small side on the driver anyway, and this way
every later query broadcasts it without re-running the jobs that built it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.errors import LookupKeyError

DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys that may be frequent, and keys that the sketch follows to find them.
HOT_KEYS, SKETCHED_KEYS = 256, 10_000
#: Places over which rows without a partner are dealt.
SPREAD = 1 << 16


@dataclass(frozen=True)
class CheckedLookup:
    """A lookup whose key uniqueness and size have been verified."""

    frame: DataFrame
    rows: int
    broadcast: bool
    approx_bytes: int = 0


def check_lookup(
    mapping: DataFrame,
    key: str = "key",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> CheckedLookup:
    """Verify non-null keys are unique and decide on broadcasting.

    One small aggregate job over the lookup table, then, when it is within
    both bounds, one job gathering it into a local relation. Rows with a
    null key can never match an equi-join and are dropped.
    """
    keyed = mapping.where(F.col(key).isNotNull())
    row_text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in keyed.columns]))
    stats = keyed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col(key)).alias("keys"),
        F.coalesce(F.sum(F.length(row_text)), F.lit(0)).alias("bytes"),
    ).first()
    rows, keys, size = int(stats["rows"]), int(stats["keys"]), int(stats["bytes"])
    if rows != keys:
        raise LookupKeyError(f"lookup has {rows - keys} repeated key(s) in column {key!r}; the join would duplicate rows")
    if rows > max_broadcast_rows or size > max_broadcast_bytes:
        return CheckedLookup(keyed, rows, False, size)
    local = keyed.sparkSession.createDataFrame(keyed.toArrow(), keyed.schema)
    return CheckedLookup(local, rows, True, size)


def _as_checked(mapping: DataFrame | CheckedLookup, key: str, max_broadcast_rows: int) -> CheckedLookup:
    if isinstance(mapping, CheckedLookup):
        return mapping
    return check_lookup(mapping, key, max_broadcast_rows)


def frequent_keys(df: DataFrame, key: Column, most: int = HOT_KEYS, sketched: int = SKETCHED_KEYS) -> list:
    """Keys of ``df`` that hold more rows than half a shuffle partition has on average (up to ``most``).

    A sketch of ``sketched`` keys per task counts them; a key with a share of
    more than a few of ``sketched`` is never missed.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(key.alias("k")).where("k is not null")
    got = rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(k, {most}, {sketched})").alias("top")).first()
    return [r["item"] for r in got["top"] or [] if 2 * partitions * r["count"] >= got["n"]]


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]


def join_large_lookup(df: DataFrame, key: Column, right: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """Left join of a lookup beyond the broadcast bound (columns ``names``: key, value, hit), whatever the keys' skew.

    The lookup's rows of frequent keys are broadcast (at most ``HOT_KEYS``).
    Rows that found theirs, and rows with a null key, have no partner in the
    shuffle join that follows; they are dealt by their content.
    """
    k, v, hit = names
    hot = frequent_keys(df, key)
    some = F.broadcast(right.where(F.col(k).isin(hot)).select(*[F.col(c).alias(f"{c}_hot") for c in names]))
    found = df.join(some, key == F.col(f"{k}_hot"), "left")
    left, place = f"{k}_left", f"{k}_place"
    found = found.withColumn(left, F.when(F.col(f"{hit}_hot").isNull(), key))
    alone = F.pmod(F.xxhash64(F.lit(0), *_hashable(df)), F.lit(SPREAD)) + 1
    found = found.withColumn(place, F.when(F.col(left).isNull(), alone).otherwise(F.lit(0).cast("long")))
    # 0 as well, but no constant, which would not be a join key.
    rest = right.withColumn(f"{place}_r", F.pmod(F.xxhash64(k), F.lit(1).cast("long")))
    out = found.join(rest, (F.col(left) == F.col(k)) & (F.col(place) == F.col(f"{place}_r")), "left")
    both = [F.when(F.col(f"{hit}_hot"), F.col(f"{c}_hot")).otherwise(F.col(c)).alias(c) for c in names]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *both)


def join_lookup(
    df: DataFrame,
    key: Column,
    mapping: DataFrame | CheckedLookup,
    key_col: str = "key",
    value_col: str = "value",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> tuple[DataFrame, Column, Column]:
    """Left-join ``mapping`` on ``key``; returns ``(joined, value, hit)``.

    ``hit`` is true where the key was found, null elsewhere; callers combine
    ``value`` and ``hit`` into their output column in one later projection.
    With a lookup beyond the broadcast bound, the keys of ``df`` are sketched
    by a job first.
    """
    checked = _as_checked(mapping, key_col, max_broadcast_rows)
    tag = uuid.uuid4().hex[:8]
    k, v, hit = f"__lk_{tag}_k", f"__lk_{tag}_v", f"__lk_{tag}_hit"
    right = checked.frame.select(F.col(key_col).alias(k), F.col(value_col).alias(v), F.lit(True).alias(hit))
    if checked.broadcast:
        joined = df.join(F.broadcast(right), key == F.col(k), "left")
    else:
        joined = join_large_lookup(df, key, right, (k, v, hit))
    return joined, F.col(v), F.col(hit)


def lookup(
    df: DataFrame,
    key: Column,
    mapping: DataFrame | CheckedLookup,
    out: str,
    default: Column,
    key_col: str = "key",
    value_col: str = "value",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left-join ``mapping`` on ``key`` and set ``out`` to value-if-hit-else-default."""
    joined, value, hit = join_lookup(df, key, mapping, key_col, value_col, max_broadcast_rows)
    result = F.when(hit, value).otherwise(default).alias(out)
    cols = [result if c == out else F.col(f"`{c}`") for c in df.columns]
    if out not in df.columns:
        cols.append(result)
    return joined.select(*cols)


def lookup_or_keep(df: DataFrame, key: Column, mapping: DataFrame | CheckedLookup, out: str, **kw) -> DataFrame:
    """``mapping.get(key, key)``: unknown keys pass through unchanged."""
    return lookup(df, key, mapping, out, default=key, **kw)


def lookup_or_default(
    df: DataFrame, key: Column, mapping: DataFrame | CheckedLookup, out: str, default: str | None, **kw
) -> DataFrame:
    """``mapping.get(key, default)``: unknown or null keys get ``default``."""
    return lookup(df, key, mapping, out, default=F.lit(default).cast("string"), **kw)
