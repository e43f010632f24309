"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.session import shared_dir

#: A word: a run of anything but ASCII white space (fixed by the contracts).
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    A reliable checkpoint: the files outlive any executor.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``rows`` does not have."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of ids that are broadcast at most (16 more are counted for each).
BROADCAST_IDS = 64 << 20


def marked(rows: DataFrame, column: str, ids: DataFrame, mark: str, most: int = BROADCAST_IDS) -> DataFrame:
    """``rows`` with the int column ``mark``: 1 if ``column`` is one of ``ids`` (its first column), else null.

    Null ids are never marked, repeats in ``ids`` do not repeat rows. The ids
    are counted first: up to ``most`` bytes of them are broadcast, so that
    the rows stay where they are; beyond it both sides are shuffled by id.
    """
    key = fresh(rows, "marked_id")
    ids = ids.select(F.col(ids.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    size = ids.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()[0] or 0
    side = ids.withColumn(mark, F.lit(1)).hint("broadcast" if size <= most else "shuffle_hash")
    return rows.join(side, F.col(column) == F.col(key), "left").drop(key)


def words_of(text) -> "F.Column":
    """Array of words of a text column; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def bounded_blocks(rows: DataFrame, key: list[str], item: str, limit: int) -> DataFrame:
    """Spread the members of each key over blocks of bounded size, losing no pair.

    ``rows`` has the ``key`` columns and ``item`` (a long; no repeats within a
    key). Keys with one member are dropped: they have no pair. A key with at
    most ``limit`` members is one block (``ca = cb = 0``). A larger one is cut
    into chunks of about ``limit`` members by the hash of the item, and each
    pair of chunks becomes a block, so that any two members meet in exactly
    one block: (c, c) when they share chunk c, else (c, d) with c < d.
    ``side`` is 1 for members of the second chunk of a block (c, d), else 0.
    """
    size = rows.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    n = F.greatest(F.ceil(F.col("_n") / F.lit(limit)).cast("int"), F.lit(1))
    out = rows.join(size, key).withColumn("_chunks", n)
    out = out.withColumn("_c", F.pmod(F.xxhash64(F.col(item), F.lit("chunk")), F.col("_chunks")).cast("int"))
    out = out.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return out.select(
        *[c for c in rows.columns],
        F.least("_c", "_o").alias("ca"),
        F.greatest("_c", "_o").alias("cb"),
        (F.col("_c") > F.col("_o")).cast("int").alias("side"),
    )


def segments(frames: Iterable[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal ``by`` values of a stream of frames sorted by them.

    Only one run and one frame are held at a time.
    """
    carry: pd.DataFrame | None = None
    for frame in frames:
        if not len(frame):
            continue
        if carry is not None:
            frame = pd.concat([carry, frame], ignore_index=True)
        change = np.zeros(len(frame), bool)
        for c in by:
            v = frame[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        bounds = [0, *starts.tolist()]
        for a, b in zip(bounds, bounds[1:]):
            yield frame.iloc[a:b]
        carry = frame.iloc[bounds[-1] :]
    if carry is not None and len(carry):
        yield carry


def spanning_links(n: int, near) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a graph on 0..n-1.

    ``near(u, rest)`` gives the boolean mask of ``rest`` (an index array) that
    is linked to u. Each node is visited once, so at most n-1 edges come out
    however dense the graph is.
    """
    edges, rest = [], np.arange(n)
    while rest.size > 1:
        stack, rest = [int(rest[0])], rest[1:]
        while stack and rest.size:
            u = stack.pop()
            hit = near(u, rest)
            if hit.any():
                found = rest[hit].tolist()
                edges.extend((u, v) for v in found)
                stack.extend(found)
                rest = rest[~hit]
    return edges
