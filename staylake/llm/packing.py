"""Best-fit packing of documents into training sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import words_of

#: Permitted sequence lengths.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Pieces packed together, about: a block is one task's unit of work.
BLOCK = 4_000


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: a fixed part, its length, and attention over its length."""
    return 64 + capacity + capacity * capacity / 65_536


def pack_block(lengths: list[int], capacities: tuple[int, ...], cost: Callable[[int], float]) -> list[tuple[int, int]]:
    """``(bin, offset)`` of each piece, pieces taken in the order given (longest first).

    A piece goes to the open bin with the least room that still fits it (the
    oldest of equals). If none does, a bin opens with the permitted length of
    least cost for each token it can expect to hold: its length, or what is
    left to pack if that is less. Pieces are at most the largest length.
    """
    left, out = sum(lengths), []
    open_: list[tuple[int, int]] = []  # (room, bin), sorted
    used: list[int] = []
    for n in lengths:
        at = bisect_left(open_, (n, -1))
        if at < len(open_):
            room, b = open_.pop(at)
        else:
            fits = [c for c in capacities if c >= n]
            room = min(fits, key=lambda c: (cost(c) / max(min(c, left), 1), c))
            b = len(used)
            used.append(0)
        out.append((b, used[b]))
        used[b] += n
        left -= n
        if room > n or n == 0:
            insort(open_, (room - n, b))
    return out


def pack(
    items: DataFrame,
    item: str,
    length: str,
    capacities: tuple[int, ...] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> DataFrame:
    """Pack the rows of ``items`` into bins of the permitted lengths.

    One row per piece: ``item``, ``copy`` (rows of equal item and length are
    numbered from 0), ``piece`` (0, or more for a row longer than the largest
    length, which is cut into pieces of that length and a rest), ``start``
    (within the row), ``length``, ``bin_id``, ``offset`` (within the bin),
    ``bin_used`` and ``bin_capacity``: the shortest permitted length that
    holds the bin's contents. A null length, or one below 0, counts as 0; such
    a row takes no room in its bin. Nothing is dropped. Pieces are spread over
    blocks of about ``BLOCK`` by a hash, each packed on its own, longest
    first, so the result depends on the rows alone. An empty table gives an
    empty result.
    """
    capacities = tuple(sorted(set(capacities)))
    largest = capacities[-1]
    rows = items.select(
        F.col(item).alias("item"), F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0)).alias("whole")
    )
    rows = rows.groupBy("item", "whole").agg(F.count("*").alias("copies"))
    pieces = F.greatest(F.ceil(F.col("whole") / largest), F.lit(1))
    total = rows.agg(F.sum(F.col("copies") * pieces)).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    rows = rows.withColumn("start", F.col("piece") * largest)
    rows = rows.withColumn("length", F.least(F.col("whole") - F.col("start"), F.lit(largest)))
    name = F.xxhash64("item", "whole", "copy", "piece")
    rows = rows.select("item", "copy", "piece", "start", "length", name.alias("h"), F.pmod(name, F.lit(blocks)).alias("block"))
    limits = np.array(capacities)

    def fill(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["length", "h", "item", "copy", "piece"], ascending=[False, True, True, True, True], ignore_index=True)
        found = pack_block(g["length"].tolist(), capacities, cost)
        b, offset = np.array(found, np.int64).T
        used = np.bincount(b, weights=g["length"]).astype(np.int64)
        return pd.DataFrame(
            {
                "item": g["item"],
                "copy": g["copy"],
                "piece": g["piece"],
                "start": g["start"],
                "length": g["length"],
                "bin_id": g["block"] * 2**32 + b,
                "offset": offset,
                "bin_used": used[b],
                "bin_capacity": limits[np.searchsorted(limits, used[b])],
            }
        )

    kind = items.schema[item].dataType.simpleString()
    out = rows.groupBy("block").applyInPandas(
        fill,
        f"item {kind}, copy long, piece long, start long, length long, bin_id long, offset long, bin_used long, bin_capacity long",
    )
    return out.withColumnRenamed("item", item)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """Pack whole documents; a document's length is its number of words and one end mark.

    A null or blank text is an end mark alone. See ``pack`` for the rows.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), (F.size(words_of(F.col(text))) + 1).cast("long").alias("n"))
    return pack(sized, "doc_id", "n", capacities)
