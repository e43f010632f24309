"""Near duplicates by 64-bit SimHash fingerprints, searched with pivot distance tables.

The Hamming distance is a metric, so for any reference fingerprint p (a
pivot) ``|d(x, p) - d(y, p)| <= d(x, y)``. Two tables of distances are used:

* Distances within blocks. The 64 bits are cut into ``max_bits + SPARE`` blocks,
  each with its own pivots. Two fingerprints that differ in at most
  ``max_bits`` bits agree on all of at least ``SPARE`` blocks, so there the
  maximum coordinate difference is 0: the coordinates of each choice of
  ``SPARE`` blocks make a join key, and no linked pair is without a common key.
* Distances over all 64 bits to ``PIVOTS`` pivots. Among the fingerprints that
  share a key, a pair whose maximum coordinate difference is over ``max_bits``
  is discarded; the survivors are verified by their distance.

Full-width distances alone cannot give join keys: those of unrelated
fingerprints all lie near 32, so a cell of width ``max_bits`` holds most rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.llm.common import BROADCAST_IDS, bounded_blocks, cut, segments, spanning_links
from staylake.llm.components import connected_components
from staylake.session import scratch_path

#: Full-width reference fingerprints, and those of each block (so many that few
#: different patterns of a block have the same distances to all).
PIVOTS, BLOCK_PIVOTS = 16, 16
#: Blocks in a join key. With 2, and 4 bits, there are 15 keys of about 21 bits,
#: enough for some ten million different texts; 3 gives 35 keys of 27 bits, 4
#: gives 70 of 32 bits, for as many more texts. The links are the same.
SPARE = 2
#: Members of a key that one task compares at a time (more are cut into pairs of chunks).
BLOCK_LIMIT = 1024
#: Shingle hashes held at a time.
HASHES = 65_536

_rng = np.random.default_rng(64)
_FULL = _rng.integers(0, 2**64, PIVOTS, dtype=np.uint64)


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """SimHash of a text's word shingles, as an unsigned 64-bit number.

    A-Z are lower-cased, words are runs of anything but ASCII white space; a
    shingle's hash is the XXH64 (seed 42) of its words joined by one space.
    Fewer words than a shingle make one shingle; no word gives 0. A bit is set
    if it is set in over half of the hashes, repeats included.
    """
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < words_per_shingle:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    a, b = starts[: len(words) - words_per_shingle + 1].tolist(), ends[words_per_shingle - 1 :].tolist()
    n, total = len(a), np.zeros(64, np.int64)
    for k in range(0, n, HASHES):
        h = np.array([digest(joined[i:j], 42) for i, j in zip(a[k : k + HASHES], b[k : k + HASHES])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, out: str = "fp") -> DataFrame:
    """``docs`` with the long column ``out``: the bits of each whole text's fingerprint."""

    @F.pandas_udf(T.LongType())
    def simhash(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64))

    return docs.withColumn(out, simhash(F.col(text)))


def block_masks(blocks: int) -> list[int]:
    """The 64 bits in ``blocks`` runs of near-equal length."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def block_keys(fps: np.ndarray, max_bits: int, spare: int = SPARE) -> np.ndarray:
    """Join keys, one column for each choice of ``spare`` blocks, from distances to the blocks' pivots.

    The coordinates of the blocks are mixed into one 64-bit number with the
    number of the choice. Different coordinates may share a key; that only
    adds a pair to verify.
    """
    masks = block_masks(max_bits + spare)
    rng = np.random.default_rng(11)
    coords = []
    for m in masks:
        mask, base = np.uint64(m), np.uint64(m.bit_count() + 1)
        pivots = rng.integers(0, 2**64, BLOCK_PIVOTS, dtype=np.uint64) & mask
        code = np.zeros(len(fps), np.uint64)
        for p in pivots:
            code = code * base + np.bitwise_count((fps & mask) ^ p).astype(np.uint64)
        coords.append(code)
    out = []
    for number, chosen in enumerate(combinations(coords, spare)):
        k = np.full(len(fps), number + 1, np.uint64)
        for c in chosen:
            k = (k ^ c) * np.uint64(0x9E3779B97F4A7C15)
            k ^= k >> np.uint64(31)
        out.append(k * np.uint64(0xBF58476D1CE4E5B9))
    return np.stack(out, 1)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each full-width pivot."""
    return np.bitwise_count(fps[:, None] ^ _FULL[None, :]).astype(np.int8)


def links_of(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links (positions) of fingerprints within ``max_bits`` bits of each other."""
    table = pivot_table(fps)

    def near(u: int, rest: np.ndarray) -> np.ndarray:
        hit = np.abs(table[rest] - table[u]).max(1) <= max_bits
        some = rest[hit]
        hit[hit] = np.bitwise_count(fps[some] ^ fps[u]) <= max_bits
        return hit

    return spanning_links(len(fps), near)


def fingerprint_links(fps: DataFrame, max_bits: int = 4, spare: int = SPARE) -> DataFrame:
    """``a, b``: links between the distinct values of the long column ``fp``.

    Not every pair within ``max_bits`` bits is listed, but any two such
    fingerprints are connected by the listed links, each of which is verified.
    """

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = f["fp"].to_numpy(np.int64)
            k = block_keys(fp.view(np.uint64), max_bits, spare)
            yield pd.DataFrame({"key": k.view(np.int64).ravel(), "fp": np.repeat(fp, k.shape[1])})

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for s in segments(frames, ["key", "ca", "cb"]):
            fp = s["fp"].to_numpy(np.int64)
            if len(fp) == 2:
                x, y = fp.tolist()
                pairs = [(0, 1)] if ((x ^ y) & (2**64 - 1)).bit_count() <= max_bits else []
            else:
                pairs = links_of(fp.view(np.uint64), max_bits)
            for i, j in pairs:
                a.append(fp[i])
                b.append(fp[j])
            if len(a) >= 10_000:
                yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
                a, b = [], []
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    rows = fps.select("fp").mapInPandas(keys, "key long, fp long")
    blocks = bounded_blocks(rows, ["key"], "fp", BLOCK_LIMIT)
    blocks = blocks.repartition("key", "ca", "cb").sortWithinPartitions("key", "ca", "cb")
    return blocks.mapInPandas(link, "a long, b long").distinct()


def fingerprint_groups(fps: DataFrame, max_bits: int = 4, spare: int = SPARE) -> DataFrame:
    """``fp, root``: a long that is shared by the fingerprints that links connect."""
    comps = connected_components(fingerprint_links(fps, max_bits, spare), "a", "b")
    return fps.select("fp").join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4, spare: int = SPARE
) -> DataFrame:
    """``doc_id, fp, component_id``: one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links (fingerprints
    that differ in at most ``max_bits`` bits), the row's own included. Null
    and empty texts have fingerprint 0, linked like any other. Rows with a
    null id take part; a group of them alone has a null component. Repeated
    rows each get a row. Only ids and fingerprints are shuffled; equal
    fingerprints are collapsed before the search. Columns other than the id
    and the text are not read. ``spare`` blocks make a key (see ``SPARE``).
    """
    marked = cut(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), "t", shingle).drop("t"))
    fps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    groups = fingerprint_groups(fps, max_bits, spare)
    low = fps.join(groups, "fp").groupBy("root").agg(F.min("low").alias("component_id"))
    known = cut(groups.join(low, "root").select("fp", "component_id"))
    return marked.join(known, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4, spare: int = SPARE
) -> DataFrame:
    """The rows of ``docs`` that are left when one document of each group stays.

    The row of the smallest id stays (rows without an id come last); among
    rows with that id and fingerprint, the smallest by their columns as JSON.
    The columns are those of ``docs``, of any type that Parquet holds. Rows
    and fingerprints are written once to the shared folder; what is dropped
    is told by id and fingerprint, broadcast up to ``BROADCAST_IDS`` bytes.
    Only rows that share both id and fingerprint are shuffled with texts.
    """
    path = scratch_path(docs.sparkSession, "simhash_rows")
    full = with_fingerprints(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), f"row.`{text}`", shingle)
    full.select("row", F.col(f"row.`{doc_id}`").alias("id"), "fp").write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    marked = cut(rows.groupBy("id", "fp").agg(F.count("*").alias("n")))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"))
    fps = cut(marked.groupBy("fp").agg(F.min(order).alias("low")))
    best = fps.join(fingerprint_groups(fps, max_bits, spare), "fp").groupBy("root").agg(F.min("low").alias("low"))
    best = best.select(F.col("low.id").alias("keep_id"), F.col("low.fp").alias("keep_fp"))
    stays = marked.join(best, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("fp") == F.col("keep_fp")), "left")
    # Pairs of id and fingerprint that go, and those that several rows have.
    drop = cut(stays.where("keep_fp is null or n > 1").select(F.col("id").alias("out_id"), F.col("fp").alias("out_fp"), F.col("keep_fp").isNotNull().alias("several")))
    size, several = drop.agg(F.sum(F.coalesce(F.octet_length(F.col("out_id").cast("string")), F.lit(0)) + 24), F.max("several")).first()
    drop = drop.hint("broadcast" if (size or 0) <= BROADCAST_IDS else "shuffle_hash")
    same = F.col("id").eqNullSafe(F.col("out_id")) & (F.col("fp") == F.col("out_fp"))
    kept = rows.join(drop, same, "left_anti").select("row")
    if several:
        one = rows.join(drop.where("several"), same, "left_semi").groupBy("id", "fp").agg(F.min_by("row", F.to_json("row")).alias("row"))
        kept = kept.unionByName(one.select("row"))
    return kept.select("row.*")
