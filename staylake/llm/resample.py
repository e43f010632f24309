"""Importance resampling towards a target corpus, ranked by a distributed radix sort.

Runs of one to three words are hashed into buckets. A bucket's gain is the
log ratio of its smoothed shares in the target and in the raw corpus, and a
document's weight is the sum of the gains of its features: arrays of counts
in, an array of gains out, both of as many entries as there are buckets.
Gumbel noise from the id turns weights into scores whose highest ones are a
draw without replacement. The highest scores are ranked by least-significant-
digit counting sorts over the digits of (score, id): counts by digit and chunk
of the current order, their prefix sums as offsets, and a row's place within
its digit and chunk give where it goes.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylake.llm.common import cut

#: Hash buckets and the longest run of words.
BUCKETS, RUN = 10_000, 3
#: Fewest words of a document that can be drawn, and the share drawn of those, in percent.
MIN_WORDS, PERCENT = 20, 5
SEED = 42
#: Bits of a digit, and rows of a chunk at least and at most.
DIGIT, CHUNK = 11, (1 << 8, 1 << 16)
#: Words remembered by a task, bytes of a text cut into words at a time, words hashed at a time.
MEMORY, PIECE, FLUSH = 1 << 19, 1 << 20, 200_000
#: Longest step of the table that moves a checksum past further bytes.
STEP = 255

#: Every byte as it counts: digits, letters in lower case and all beyond ASCII, others blank.
_SEEN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _crc_steps() -> np.ndarray:
    """``[n, k, v]``: the checksum register after n zero bytes, of value v in byte k."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)
    steps = np.empty((STEP + 1, 4, 256), np.uint32)
    steps[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(STEP):
        steps[n + 1] = (steps[n] >> 8) ^ byte[steps[n] & 255]
    return steps


class _Known(dict):
    """Checksum and length of a word in one number."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word) | len(word) << 32
        return value


class RunHashes:
    """CRC-32 of the runs of words of texts, joined by a space, from the words' own checksums.

    A checksum is linear: that of a longer string is that of its beginning,
    moved past the bytes that follow, and that of its end.
    """

    def __init__(self, run: int = RUN):
        self.run, self.steps, self.known = run, _crc_steps(), _Known()
        self.blank = zlib.crc32(b" ")

    def _moved(self, crc: np.ndarray, by: np.ndarray) -> np.ndarray:
        """``crc`` moved past ``by`` bytes."""
        by = by.copy()
        while len(far := np.flatnonzero(by > STEP)):
            crc = crc.copy()
            crc[far] = self._moved(crc[far], np.full(len(far), STEP))
            by[far] -= STEP
        t = self.steps
        return t[by, 0, crc & 255] ^ t[by, 1, (crc >> 8) & 255] ^ t[by, 2, (crc >> 16) & 255] ^ t[by, 3, crc >> 24]

    def words(self, text: str | None) -> np.ndarray:
        """Checksum and length of each word of a text."""
        raw = (text or "").encode("utf-8").translate(_SEEN)
        parts, at = [np.zeros(0, np.int64)], 0
        while at < len(raw):
            end = at + PIECE
            if end < len(raw):
                end = raw.find(b" ", end)
            end = end if 0 <= end < len(raw) else len(raw)
            words = raw[at:end].split()
            if len(self.known) > MEMORY:
                self.known.clear()
            parts.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
            at = end
        return np.concatenate(parts)

    def runs(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(checksums, doc)`` of all runs of 1, 2, ... words; a run lies within one ``doc``."""
        size = words >> 32
        own = (words & 0xFFFFFFFF).astype(np.uint32)
        crc = own
        yield crc, doc
        after = self._moved(np.full(len(own), self.blank, np.uint32), size) ^ own
        for k in range(1, self.run):
            if len(own) <= k:
                return
            crc = self._moved(crc[:-1], size[k:] + 1) ^ after[k:]
            inside = doc[:-k] == doc[k:]
            yield crc[inside], doc[:-k][inside]


def _grouped(texts: list[str | None], hashes: RunHashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first, words)`` of neighbouring texts with about ``FLUSH`` words together."""
    held, first, n = [], 0, 0
    for k, t in enumerate(texts):
        held.append(hashes.words(t))
        n += len(held[-1])
        if n >= FLUSH:
            yield first, held
            held, first, n = [], k + 1, 0
    if held:
        yield first, held


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """Features of all rows of ``docs`` in each bucket; each task adds up its rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = RunHashes(run), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, held in _grouped(batch.column(0).to_pylist(), hashes):
                doc = np.repeat(np.arange(len(held)), [len(h) for h in held])
                for crc, _ in hashes.runs(np.concatenate(held), doc):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    parts = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's shares in target and raw corpus, rounded down."""
    b, s, t = len(raw), int(raw.sum()), int(target.sum())
    ratio = [float((int(y) + 1) * (s + b)) / float((int(x) + 1) * (t + b)) for x, y in zip(raw, target)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """Thousandths of a Gumbel number from the id, rounded down (a null id counts as an empty one)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, run: int = RUN, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of each row of ``docs``."""
    schema = "doc_id long, n_words long, n_features long, weight long, score long"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, buckets = RunHashes(run), np.uint32(len(gain))
        for batch in batches:
            ids, n = batch.column(0), batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for first, held in _grouped(batch.column(1).to_pylist(), hashes):
                here = slice(first, first + len(held))
                words[here] = [len(h) for h in held]
                doc = np.repeat(np.arange(len(held)), words[here])
                for crc, of in hashes.runs(np.concatenate(held), doc):
                    features[here] += np.bincount(of, minlength=len(held))
                    # Sums of integers below 2**53 are exact.
                    weight[here] += np.bincount(of, gain[crc % buckets], len(held)).astype(np.int64)
            extra = np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
            arrays = [ids, *map(pa.array, (words, features, weight, weight + extra))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return rows.mapInArrow(weigh, schema)


def _spread(rows: DataFrame, columns: list[str]) -> dict[str, tuple[int, int]]:
    """Least and greatest value of each column."""
    found = rows.agg(*[f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    return {c: (found[f"{c}_lo"] or 0, found[f"{c}_hi"] or 0) for c in columns}


def _key(column: str, lo: int, hi: int, falling: bool) -> tuple[Column, int]:
    """A column as an unsigned key that rises in the wanted order, and its bits."""
    c, span = F.col(column), hi - lo
    if span < 2**63:
        return (F.lit(hi) - c if falling else c - F.lit(lo)), span.bit_length()
    flipped = c.bitwiseXOR(F.lit(2**63 - 1)) if falling else c.bitwiseXOR(F.lit(-(2**63)))
    return flipped, 64


def _array(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _digit(key: Column, k: int, width: int) -> Column:
    return F.shiftrightunsigned(key, k * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _counting_sort(rows: DataFrame, digit: Column, digits: int, chunk_bits: int) -> DataFrame:
    """``rows`` with ``pos`` (their order) as it is after a stable sort by ``digit``, in the checkpoint folder.

    The offset of a digit in a chunk of the old order is the number of rows of
    smaller digits and of this digit in the chunks before. Rows are dealt by
    digit and chunk, so that neither an often found digit nor a chunk is one task.
    """
    columns = rows.columns
    rows = rows.withColumn("_digit", digit).withColumn("_chunk", F.shiftright("pos", chunk_bits))
    counts = rows.groupBy("_digit", "_chunk").agg(F.count("*").alias("_n"))
    totals = {r["_digit"]: r["n"] for r in counts.groupBy("_digit").agg(F.sum("_n").alias("n")).collect()}
    before = np.cumsum([0, *(totals.get(k, 0) for k in range(digits - 1))]).tolist()
    chunks = Window.partitionBy("_digit").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(chunks), F.lit(0)) + F.element_at(_array(before), F.col("_digit") + 1)
    offsets = counts.select("_digit", "_chunk", offset.alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_digit", "_chunk").orderBy("pos")) - 1
    placed = rows.join(offsets, ["_digit", "_chunk"]).withColumn("pos", F.col("_offset") + within)
    return cut(placed.select(*columns))


def radix_ranks(rows: DataFrame, order: list[tuple[str, bool]], digit: int = DIGIT) -> DataFrame:
    """``rows`` with the long column ``pos``: 0, 1, 2, ... by the long columns of ``order`` (name, falling).

    Distributed least-significant-digit radix sort, one checkpoint for each
    digit; nulls must have been replaced, equal keys get places in any order.
    """
    # Places in the files of the checkpoint are the first order: a lost task finds the same again.
    rows = cut(rows).withColumn("pos", F.monotonically_increasing_id())
    spread = _spread(rows, [c for c, _ in order])
    n, tasks = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(max(n // (4 * tasks), CHUNK[0]), CHUNK[1])
    passes = []
    for column, falling in reversed(order):
        key, bits = _key(column, *spread[column], falling)
        number = -(-bits // digit)
        width = -(-bits // number) if number else 0
        passes += [(_digit(key, k, width), 1 << width) for k in range(number)]
    for value, digits in passes or [(F.lit(0), 1)]:
        rows = _counting_sort(rows, value, digits, size.bit_length() - 1)
    return rows


def importance_sample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    run: int = RUN,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: one row for each row of ``docs``.

    ``rank`` counts the drawn documents from 1 by falling score, ties by
    rising id; it is null for all others. ``percent`` of the documents with
    at least ``min_words`` words are drawn, rounded down. Null, empty and
    blank texts have no features and a weight of 0. Repeated rows count and
    take part each; those with equal score and id are ranked in any order. A
    null id has the noise of an empty one and comes after all others of its
    score. An empty ``docs`` gives an empty result; an empty ``target`` has
    no counts but the smoothing. Columns other than id and text are not read.
    """
    gain = gains(bucket_counts(docs, text, buckets, run), bucket_counts(target, text, buckets, run))
    rows = cut(scored(docs, gain, doc_id, text, run, seed))
    lo, hi, n = rows.where(F.col("n_words") >= min_words).agg(F.min("score"), F.max("score"), F.count("*")).first()
    drawn = percent * n // 100
    unranked = F.lit(None).cast("long")
    if not drawn:
        return rows.withColumn("rank", unranked)
    # The leading digit of the score, counted over all, tells which documents can be drawn.
    shift = max(0, (hi - lo).bit_length() - DIGIT)
    lead = F.shiftright(F.lit(hi) - F.col("score"), shift)
    counts = rows.where(F.col("n_words") >= min_words).groupBy(lead.alias("lead")).agg(F.count("*").alias("n")).collect()
    least, seen = 0, 0
    for r in sorted(counts, key=lambda r: r.lead):
        least, seen = r.lead, seen + r.n
        if seen >= drawn:
            break
    able = (F.col("n_words") >= min_words) & (lead <= least)
    first = rows.where(able).withColumn("_none", F.col("doc_id").isNull().cast("long")).withColumn("_id", F.coalesce("doc_id", F.lit(0)))
    ranked = radix_ranks(first, [("score", True), ("_none", False), ("_id", False)])
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1)
    return rows.where(~able).withColumn("rank", unranked).unionByName(ranked.select(*rows.columns, rank.alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose documents are drawn, with all their columns (a drawn id keeps all its rows)."""
    drawn = importance_sample(docs, target, doc_id, text, **settings).where("rank is not null")
    ids = drawn.select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col(f"`{doc_id}`").cast("long") == F.col("_drawn"), "left_semi")
