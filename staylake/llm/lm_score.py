"""Cross-entropy difference of two matched n-gram models.

A target model (trusted documents) and a background model (all documents) are
word-pair models of the same order, smoothing and vocabulary. A document's
score is the mean over its words of the target loss less the background loss:
the lower, the more the document is like the target.

Words and pairs are told apart by 64-bit hashes, each with its own counts. No
driver or task holds the models: a document's pairs go to buckets, each of
which holds all occurrences of its words and pairs, counts them and scores
them there. Only a fixed number of the most frequent words and pairs (``FREQUENT``,
``HOT``) is counted beforehand and sent to all tasks, with their full counts, so
that none of them fills a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from staylake.llm.common import fresh, marked
from staylake.session import scratch_path

#: Weight, in words, of the single-word model in a pair's probability.
SMOOTH = 10.0
#: Most frequent words and pairs known to all tasks; bounds of what is sent, not of the models.
FREQUENT, HOT = 65_535, 65_536
#: Documents of the sample that names the candidates for hot pairs (their counts are of all documents).
SAMPLE = 4_000
#: Bytes of text per bucket at most, on average; with less text, a bucket for each shuffle partition.
BYTES_PER_BUCKET = 16 << 20
#: Hashes of distinct words kept by a task; when full, the memory starts anew.
WORD_MEMORY = 200_000
#: Words of one text taken at a time, of a counting step, and of a group of documents dealt at a time.
CHUNK, COUNTED, DEALT = 1_000_000, 1_000_000, 200_000
#: What a document counts for: the background, the target, a score; and that its last word lies in the bucket.
BACKGROUND, TARGET, SCORED, TAIL = 1, 2, 4, 8

#: Rows for the buckets: of a group of documents (or parts), the words and pairs in the bucket, and one row of what is known without it.
_DEALT = (
    "bucket int, batch long, docs binary, flags binary, sizes binary, pairs binary, ids binary, words binary, "
    "keys binary, parts binary, n binary, target binary, background binary"
)
#: What a bucket returns for each row: sums by the document's place in its group.
_SUMS = "batch long, docs binary, keys binary, parts binary, n binary, target binary, background binary"


class _Words:
    """64-bit hashes of a text's lower-cased words, the mark of the beginning first."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        self.digest, self.known = xxh64_intdigest, {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known, out = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                if len(known) >= WORD_MEMORY:
                    known.clear()
                h = known[w] = self.digest(w)
            out.append(h)
        return np.array(out, np.uint64)

    def chunks(self, text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """``(previous, word)`` hashes of each word of a text, and whether these are its last."""
        words, last = (text or "").lower().encode("utf-8").split(), np.zeros(1, np.uint64)
        for k in range(0, len(words), CHUNK):
            h = self.hashes(words[k : k + CHUNK])
            yield np.concatenate([last, h[:-1]]), h, k + CHUNK >= len(words)
            last = h[-1:]


def _mixed(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _pairs(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of each pair."""
    return _mixed((before * np.uint64(0x9E3779B97F4A7C15)) ^ word)


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted ``known``, and which of ``wanted`` are there."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows a few at a time, so that few texts are Python objects at once."""
    for b in batches:
        for k in range(0, b.num_rows, 256):
            yield b.slice(k, 256)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


@dataclass
class PairModels:
    """Both models of ``docs`` (``key, text, flags``): sums, and the counts of the most frequent words and pairs.

    All other counts are made where they are needed, see ``with_loss_difference``.
    """

    source: DataFrame
    docs: DataFrame
    text: str
    size: int  # bytes of text
    total: np.ndarray  # [2] words: target, background
    begins: np.ndarray  # [2]: texts, the count of the beginning as a context
    vocabulary: int  # words of the background
    words: np.ndarray  # sorted hashes of frequent words
    word_counts: np.ndarray  # [2, n]
    pairs: np.ndarray  # sorted hashes of hot pairs, their word frequent
    pair_losses: np.ndarray  # [2, n], without the context

    def shared(self) -> "_Shared":
        return _Shared(self.total, self.begins, self.vocabulary, self.words, self.word_counts, self.pairs, self.pair_losses)


@dataclass
class _Shared:
    """What every task knows of the models; its size has a bound.

    A word's probability after another is its pair count plus ``SMOOTH``
    times its own probability, over the count of the word before plus
    ``SMOOTH``. Both models spread their single-word counts over one
    vocabulary, the words of the background, by adding one to each. A loss is
    the sum of a part of the pair and its word, and a part of the context.
    """

    total: np.ndarray
    begins: np.ndarray
    vocabulary: int
    words: np.ndarray
    word_counts: np.ndarray
    pairs: np.ndarray
    pair_losses: np.ndarray

    def pair_part(self, both: np.ndarray, one: np.ndarray) -> np.ndarray:
        single = (one + 1.0) / (self.total[:, None] + self.vocabulary + 1)
        return -np.log(both + SMOOTH * single)

    def deal(self, buckets: int, batch: int, docs: list[tuple]) -> Iterator[dict]:
        """Rows for the buckets of a group of documents (or parts): ``key, flags, before, word, part, last``."""
        keys, flags, parts = (np.array([d[i] for d in docs], t) for i, t in ((0, np.int64), (1, np.uint8), (4, np.int32)))
        first, last = parts == 0, np.array([d[5] for d in docs], bool)
        size = np.array([len(d[3]) for d in docs])
        before, word = (np.concatenate([d[i] for d in docs]) for i in (2, 3))
        at = np.repeat(np.arange(len(docs)), size)
        tail = np.zeros(len(word), bool)
        tail[np.cumsum(size)[last] - 1] = True
        pair = _pairs(before, word)
        f, frequent = _find(self.words, word)
        h, hot = _find(self.pairs, pair)
        context = frequent & ~tail
        here = np.zeros((2, len(docs)))
        for m in (0, 1):
            here[m] += np.bincount(at[hot], self.pair_losses[m, h[hot]], len(docs))
            here[m] += np.bincount(at[context], np.log(self.word_counts[m, f[context]] + SMOOTH), len(docs))
            here[m] += first * np.log(self.begins[m] + SMOOTH)
        # A frequent word is dealt by its pairs, any other whole.
        bucket = ((np.where(frequent, pair, _mixed(word)) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        scored = np.flatnonzero(flags & SCORED).astype(np.uint32)
        if len(scored):
            yield {"bucket": int(keys[0] % buckets), "batch": batch, "docs": scored.tobytes(), "keys": keys[scored].tobytes(),
                   "parts": parts[scored].tobytes(), "n": size[scored].astype(np.int64).tobytes(),
                   "target": here[0, scored].tobytes(), "background": here[1, scored].tobytes()}
        rest = np.flatnonzero(~hot)
        rest = rest[np.argsort(bucket[rest], kind="stable")]
        bucket = bucket[rest]
        for r in np.split(rest, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1) if len(rest) else ():
            d = at[r]
            ends = np.append(np.flatnonzero(d[1:] != d[:-1]), len(d) - 1)
            own = d[ends]
            ids = np.where(frequent[r], f[r], FREQUENT).astype(np.uint16)
            k = int((pair[r[0]] if frequent[r[0]] else _mixed(word[r[:1]])[0]) >> np.uint64(20)) % buckets
            yield {"bucket": k, "batch": batch, "docs": own.astype(np.uint32).tobytes(), "flags": (flags[own] | TAIL * tail[r[ends]]).astype(np.uint8).tobytes(),
                   "sizes": np.diff(ends, prepend=-1).astype(np.uint32).tobytes(), "pairs": pair[r].tobytes(),
                   "ids": ids.tobytes(), "words": word[r[~frequent[r]]].tobytes()}

    def sums(self, bucket: pa.Table) -> list[dict]:
        """Rows of one bucket with the losses of their words added up by document; others pass through."""
        rows = bucket.to_pylist()
        out = [{k: r[k] for k in ("batch", "docs", "keys", "parts", "n", "target", "background")} for r in rows if r["pairs"] is None]
        rows = [r for r in rows if r["pairs"] is not None]
        if not rows:
            return out

        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join([r[name] for r in rows]), kind)

        flags, sizes = joined("flags", np.uint8), joined("sizes", np.uint32)
        pair, ids, rare = joined("pairs", np.uint64), joined("ids", np.uint16), joined("words", np.uint64)
        docs = [np.frombuffer(r["docs"], np.uint32) for r in rows]
        names = [r["batch"] for r in rows]
        del rows
        at = np.repeat(np.arange(len(flags)), sizes)
        weights = [(flags & b > 0).astype(float)[at] for b in (TARGET, BACKGROUND)]
        tail = np.zeros(len(at), bool)
        tail[np.cumsum(sizes.astype(np.int64))[flags & TAIL > 0] - 1] = True
        known, is_rare = ids != FREQUENT, ids == FREQUENT
        _, pair_at = np.unique(pair, return_inverse=True)
        _, word_at = np.unique(rare, return_inverse=True)
        loss = np.empty((2, len(at)))
        for m in (0, 1):
            both = np.bincount(pair_at, weights[m])[pair_at]
            one = np.empty(len(at))
            one[known] = self.word_counts[m, ids[known]]
            one[is_rare] = np.bincount(word_at, weights[m][is_rare])[word_at] if len(rare) else 0
            single = (one + 1.0) / (self.total[m] + self.vocabulary + 1)
            loss[m] = -np.log(both + SMOOTH * single)
            context = is_rare & ~tail
            loss[m, context] += np.log(one[context] + SMOOTH)
        part = [np.bincount(at, loss[m], len(flags)) for m in (0, 1)]
        scored, end = flags & SCORED > 0, 0
        for batch, d in zip(names, docs):
            here = slice(end, end + len(d))
            some, end = scored[here], end + len(d)
            if some.any():
                out.append({"batch": batch, "docs": d[some].tobytes(), "target": part[0][here][some].tobytes(), "background": part[1][here][some].tobytes()})
        return out


def _by_document(batch: pa.Table) -> pa.Table:
    """``key, part, n, target, background``: sums over the buckets for each document (or part) of a group."""
    rows = batch.to_pylist()
    own = next(r for r in rows if r["keys"] is not None)
    docs = np.frombuffer(own["docs"], np.uint32)
    total = np.zeros((2, int(docs.max()) + 1))
    for r in rows:
        for m, name in enumerate(("target", "background")):
            total[m, np.frombuffer(r["docs"], np.uint32)] += np.frombuffer(r[name], float)
    return pa.table(
        {
            "key": np.frombuffer(own["keys"], np.int64),
            "part": np.frombuffer(own["parts"], np.int32),
            "n": np.frombuffer(own["n"], np.int64),
            "target": total[0, docs],
            "background": total[1, docs],
        }
    )


def _count(rows: DataFrame, candidates: np.ndarray | None = None) -> DataFrame:
    """``pair, word, target, background`` of ``rows`` (``text, flags``), summed.

    Counts of all words (``pair`` null), of the pairs in ``candidates`` (all
    pairs if None), and of the beginnings (both null).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        held: list[tuple[np.ndarray, np.ndarray, bool]] = []
        begins = np.zeros(2, np.int64)

        def summed(pair: np.ndarray | None, word: np.ndarray, good: np.ndarray) -> Iterator[pa.RecordBatch]:
            _, first, inverse, n = np.unique(word if pair is None else pair, return_index=True, return_inverse=True, return_counts=True)
            target = np.bincount(inverse, good, len(n)).astype(np.int64)
            none = pa.nulls(len(n), pa.int64())
            for k in range(0, len(n), 200_000):
                s = slice(k, k + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [none[s] if pair is None else pa.array(_signed(pair[first[s]])), pa.array(_signed(word[first[s]])), pa.array(target[s]), pa.array(n[s])],
                    names=["pair", "word", "target", "background"],
                )

        def flush() -> Iterator[pa.RecordBatch]:
            before, word = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            good = np.repeat([float(h[2]) for h in held], [len(h[1]) for h in held])
            held.clear()
            yield from summed(None, word, good)
            pair = _pairs(before, word)
            if candidates is not None:
                _, kept = _find(candidates, pair)
                pair, word, good = pair[kept], word[kept], good[kept]
            if len(pair):
                yield from summed(pair, word, good)

        n = 0
        for b in _small(batches):
            for t, flags in zip(b.column("text").to_pylist(), b.column("flags").to_pylist()):
                for k, (before, word, _) in enumerate(words.chunks(t)):
                    held.append((before, word, bool(flags & TARGET)))
                    n += len(word)
                    begins += (k == 0) * np.array([bool(flags & TARGET), 1])
                    if n >= COUNTED:
                        yield from flush()
                        n = 0
        if held:
            yield from flush()
        if begins[1]:
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(begins[:1]), pa.array(begins[1:])], names=["pair", "word", "target", "background"])

    found = rows.select("text", "flags").mapInArrow(count, "pair long, word long, target long, background long")
    return found.groupBy("pair", "word").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def _top(counts: DataFrame, column: str, n: int) -> pa.Table:
    """The ``n`` rows of highest background count."""
    return counts.orderBy(F.desc("background"), column).limit(n).toArrow()


def _columns(got: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``got`` by their sorted unsigned ``column``: it, counts, word."""
    key = got[column].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(key)
    counts = np.stack([got["target"].to_numpy(), got["background"].to_numpy()]).astype(float)
    return key[order], counts[:, order], got["word"].to_numpy().astype(np.int64).view(np.uint64)[order]


def fit_pair_models(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> PairModels:
    """Models of all words and pairs of all of ``docs``; ``trusted`` (column ``doc_id``) names the target documents.

    The words and the hot pairs are counted here, each task adding up its
    documents; the driver receives the sums and the most frequent ones. Null,
    empty and blank texts have no words, and do not count as texts; repeated
    rows and equal texts count each; null ids are never trusted; without
    documents, or without trusted ones, a model has no counts but the
    smoothing. Columns other than id and text are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    n, size = own.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    flags = (F.coalesce("_t", F.lit(0)) * TARGET + BACKGROUND).cast("int").alias("flags")
    flagged = marked(own, "_id", trusted.select(doc_id), "_t").select(F.xxhash64("text").alias("key"), "text", flags)

    part = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(max(1, n // SAMPLE))) == 0
    sample = own.where(part).select("text", F.lit(BACKGROUND).alias("flags"))
    candidates = np.sort(_columns(_top(_count(sample).where("pair is not null and background > 1"), "pair", HOT), "pair")[0])
    path = scratch_path(spark, "loss_words")
    _count(flagged, candidates).write.parquet(path)
    counts = spark.read.parquet(path)
    of_words = counts.where("pair is null and word is not null")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    vocabulary, *total = of_words.agg(F.count("*"), zero("target"), zero("background")).first()
    begins = counts.where("word is null").agg(zero("target"), zero("background")).first()
    words, word_counts, _ = _columns(_top(of_words, "word", FREQUENT), "word")
    pairs, both, last = _columns(counts.where("pair is not null").toArrow(), "pair")
    at, frequent = _find(words, last)
    pairs, both, at = pairs[frequent], both[:, frequent], at[frequent]
    know = _Shared(np.array(total, float), np.array(begins, float), vocabulary, words, word_counts, pairs, both)
    return PairModels(docs, flagged, text, size or 0, know.total, know.begins, vocabulary, words, word_counts, pairs, know.pair_part(both, word_counts[:, at]))


def with_loss_difference(docs: DataFrame, models: PairModels, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``target_loss``, ``background_loss`` and ``score`` (their difference), means per word.

    The words and pairs of the models' documents and of ``docs`` are dealt to
    buckets, counted and scored there, and added up again by group of
    documents; a result is found by its text's 64-bit hash (of texts that
    share one, the greater values hold for both). Equal texts and repeated
    rows each get the same values. A null or blank text has 0 tokens and
    null losses; an empty table gives an empty table. Columns of these names
    are replaced, all others pass through.
    """
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-models.size // BYTES_PER_BUCKET))
    shared = spark.sparkContext.broadcast(models.shared())
    arrow = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    kinds, found = (pa.schema([(f.split()[0], arrow[f.split()[1]]) for f in fields.split(", ")]) for fields in (_DEALT, _SUMS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, n = _Words(), [], 0
        batch = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            nonlocal batch
            rows = list(shared.value.deal(buckets, batch, held))
            batch += 1
            held.clear()
            return pa.RecordBatch.from_pylist(rows, kinds)

        for b in _small(batches):
            for key, t, flags in zip(*[b.column(c).to_pylist() for c in ("key", "text", "flags")]):
                for k, (before, word, last) in enumerate(words.chunks(t)):
                    held.append((key, flags, before, word, k, last))
                    n += len(word)
                    if n >= DEALT:
                        yield flush()
                        n = 0
        if held:
            yield flush()

    def score(bucket: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(shared.value.sums(bucket), found)

    if text == models.text and docs.sameSemantics(models.source):
        rows = models.docs.withColumn("flags", F.col("flags") + SCORED)
    else:
        other = docs.select(F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text"), F.lit(SCORED).alias("flags"))
        rows = models.docs.union(other)
    # Each bucket is in a partition of its own.
    n = buckets
    place = spark.range(30 * n).select(F.col("id").cast("int").alias("id"))
    place = place.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    spread = {r.p: r.id for r in place}
    name = F.lit(",".join(str(spread.get(i, i)) for i in range(n)))
    # In a fixed order, so that a task that is run again makes the same groups.
    dealt = rows.sortWithinPartitions("key", "flags").mapInArrow(deal, _DEALT)
    dealt = dealt.withColumn("bucket", F.element_at(F.split(name, ",").cast("array<int>"), F.col("bucket") + 1))
    parts = dealt.repartition(n, "bucket").groupBy("bucket").applyInArrow(score, _SUMS)
    sums = parts.groupBy("batch").applyInArrow(_by_document, "key long, part int, n long, target double, background double")
    # Copies of a text agree but for rounding; the parts of a long one add up.
    each = sums.groupBy("key", "part").agg(*[F.max(c).alias(c) for c in ("n", "target", "background")])
    sums = each.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", "target", "background")])
    new = ("n_tokens", "target_loss", "background_loss", "score")
    out = docs.drop(*new)
    key, losses = fresh(out, "loss_key"), fresh(out, "losses")
    sums = sums.select(F.col("key").alias(key), F.struct("n", "target", "background").alias(losses))
    out = out.withColumn(key, F.xxhash64(F.col(text))).join(sums, key, "left")
    at = lambda c: F.col(f"{losses}.{c}")
    values = F.coalesce(at("n"), F.lit(0)).cast("long"), *[v / at("n") for v in (at("target"), at("background"), at("target") - at("background"))]
    return out.withColumns(dict(zip(new, values))).drop(key, losses)
