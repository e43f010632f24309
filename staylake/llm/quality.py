"""Quality rules: counts within each text, and a hashed n-gram log-likelihood ratio.

DataFrame functions only. The ratio compares two multinomials over the same
hashed words and word pairs: one of trusted documents, one of the raw corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import fresh, marked, words_of
from staylake.session import scratch_path

#: Least number of cells of the hash, and cells for each cube root of the bytes of text: the cells grow with the corpus.
BUCKETS, CELLS_PER_ROOT = 10_000, 340
#: Cells in a block when the ratios are put together.
BLOCK = 4096
#: Added to the count of each cell of both multinomials.
SMOOTH = 1.0
#: Lowest mean log ratio (nats per n-gram) of a kept document: on average its n-grams may
#: be a tenth rarer among the trusted documents than in the corpus.
MIN_RATIO = -0.1
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _pairs(hashes: Column) -> Column:
    """Hash of each word and the next one, from the hashes of a text's words."""
    firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)))


def _repeat_words(hashes: Column, pairs: Column) -> Column:
    """Words of a text (by the hashes of its words and pairs) that lie in a window found twice or more."""

    def covered(windows: Column) -> Column:
        # Sorted by hash and place, a window that is found again is next to its like.
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(w: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(w, k)["h"] == x["h"], F.lit(False))
            return F.transform(F.filter(w, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

        return F.aggregate(
            F.sort_array(_let(placed, repeated)),
            F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n")),
            lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(i - a["at"], F.lit(WINDOW))).alias("n")),
            lambda a: a["n"],
        )

    none = F.lit(0).cast("long")
    # A window of five is two pairs and a word.
    firsts = F.slice(pairs, F.lit(1), F.greatest(F.size(hashes) - WINDOW + 1, F.lit(0)))
    windows = F.transform(firsts, lambda p, i: F.xxhash64(p, F.get(pairs, i + 2), F.get(hashes, i + 4)))
    count = _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(covered(w)))
    return F.when(F.size(hashes) > WINDOW, count).otherwise(none)


def base_stats(docs: DataFrame, text: str = "text", model: "RatioModel | None" = None) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    Everything is computed within the row, without a shuffle; the text is cut
    into words once. A null text has no words. Words that lie in several
    repeated windows count once. With a model also ``log_ratio``, the mean log
    ratio of the text's n-grams (0 without words). Columns of these names are
    replaced, all others pass through.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    columns = {
        "word_chars": F.length(F.translate(t, WHITE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }

    def of_words(x: Column) -> Column:
        h, pairs = x["h"], x["pairs"]
        found = {"n_words": F.size(h).cast("long"), **columns, "n_repeat_words": _repeat_words(h, pairs)}
        if model:
            found["log_ratio"] = model.mean(h, pairs, x["ratios"] if names else None)
        return F.struct(*[c.alias(name) for name, c in found.items()])

    given, names = [], []
    out = docs.drop("n_words", *columns, "n_repeat_words", "log_ratio", "base_failed")
    kept, ratios, stats = out.columns, fresh(out, "ratios"), fresh(out, "stats")
    if model and model.ratios is not None:
        # Used once, in the next projection, into which the optimizer moves it: no row holds the array.
        out = out.withColumn(ratios, model.ratios.scalar())
        given, names = [F.col(ratios).alias("ratios")], ["ratios"]
    # The output of a generator: a filter on it stays above, so nothing is computed twice.
    own = [F.col(f"`{c}`") for c in kept]
    hashed = lambda x: _let(F.struct(x["h"].alias("h"), _pairs(x["h"]).alias("pairs"), *[x[g].alias(g) for g in names]), of_words)
    words = F.struct(_hashes(words_of(F.col(text))).alias("h"), *given)
    out = out.select(*own, _let(words, hashed).alias(stats)).select(*own, F.inline(F.array(stats)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def gram_buckets(hashes: Column, pairs: Column, buckets: int) -> Column:
    """Array of the cells of a text's words and pairs of neighbouring words, from their hashes."""
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(buckets).cast("long")).cast("int"))


@dataclass(frozen=True)
class RatioModel:
    """Log ratio of each cell, trusted against raw: ``ratios``, a row with one array by cell (None if all are 0)."""

    buckets: int
    ratios: DataFrame | None

    def mean(self, hashes: Column, pairs: Column, ratios: Column | None) -> Column:
        """Mean ratio of a text's n-grams, from the hashes of its words and pairs."""
        if self.ratios is None:
            return F.lit(0.0)
        total = F.aggregate(gram_buckets(hashes, pairs, self.buckets), F.lit(0.0), lambda a, c: a + F.get(ratios, c))
        return total / F.greatest(2 * F.size(hashes) - 1, F.lit(1))


def fit_ratio(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None
) -> RatioModel:
    """Both multinomials over all of ``docs``; ``trusted`` names the trusted ids (column ``doc_id``).

    Every n-gram of every document is counted, on the executors; the cells
    are ``CELLS_PER_ROOT`` for each cube root of the bytes of text (at
    least ``BUCKETS``) unless ``buckets`` are given, so the array of ratios
    that all tasks get is 10 MB for 50 GB of text, 130 MB for 100 TB. Without a trusted document
    all ratios are 0. Null ids are never trusted, repeats in ``trusted`` do
    not count twice.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    if buckets is None:
        buckets = max(BUCKETS, int(CELLS_PER_ROOT * math.cbrt(own.agg(F.sum(F.octet_length("_text"))).first()[0] or 0)))
    cells = _let(_hashes(words_of(F.col("_text"))), lambda h: gram_buckets(h, _pairs(h), buckets))
    grams = marked(own, "_id", trusted.select(doc_id), "_t").select("_t", F.explode(cells).alias("cell"))
    path = scratch_path(spark, "quality_cells")
    grams.groupBy("cell").agg(F.count("*").alias("raw"), F.count("_t").alias("good")).write.parquet(path)
    counts = spark.read.parquet(path)
    raw, good = counts.agg(F.sum("raw"), F.sum("good")).first()
    if not good:
        return RatioModel(buckets, None)
    base = math.log(raw + SMOOTH * buckets) - math.log(good + SMOOTH * buckets)
    none = F.lit(0).cast("long")
    ratio = F.log(F.coalesce("good", none) + SMOOTH) - F.log(F.coalesce("raw", none) + SMOOTH) + F.lit(base)
    every = spark.range(buckets).select(F.col("id").alias("cell")).join(counts, "cell", "left")
    by_cell = F.sort_array(F.collect_list(F.struct("cell", ratio.alias("ratio"))))
    blocks = every.groupBy(F.floor(F.col("cell") / BLOCK).alias("block")).agg(by_cell["ratio"].alias("part"))
    return RatioModel(buckets, blocks.agg(F.flatten(F.sort_array(F.collect_list(F.struct("block", "part")))["part"]).alias("ratios")))


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int | None = None,
    min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """``docs`` with the columns of ``base_stats``, ``log_ratio`` and ``kept``.

    A document is kept if it passes the base rules and its mean log ratio is
    at least ``min_ratio``, a constant: the verdict on a document depends on
    the two corpora and its own text alone. Null and blank texts fail the base
    rules. Columns of these names are replaced.
    """
    model = fit_ratio(docs, trusted, doc_id, text, buckets)
    scored = base_stats(docs, text, model)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= min_ratio))
