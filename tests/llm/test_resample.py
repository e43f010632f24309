from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylake.llm import queries as Q
from staylake.llm.resample import RunHashes, importance_sample, radix_ranks, resampled

from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_documents, no_documents


def words(text):
    low = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, min_words=20, percent=5):
    """``(doc_id, n_features, weight, score, rank)`` of each of ``docs`` (id, text)."""
    raw, good = Counter(), Counter()
    for _, t in docs:
        raw.update(features(t))
    for t in target:
        good.update(features(t))
    s, t = sum(raw.values()), sum(good.values())
    gain = [math.floor(1000 * math.log(((good[b] + 1) * (s + 10000)) / ((raw[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return {r[0]: (*r[:4], rank.get(r[0])) for r in rows}


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = brute(docs, target)
    got = {r.doc_id: tuple(r) for r in Q.op11_importance_resampling(spark, SF_SMALL).collect()}
    assert got == want and sum(v[4] is not None for v in want.values()) > 5


def test_checksums_of_runs():
    rng = random.Random(5)
    texts = ["", None, "A", "Aé_b-C9", " ".join("w" * rng.choice([1, 3, 254, 255, 256, 700, 3000]) for _ in range(50)), "x" * 3_000_000 + " y z", "日本語 テキスト x"]
    h = RunHashes()
    held = [h.words(t) for t in texts]
    got = {}
    for crc, doc in h.runs(np.concatenate(held), np.repeat(np.arange(len(texts)), [len(x) for x in held])):
        for c, d in zip(crc.tolist(), doc.tolist()):
            got.setdefault(d, []).append(c % 10000)
    for i, t in enumerate(texts):
        assert got.get(i, []) == features(t)


@pytest.mark.parametrize("digit", [3, 11])
def test_radix_ranks(spark, digit):
    rng = random.Random(digit)
    rows = [(rng.choice([0, 5, -7, rng.randrange(-(10**6), 10**6)]), rng.randrange(2000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = sorted(radix_ranks(df, [("a", True), ("b", False)], digit).collect(), key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(len(rows)))
    assert [(r.a, r.b) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_radix_ranks_over_all_longs(spark):
    rows = [(v,) for v in (-(2**63), 2**63 - 1, 0, -1, 1, 2**62, -(2**62), 7, 7)]
    df = spark.createDataFrame(rows, "a long")
    for falling in (False, True):
        got = sorted(radix_ranks(df, [("a", falling)]).collect(), key=lambda r: r.pos)
        assert [r.a for r in got] == sorted((v for v, in rows), reverse=falling)
    assert radix_ranks(df.limit(0), [("a", False)]).count() == 0


def test_edges(spark):
    docs = edge_documents(spark).select("*", *[F.lit(0).alias(c) for c in ("pos", "score", "rank", "_none", "n_words")])
    target = spark.createDataFrame([("the same text twice",), (None,), ("",)], "text string")
    out = importance_sample(docs, target, min_words=1, percent=100).collect()
    assert len(out) == 11
    ranked = sorted((r for r in out if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, 9)) and all(r.rank is None for r in out if r.doc_id in (1, 2, 3))
    assert [r.score for r in ranked] == sorted((r.score for r in ranked), reverse=True)
    assert all(r.n_features == 0 and r.weight == 0 for r in out if r.doc_id in (1, 2, 3))
    plain = brute([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None], ["the same text twice"])
    assert {r.doc_id: r.n_features for r in out if r.doc_id is not None} == {i: v[1] for i, v in plain.items()}
    assert {r.rank for r in importance_sample(docs, target, min_words=1, percent=1).collect()} == {None}
    assert importance_sample(no_documents(spark), target).count() == 0
    assert importance_sample(docs, target.limit(0)).count() == 11
    kept = resampled(docs, target, min_words=1, percent=50)
    assert kept.columns == docs.columns and 3 <= kept.count() <= 5
