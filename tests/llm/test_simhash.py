from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from staylake.llm import queries as Q
from staylake.llm.simhash import block_keys, fingerprint, fingerprint_groups, keep_one, near_duplicates

from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_documents, no_documents


def slow_fingerprint(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, bits):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits and find(a) != find(b):
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_fingerprint_against_definition():
    rnd = random.Random(5)
    for _ in range(200):
        t = "".join(rnd.choice(["a", "B", "É", " ", "\t", "\x0b", "\x1c", " ", "cd", "."]) for _ in range(rnd.randint(0, 60)))
        assert fingerprint(t, 4) == slow_fingerprint(t, 4), repr(t)
    assert fingerprint(None, 4) == fingerprint(" \n", 4) == 0


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in near_duplicates(docs).collect()}
    fps = {i: slow_fingerprint(t, 4) for i, t in texts.items()}
    roots = brute_roots(fps.values(), 4)
    low = {}
    for i, f in fps.items():
        low[roots[f]] = min(low.get(roots[f], i), i)
    assert got == {i: (f, low[roots[f]]) for i, f in fps.items()}
    kept = sorted(r["doc_id"] for r in keep_one(docs).collect())
    assert kept == sorted(low.values())


def test_dense_groups_lose_no_link(spark):
    rnd = random.Random(7)
    near = {0, 1, 3}
    for _ in range(400):  # a chain of steps of at most four bits, and a dense ball
        x = rnd.choice(sorted(near)[-20:])
        for _ in range(rnd.randint(1, 4)):
            x ^= 1 << rnd.randrange(64)
        near.add(x)
    ball = {(1 << 63) | sum(1 << b for b in rnd.sample(range(12), rnd.randint(0, 6))) for _ in range(600)}
    fps = sorted(near | ball | {rnd.getrandbits(64) for _ in range(300)})
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    got = {r["fp"] & (2**64 - 1): r["root"] for r in fingerprint_groups(df, 4).collect()}
    want = brute_roots(fps, 4)
    assert len(set(zip(got.values(), (want[f] for f in got)))) == len(set(got.values())) == len(set(want.values()))


def test_linked_fingerprints_share_a_key():
    import numpy as np

    rnd = random.Random(9)
    a = [rnd.getrandbits(64) for _ in range(300)]
    b = [x ^ sum(1 << i for i in rnd.sample(range(64), 4)) for x in a]
    ka, kb = (block_keys(np.array(v, np.uint64), 4) for v in (a, b))
    assert ka.shape == (300, 15) and all((x == y).any() for x, y in zip(ka, kb))


def test_edges(spark):
    docs = edge_documents(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == 11
    comp = {r["doc_id"]: r["component_id"] for r in rows}
    assert comp[1] == comp[2] == comp[3] == 1 and comp[7] == 6 and comp[8] == 8 and comp[None] is None
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 4, 5, 6, 8, 9, None]
    assert near_duplicates(no_documents(spark)).count() == keep_one(no_documents(spark)).count() == 0
    assert docs.select(F.max("fp")).first()[0] == 0


def test_columns_of_any_type_and_longer_keys(spark):
    docs = edge_documents(spark).withColumn("m", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("list", F.array(F.struct("lang")))
    for spare in (2, 3):
        kept = keep_one(docs, spare=spare)
        assert kept.schema == docs.schema or kept.columns == docs.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 4, 5, 6, 8, 9, None]
        comp = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, spare=spare).collect()}
        assert comp[3] == 1 and comp[7] == 6 and comp[8] == 8


def test_query_columns(spark):
    rows = Q.op2_simhash_near_dedup(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{slow_fingerprint(t, 4):016x}" for i, t in texts.items()}
