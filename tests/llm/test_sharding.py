from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from staylake.llm import sharding as S
from staylake.llm.sharding import grant, shard_documents

from tests.llm.conftest import edge_documents, no_documents


def _law_holds(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert set(by) <= set(range(shards))


def test_groups_gather_and_counts_are_even(spark):
    # 40 groups of five, one group of a third of all rows, the rest alone
    texts = [f"group {i % 40}" for i in range(200)] + ["hot"] * 300 + [f"alone {i}" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_documents(df, shards=8).collect()
    assert len(rows) == 900
    _law_holds(rows, 8)
    where = {}
    for r in rows:
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    groups = [len(v) for k, v in where.items() if k.startswith("group")]
    assert sum(n == 1 for n in groups) >= 36
    assert len(where["hot"]) <= 6
    for r in rows:
        t = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 1, zlib.crc32(t))


def test_edges(spark):
    rows = shard_documents(edge_documents(spark), shards=3).collect()
    assert len(rows) == 11
    _law_holds(rows, 3)
    by = {r["doc_id"]: r for r in rows}
    assert (by[1]["size"], by[1]["text_crc32"]) == (1, 0)
    assert by[6]["shard"] == by[7]["shard"]
    assert shard_documents(no_documents(spark), shards=3).count() == 0


def test_same_result_on_other_partitions(spark):
    df = spark.createDataFrame([(i, f"t{i // 3}") for i in range(120)], "doc_id long, text string")
    a = shard_documents(df.repartition(2), shards=4).orderBy("doc_id").collect()
    assert a == shard_documents(df.repartition(5, F.col("text")), shards=4).orderBy("doc_id").collect()


@pytest.mark.parametrize("limit", [10, 12, 100])
def test_grants_respect_the_limit(limit):
    flows = [(a, b, q, 1 + (a * b + q) % 3) for a in range(4) for b in range(4) if a != b for q in range(6)]
    load = [10.0] * 4
    granted = grant(flows, load, limit)
    after = [10.0] * 4
    for a, b, q, n in flows:
        if b * 64 + q in granted:
            after[a] -= n
            after[b] += n
    assert after == load and max(after) <= max(limit, 10)


@pytest.mark.parametrize("size,shards", [(90, 16), (100, 16), (150, 16), (533, 16)])
def test_a_group_that_fits_a_shard_stays_whole(spark, size, shards):
    """A group of up to a share ends in one shard, a larger one in as few as hold it."""
    texts = ["hot"] * size + [f"pair {i // 2}" for i in range(400)]
    texts += [f"alone {i}" for i in range(1600 - len(texts))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_documents(df, shards=shards).collect()
    _law_holds(rows, shards)
    assert len({r["shard"] for r in rows if texts[r["doc_id"]] == "hot"}) == -(-size // 100)
    pairs = {}
    for r in rows:
        pairs.setdefault(texts[r["doc_id"]], []).append(r["shard"])
    split = [k for k, v in pairs.items() if k.startswith("pair") and len(set(v)) > 1]
    assert len(split) <= 12


def _xx(value, seed=42):
    h = xxhash.xxh64_intdigest((value & (2**64 - 1)).to_bytes(8, "little"), seed)
    return h


def _signed(h):
    return h - 2**64 if h >> 63 else h


def _xx_int(value, seed):
    return xxhash.xxh64_intdigest((value & (2**32 - 1)).to_bytes(4, "little"), seed)


def plain_propagation(edges, total, shards):
    """The rounds written out for units with keys of a few rows: ``{unit: shard}``."""
    keys, of = {}, {}
    for u, k in edges:
        keys.setdefault(k, set()).add(u)
    keys = {k: v for k, v in keys.items() if len(v) > 1}
    for k, v in keys.items():
        for u in v:
            of.setdefault(u, []).append(k)
    shard = {u: _signed(_xx(u)) % shards for u in of}
    share = total / shards
    limit, full, together, kept = share + (share * (S.QUOTA - 1) + 1) * len(of) / total, [], -1, None
    for r in range(S.ROUNDS):
        held = {k: [sum(shard[u] == s for u in v) for s in range(shards)] for k, v in keys.items()}
        votes = {u: [sum(held[k][s] for k in ks) for s in range(shards)] for u, ks in of.items()}
        near = sum(votes[u][shard[u]] for u in of)
        if near <= together:
            return kept
        together, kept = near, dict(shard)
        want, lot = {}, {}
        for u, ks in of.items():
            k = min(ks)
            rank = lambda s: (not full or s not in full or 2 * votes[u][s] > sum(votes[u]), votes[u][s], _signed(_xx_int(s, _xx(k))), s)
            want[u], lot[u] = max(range(shards), key=rank), _signed(_xx_int(r, _xx(k))) % S.LOTS
        flows = Counter((shard[u], want[u], lot[u]) for u in of if want[u] != shard[u])
        load = [sum(x == s for x in shard.values()) for s in range(shards)]
        granted = grant(sorted((a, b, q, n) for (a, b, q), n in flows.items()), load, limit)
        full = [s for s in range(shards) if load[s] > 0.99 * limit]
        if not granted:
            return shard
        shard = {u: want[u] if want[u] * S.LOTS + lot[u] in granted else s for u, s in shard.items()}
    return shard


def test_propagation_against_plain_rounds(spark):
    rng = random.Random(4)
    rows = [(u, [rng.randrange(400) for _ in range(rng.choice([0, 1, 1, 2, 3]))]) for u in range(1200)]
    df = spark.createDataFrame(rows, "u long, keys array<long>")
    got = {r["u"]: r["shard"] for r in S.propagate(df, "u", "keys", 4).collect()}
    assert got == plain_propagation([(u, k) for u, ks in rows for k in set(ks)], 1200, 4)


def test_large_keys_start_where_least_is():
    got = S.large_starts([(1, 50), (2, 250), (3, 90), (4, 90)], 100.0, 5)
    assert got == [(2, 0, 0), (2, 1, 1), (2, 2, 2), (3, 0, 3), (4, 0, 4), (1, 0, 0)]
