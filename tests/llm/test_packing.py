from __future__ import annotations

import random

from staylake.llm.packing import CAPACITIES, pack, pack_block, pack_documents, sequence_cost

from tests.llm.conftest import edge_documents, no_documents


def brute_best_fit(lengths, capacities, cost):
    """Best fit by looking at every bin for every piece."""
    room, used, out, left = [], [], [], sum(lengths)
    for n in lengths:
        fits = [(room[b], b) for b in range(len(room)) if room[b] >= n and room[b] >= 0 and (room[b] > 0)]
        if fits:
            b = min(fits)[1]
        else:
            c = min((c for c in capacities if c >= n), key=lambda c: (cost(c) / max(min(c, left), 1), c))
            room.append(c)
            used.append(0)
            b = len(room) - 1
        out.append((b, used[b]))
        used[b] += n
        room[b] -= n
        left -= n
    return out


def test_block_against_brute_force():
    rnd = random.Random(3)
    for _ in range(30):
        top = rnd.choice([30, 100, 512])
        lengths = sorted((rnd.randint(1, top) for _ in range(rnd.randint(1, 200))), reverse=True)
        caps = tuple(sorted(rnd.sample(range(top, 6 * top), 3)))
        assert pack_block(lengths, caps, sequence_cost) == brute_best_fit(lengths, caps, sequence_cost)


def _holds(rows, capacities):
    bins = {}
    for r in rows:
        bins.setdefault(r["bin_id"], []).append(r)
    for inside in bins.values():
        at = 0
        for r in sorted(inside, key=lambda r: (r["offset"], r["length"])):
            assert r["offset"] == at
            at += r["length"]
        assert {r["bin_used"] for r in inside} == {at}
        assert {r["bin_capacity"] for r in inside} == {min(c for c in capacities if c >= at)}
    return bins


def test_whole_rows_are_packed(spark):
    rnd = random.Random(4)
    items = [(i, rnd.choice([3, 40, 700, 5_000, 30_000]) + i % 37) for i in range(400)] + [(1000, 11)] * 5
    rows = pack(spark.createDataFrame(items, "id long, n long"), "id", "n").collect()
    bins = _holds(rows, CAPACITIES)
    assert sum(r["length"] for r in rows) == sum(n for _, n in items)
    assert sum(r["length"] for r in rows) / sum(i[0]["bin_capacity"] for i in bins.values()) > 0.8
    ends = {}
    for r in rows:
        assert r["start"] == 8192 * r["piece"]
        ends[r["id"], r["copy"]] = max(ends.get((r["id"], r["copy"]), 0), r["start"] + r["length"])
    assert sorted(ends.values()) == sorted([n for _, n in items[:400]] + [11] * 5)
    assert sorted(r["copy"] for r in rows if r["id"] == 1000) == [0, 1, 2, 3, 4]
    again = pack(spark.createDataFrame(items, "id long, n long").repartition(7), "id", "n").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_edges(spark):
    rows = pack_documents(edge_documents(spark)).collect()
    _holds(rows, CAPACITIES)
    total = {}
    for r in rows:
        total[(r["doc_id"], r["copy"])] = total.get((r["doc_id"], r["copy"]), 0) + r["length"]
    assert total[(1, 0)] == total[(2, 0)] == total[(3, 0)] == 1 and total[(5, 0)] == 60_001
    assert (8, 1) in total and (None, 0) in total and len(total) == 11
    assert pack_documents(no_documents(spark)).count() == 0
    odd = spark.createDataFrame([("a", None), ("b", -3), ("c", 0), ("d", 9000)], "id string, n int")
    assert sorted((r["id"], r["length"]) for r in pack(odd, "id", "n").collect()) == [("a", 0), ("b", 0), ("c", 0), ("d", 808), ("d", 8192)]
