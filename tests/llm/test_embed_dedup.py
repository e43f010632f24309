from __future__ import annotations

import numpy as np

from staylake.llm.embed_dedup import lattice_roots, near_duplicate_vectors, nearest_e8


def brute(vectors, threshold=0.9):
    """Links and smallest reachable id of each vector, all pairs compared."""
    ok = {i: v for i, v in vectors if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = sorted(ok)
    unit = {i: np.array(ok[i], float) / np.linalg.norm(ok[i]) for i in ids}
    links = {i: [j for j in ids if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in ids}
    low = {i: i for i, _ in vectors}
    for i in ids:
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low[i] = min(seen)
    return {i: (len(links.get(i, [])), low[i], low[i] == i) for i, _ in vectors}


def test_nearest_lattice_points():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) * 2
    near = nearest_e8(x)
    roots = lattice_roots()
    assert len(np.unique(roots, axis=0)) == 240 and np.allclose((roots**2).sum(1), 2)
    d = ((x - near) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all()  # the covering radius
    others = near[:, None, :] + roots[None]
    assert (((x[:, None, :] - others) ** 2).sum(2) >= d[:, None] - 1e-9).all()
    whole = np.isclose(near, np.rint(near)).all(1)
    half = np.isclose(near - 0.5, np.rint(near - 0.5)).all(1)
    assert (whole | half).all() and np.allclose(near.sum(1) % 2, 0)


def test_links_and_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 64))
    rows = [*base, *rng.normal(size=(200, 64))]
    for i in range(60):  # partners from 0.85 to 1
        noise = rng.normal(size=64) * np.linalg.norm(base[i]) / 8
        rows.append(base[i] + noise * rng.uniform(0, 0.6))
    center = rng.normal(size=64)
    rows += [center + rng.normal(size=64) * 0.25 for _ in range(300)]  # one dense group
    rows += [base[0]] * 20  # copies
    data = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]
    data += [(1000, None), (1001, [0.0] * 64), (1002, [float("nan")] + [1.0] * 63), (1003, [None] + [1.0] * 63),
             (1004, [float("inf")] * 64), (1005, []), (1006, data[0][1][:32]), (1007, data[0][1][:32]), (1008, [1e-30] * 64), (1009, [1e30] * 64)]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(df).collect()}
    want = brute(data)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in want.values())
    assert sum(got[i][1:] == want[i][1:] for i in got) >= 0.99 * len(got)
    assert all(got[i] == want[i] for i in range(1000, 1010))


def test_null_ids_repeats_and_empty(spark):
    v, w = [1.0] * 8, [1.0] * 4 + [-1.0] * 4
    df = spark.createDataFrame([(5, v), (5, v), (None, v), (None, w), (7, w), (None, [2.0, 1.0])], "vec_id long, embedding array<float>")
    rows = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in near_duplicate_vectors(df).collect())
    assert rows == sorted([("5", 2, "5", True), ("5", 2, "5", True), ("None", 2, "5", False), ("None", 1, "7", False), ("7", 1, "7", True), ("None", 0, "None", False)])
    assert near_duplicate_vectors(df.limit(0)).count() == 0
