"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Entries become integers on a grid. Each task shifts every dimension by its
smallest entry, cuts it into bit planes and packs the planes across rows into
64-bit words; the number of common bits of two planes is the popcount of their
AND, and the counts weighted by both planes' values add up to exact
cross-products. Tasks send sums of integers in limbs; centring, too, is done
on integers, before the only step in floating point, the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Grid steps in a unit.
GRID = 256
#: Rows whose planes are packed at a time.
ROWS = 16_384
#: Bits of a limb, and limbs of a sum: sums of limbs stay exact longs over any number of tasks.
LIMB, LIMBS = 40, 5


def on_grid(vector: Column, grid: int = GRID) -> Column:
    """Long entries ``floor(grid * c)`` of a vector; beyond a long, the nearest one."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(grid)) * c.cast("double")))


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds neither a null nor a non-finite entry."""
    return F.coalesce(F.forall(vector, lambda c: F.abs(c.cast("double")) < float("inf")), F.lit(False))


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products (Python integers) of the columns of ``x`` (int64, a row for each vector)."""
    n, d = x.shape
    low = x.min(0)
    u = x.view(np.uint64) - low.view(np.uint64)
    width = int(u.max()).bit_length()
    words = -(-n // 64)
    planes = np.zeros((width, d, words), np.uint64)
    for p in range(width):
        bits = np.zeros((words * 64, d), np.uint8)
        bits[:n] = (u >> np.uint64(p)) & np.uint64(1)
        planes[p] = np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64)
    flat = planes.reshape(width * d, words)
    # Counts of a plane with each of the planes of one value at a time: they are added up under one weight.
    small = 2 * width + int(n).bit_length() + 2 * width.bit_length() < 62
    total = np.zeros((d, d), np.int64 if small else object)
    sums = np.zeros(d, object)
    for p in range(width):
        sums += (1 << p) * np.bitwise_count(planes[p]).sum(1, dtype=np.int64).astype(object)
        here = np.zeros((width - p, d, d), np.int64)
        for i in range(d):
            both = np.bitwise_count(flat[p * d :] & planes[p, i])
            here[:, i] = both.sum(1, dtype=np.int64).reshape(width - p, d)
        for q in range(p, width):
            c = here[q - p] if small else here[q - p].astype(object)
            total += (1 << (p + q)) * (c if q == p else c + c.T)
    shift = low.astype(object)
    cross = total.astype(object) + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)
    return sums + n * shift, cross


def _limbs(v: int) -> list[int]:
    """``v`` in limbs, the last one signed."""
    return [(v >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)] + [v >> (LIMB * (LIMBS - 1))]


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors, their integer sums, and the components: unit vectors, eigenvalues, shares."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # [d, k]
    values: np.ndarray  # [k]
    explained: np.ndarray  # [k]
    identity_error: float

    @property
    def dims(self) -> int:
        return len(self.sums)


def fit_whitening(x: DataFrame, column: str, dims: int, components: int) -> Whitening:
    """The components of the vectors of ``x`` (array of ``dims`` longs), each distinct vector once.

    Equal vectors collapse on the executors; the driver receives one sum for
    each pair of dimensions. Components of no variance (an eigenvalue within
    rounding of 0) are left out.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, c = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        held: list[np.ndarray] = []

        def add() -> None:
            nonlocal n, s, c
            block = np.concatenate(held)
            held.clear()
            a, b = scatter(block)
            n, s, c = n + len(block), s + a, c + b

        for batch in batches:
            rows = _matrix(batch.column(0), dims)
            for k in range(0, len(rows), ROWS):
                held.append(rows[k : k + ROWS])
                if sum(map(len, held)) >= ROWS:
                    add()
        if held:
            add()
        if n:
            rows = [(-1, -1, n), *((i, -1, s[i]) for i in range(dims)), *((i, j, c[i, j]) for i in range(dims) for j in range(i, dims))]
            limbs = np.array([_limbs(int(v)) for *_, v in rows], np.int64)
            arrays = [pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1)] + [pa.array(limbs[:, k]) for k in range(LIMBS)]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", *[f"l{k}" for k in range(LIMBS)]])

    parts = x.select(column).distinct().mapInArrow(sums, "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS)))
    got = parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]).collect()
    value = {(r.i, r.j): sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS)) for r in got}
    n = value.get((-1, -1), 0)
    s = [value.get((i, -1), 0) for i in range(dims)]
    if not n or not dims:
        return Whitening(n, tuple(s), np.zeros((dims, 0)), np.zeros(0), np.zeros(0), 0.0)
    centred = [[n * value[min(i, j), max(i, j)] - s[i] * s[j] for j in range(dims)] for i in range(dims)]
    v = np.array([[c / (n * n) for c in row] for row in centred])
    trace = sum(centred[i][i] for i in range(dims)) / (n * n)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > dims * np.finfo(float).eps * max(e[0], 0.0)).sum()))
    e, u = e[:k], np.ascontiguousarray(u[:, :k])
    w = u / np.sqrt(e)
    error = float(np.abs(w.T @ v @ w - np.eye(k)).max()) if k else 0.0
    return Whitening(n, tuple(s), u, e, e / trace if k else e, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of ``(n*x - S)**2`` of each row, exact; None beyond a long."""
    s, fixed = np.array(sums, object), sum(v * v for v in sums)
    top = max(int(x.max()), -int(x.min())) if x.size else 0
    d, all_sums = x.shape[1], sum(map(abs, sums))
    if top * top * d < 2**62 and max(top, 1) * all_sums < 2**62:
        squares, along = (x * x).sum(1), x @ s.astype(np.int64)
        if n * n * top * top * d + 2 * n * top * all_sums + fixed < 2**63:
            return (n * n * squares - 2 * n * along + fixed).tolist()
        squares, along = squares.astype(object), along.astype(object)
    else:
        o = x.astype(object)
        squares, along = (o * o).sum(1), o @ s
    return [v if v < 2**63 else None for v in (n * n * squares - 2 * n * along + fixed).tolist()]


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 4, grid: int = GRID
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of the first components.

    One row for each usable row of ``vectors`` and component, numbered from 1
    by falling eigenvalue. Null vectors and those with null or non-finite
    entries have no rows. Of vectors of different lengths, the shorter ones
    count as 0 beyond their end. The fit takes each distinct vector once;
    repeated rows, and rows with a null id, each get their rows. Fewer
    components come out where the vectors vary in fewer directions: none for
    an empty table, a single vector, or equal ones. ``deviation`` is null
    where it exceeds a long. Columns other than the two are not read.
    """
    kept = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").alias("v")).where(usable(F.col("v")))
    low, dims = kept.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    dims = dims or 0
    x = on_grid(F.col("v"), grid)
    if dims and low < dims:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v")))
    rows = kept.select("vec_id", x.alias("x"))
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit_whitening(rows, "x", dims, components) if dims else None
    k = len(model.values) if model else 0
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    mean = np.array([s / model.n for s in model.sums])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            xs = _matrix(batch.column(1), dims)
            out = (xs - mean) @ model.vectors / np.sqrt(model.values)
            each = np.repeat(np.arange(m), k)
            far = pa.array(deviations(xs, model.n, model.sums), pa.int64()).take(pa.array(each))
            arrays = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)),
                far,
                pa.array(out.ravel()),
                pa.array(np.tile(model.explained, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(project, schema)
