"""Whitening of embeddings from variances alone.

Entries become whole numbers, ``floor(64 c) + 1000000``. With ``n`` distinct vectors and sums ``S`` the centred values ``n x - S`` are whole
as well, and Spark adds up their exact squares: for every dimension, and for the sum of every two dimensions. As
``(a + b)^2 - a^2 - b^2 = 2 a b``, differences of these give every covariance without a product of two dimensions ever being formed; the
matrix of covariances (dimensions squared, whatever the number of rows) goes to the driver for its eigenvectors.

Each task sends one row for a pair of dimensions, so a vector that fills a third of the table weighs nothing: equal vectors meet in a
combining aggregation first.

Rows: a vector that is null, empty, holds a null, NaN or infinite entry, one beyond ``LARGEST``, or has another length than most vectors
(the shorter length on a tie) is dropped. Repeated rows and rows with a null id stay, each with its own result; ids need not be unique.
An empty table gives an empty result. A component without variance (fewer distinct vectors than dimensions) has a null projection.
Other columns of the input, whatever their names, are not looked at. A ``deviation`` beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.scratch import stored
from kinweave.llm.vectors import common_length, matrix, usable, whole

SCALE = 64
SHIFT = 1_000_000
#: Greatest entry, either way; whole numbers stay below 2^41.
LARGEST = float(2**34)
#: Components that are returned.
COMPONENTS = 16

#: Rows that are squared at a time, so that a block stays in a core's cache.
BLOCK = 1024
#: Bits of a limb: products of two take 42, and 2^19 of them, twice, fit a long.
LIMB = 21
#: Rows after which limbs are carried into unbounded integers.
CARRY = 2**19
#: Bits of each of the four parts in which a task reports a sum.
PART = 40


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors, their ``sums``, a unit eigenvector in each column of ``axes`` by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    #: Greatest absolute value of a centred entry.
    reach: int
    identity_error: float = 0.0

    @property
    def rank(self) -> int:
        """Components with a variance that rounding cannot explain."""
        e = self.eigenvalues
        return int((e > len(self.sums) * np.finfo(float).eps * max(e[0], 0)).sum()) if len(e) else 0


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``_id`` and the whole numbers ``x`` of every usable vector, in a written table."""
    vector = F.col(vector_col)
    x = F.transform(whole(vector, SCALE), lambda c: c + SHIFT)
    found = stored(df.filter(usable(vector, LARGEST)).select(F.col(id_col).alias("_id"), x.alias("x")), "whitening-vectors")
    return found.filter(F.size("x") == common_length(found, "x"))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x``; None without any."""
    distinct = stored(vectors.select("x").distinct(), "whitening-distinct")
    totals = distinct.mapInArrow(_sums, "i int, n long, total long, least long, most long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("least").alias("least"),
        F.max("most").alias("most")).orderBy("i").collect()
    if not totals:
        return None
    n, sums = totals[0]["n"], tuple(int(r["total"]) for r in totals)
    reach = max(max(abs(n * r["least"] - s), abs(n * r["most"] - s)) for r, s in zip(totals, sums, strict=True))
    squares = distinct.mapInArrow(_squares(n, sums, reach), "i int, j int, p0 long, p1 long, p2 long, p3 long").groupBy("i", "j").agg(
        *[F.sum(F.col(f"p{k}")).alias(f"p{k}") for k in range(4)]).collect()
    eigenvalues, axes = np.linalg.eigh(covariance(n, len(sums), squares))
    eigenvalues, axes = eigenvalues[::-1][:components], axes[:, ::-1][:, :components]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    trace = sum(_joined(r) for r in squares if r["i"] == r["j"]) / n**3
    explained = eigenvalues / trace if trace else np.zeros(len(eigenvalues))
    model = Whitening(n, sums, axes, eigenvalues, explained, reach)
    return Whitening(n, sums, axes, eigenvalues, explained, reach, _identity_error(distinct, model))


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``_id``, ``deviation`` (the exact squared distance of ``n x`` from ``S``) and the projections ``whitened`` of every row."""
    kind = dict(vectors.dtypes)["_id"]
    schema = f"_id {kind}, deviation long, whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _centred(batch.column(batch.schema.get_field_index("x")), model)
            w = _projected(y, model)
            rows = pa.ListArray.from_arrays(
                np.arange(len(w) + 1, dtype="int32") * w.shape[1], pa.array(w.ravel(), mask=np.isnan(w).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("_id")), pa.array(_deviation(y, model.reach), pa.int64()), rows],
                ["_id", "deviation", "whitened"])

    return vectors.mapInArrow(project, schema)


def covariance(n: int, length: int, squares: list) -> np.ndarray:
    """Covariances from the sums of squares of each dimension (``i = j``) and of each sum of two, rounded once at the end."""
    total = {(r["i"], r["j"]): _joined(r) for r in squares}
    found = np.empty((length, length))
    for (i, j), both in total.items():
        exact = both if i == j else (both - total[i, i] - total[j, j]) // 2
        found[i, j] = found[j, i] = exact / n**3
    return found


def _joined(row) -> int:
    return sum(row[f"p{k}"] << (PART * k) for k in range(4))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = None
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0), len(batch.column(0)[0]))
            now = [len(x), x.sum(axis=0), x.min(axis=0), x.max(axis=0)]
            seen = now if seen is None else [
                seen[0] + now[0], seen[1] + now[1], np.minimum(seen[2], now[2]), np.maximum(seen[3], now[3])]
    if seen is not None:
        length = len(seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(length, dtype="int32")), pa.array(np.full(length, seen[0])), *map(pa.array, seen[1:])],
            ["i", "n", "total", "least", "most"])


def _centred(column: pa.Array, model) -> np.ndarray:
    return _centre(matrix(column, len(model.sums)), model.n, model.sums, model.reach)


def _centre(x: np.ndarray, n: int, sums: tuple[int, ...], reach: int) -> np.ndarray:
    """``n x - S``, in longs while they hold the sum of two such values, else in unbounded integers."""
    if 2 * reach >= 2**62:
        return x.astype(object) * n - np.array(sums, dtype=object)
    middle = np.array([s // n for s in sums])
    return (x - middle) * n - np.array([s % n for s in sums])


def _squares(n: int, sums: tuple[int, ...], reach: int):
    length = len(sums)
    limbs = -(-max(1, (2 * reach).bit_length()) // LIMB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Row i of a table: the squares of dimension i in column i, of its sum with dimension j in column j > i.
        total = np.zeros((length, length), dtype=object)
        held = np.zeros((limbs, limbs, length, length), dtype=np.int64)
        rows = n_held = 0
        for batch in batches:
            y = _centre(matrix(batch.column(0), length), n, sums, reach)
            rows += len(y)
            for start in range(0, len(y), BLOCK):
                block = y[start:start + BLOCK]
                if n_held + len(block) > CARRY:
                    total, n_held = total + _carried(held), 0
                    held[:] = 0
                n_held += len(block)
                for i in range(length):
                    z = block[:, i:] + block[:, i:i + 1]
                    z[:, 0] = block[:, i]
                    if z.dtype == object:
                        total[i, i:] += (z * z).sum(axis=0)
                        continue
                    parts = [(z >> (LIMB * k)) & (2**LIMB - 1) for k in range(limbs - 1)] + [z >> (LIMB * (limbs - 1))]
                    for a in range(limbs):
                        for b in range(a, limbs):
                            held[a, b, i, i:] += np.einsum("rj,rj->j", parts[a], parts[b])
        if rows:
            yield _reported(total + _carried(held))

    return run


def _carried(held: np.ndarray) -> np.ndarray:
    limbs = len(held)
    return sum(
        held[a, b].astype(object) * ((1 if a == b else 2) << (LIMB * (a + b))) for a in range(limbs) for b in range(a, limbs))


def _reported(total: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(total))
    values = [int(v) for v in total[i, j]]
    parts = [[(v >> (PART * k)) & (2**PART - 1) for v in values] for k in range(3)] + [[v >> (PART * 3) for v in values]]
    return pa.RecordBatch.from_arrays(
        [pa.array(i.astype("int32")), pa.array(j.astype("int32")), *[pa.array(p, pa.int64()) for p in parts]],
        ["i", "j", "p0", "p1", "p2", "p3"])


def _projected(y: np.ndarray, model: Whitening) -> np.ndarray:
    """Projections over the square roots of the eigenvalues; not a number where there is no variance."""
    scale = np.full(len(model.eigenvalues), np.nan)
    scale[:model.rank] = np.sqrt(model.eigenvalues[:model.rank])
    return (y / model.n).astype(float) @ model.axes / scale


def _deviation(y: np.ndarray, reach: int) -> list[int | None]:
    if y.shape[1] * reach**2 < 2**63:
        return np.einsum("ij,ij->i", y, y).tolist()
    exact = (y.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """How far the covariances of the whitened fit list are from the identity, measured on all of it."""
    rank = model.rank
    if not rank:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((rank, rank)), np.zeros(rank)
        for batch in batches:
            w = _projected(_centred(batch.column(0), model), model)[:, :rank]
            products, sums = products + w.T @ w, sums + w.sum(axis=0)
        i, j = np.indices((rank + 1, rank)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32")), pa.array(np.vstack([products, sums]).ravel())], ["i", "j", "total"])

    found = np.zeros((rank + 1, rank))
    for r in distinct.mapInArrow(moments, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        found[r["i"], r["j"]] = r["total"] / model.n
    return float(np.abs(found[:rank] - np.outer(found[rank], found[rank]) - np.eye(rank)).max())
