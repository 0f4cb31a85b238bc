"""Whitening against numpy on whole vectors and exact Python integers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm import whitening
from kinweave.llm.catalog import QUERIES

from tests.conftest import SF


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def expected(vectors):
    """n, sums, covariance and explained shares of the distinct vectors, in exact fractions until the last step."""
    fit = sorted({tuple(whole(v)) for v in vectors})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[n * c - s for c, s in zip(x, sums, strict=True)] for x in fit], dtype=object)
    exact = y.T @ y
    cov = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in exact])
    return n, sums, cov


def test_query_against_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, sums, cov = expected([r["embedding"] for r in rows])
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    got = {}
    for r in QUERIES["op12_whitening"](spark, SF).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == {r["vec_id"] for r in rows}
    signs = None
    for r in rows:
        mine = got[r["vec_id"]]
        assert sorted(mine) == list(range(1, 17))
        x = whole(r["embedding"])
        want = (np.array([n * c - s for c, s in zip(x, sums, strict=True)], dtype=float) / n) @ axes[:, :16] / np.sqrt(e[:16])
        have = np.array([mine[k]["whitened"] for k in range(1, 17)])
        signs = np.sign(want * have) if signs is None else signs
        assert np.allclose(have, signs * want, rtol=1e-9, atol=1e-9)
        for k, m in mine.items():
            assert m["n"] == n and m["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
            assert m["explained"] == pytest.approx(e[k - 1] / np.trace(cov), rel=1e-9)
    errors = {m["identity_error"] for mine in got.values() for m in mine.values()}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_covariances_are_exact_for_wide_entries(spark):
    """Entries near the limit: the sums of squares need unbounded integers."""
    draw = np.random.default_rng(3)
    vectors = [[float(v) for v in draw.uniform(-2.0**33, 2.0**33, 3)] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    model = whitening.fit(whitening.quantised(df))
    n, sums, cov = expected(vectors)
    assert model.n == n and list(model.sums) == sums
    assert np.allclose(model.eigenvalues, np.linalg.eigvalsh(cov)[::-1], rtol=1e-10)
    y = np.array([[n * c - s for c, s in zip(whole(v), sums, strict=True)] for v in vectors], dtype=object)
    for limit, reach in ((2**62, 2**61), (2**40, 2**39)):
        assert whitening._centre(np.array([whole(v) for v in vectors]), n, sums, reach).dtype == (object if limit == 2**62 else np.int64)
    totals = next(whitening._squares(n, tuple(sums), 2**61)(iter([_batch(vectors)])))
    want = [sum(int(r[i] if i == j else r[i] + r[j]) ** 2 for r in y) for i in range(3) for j in range(i, 3)]
    assert [whitening._joined(r) for r in totals.to_pylist()] == want


def test_limbs_carry(spark, monkeypatch):
    """Sums of squares by limbs, with a carry after every few rows, equal unbounded integers."""
    monkeypatch.setattr(whitening, "CARRY", 16)
    monkeypatch.setattr(whitening, "BLOCK", 8)
    draw = np.random.default_rng(5)
    for spread in (1.0, 2.0**20, 2.0**28):
        vectors = draw.uniform(-spread, spread, (50, 4)).tolist()
        xs = [whole(v) for v in vectors]
        n, sums = len(xs), [sum(c) for c in zip(*xs, strict=True)]
        y = [[n * c - s for c, s in zip(x, sums, strict=True)] for x in xs]
        reach = max(abs(c) for row in y for c in row)
        totals = next(whitening._squares(n, tuple(sums), reach)(iter([_batch(vectors)])))
        want = [sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in y) for i in range(4) for j in range(i, 4)]
        assert [whitening._joined(r) for r in totals.to_pylist()] == want


def _batch(vectors):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([whole(v) for v in vectors], pa.list_(pa.int64()))], ["x"])


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1, [0.0, 1.0], "a"), (2, [1.0, 0.0], "b"), (2, [1.0, 0.0], "c"), (None, [1.0, 1.0], "d"), (4, None, "e"), (5, [], "f"),
         (6, [None, 1.0], "g"), (7, [nan, 1.0], "h"), (8, [inf, 1.0], "i"), (9, [-inf, 1.0], "j"), (10, [1.0], "k"), (11, [1e30, 1.0], "l")],
        "vec_id long, embedding array<float>, x string").withColumn("_id", F.lit("clash")).withColumn("whitened", F.lit(1))
    vectors = whitening.quantised(df)
    model = whitening.fit(vectors)
    assert model.n == 3 and model.rank == 2 and model.identity_error < 1e-9
    got = whitening.whiten(vectors, model).collect()
    assert sorted((r["_id"] for r in got), key=str) == [1, 2, 2, None]
    assert len({tuple(r["whitened"]) for r in got if r["_id"] == 2}) == 1


@pytest.mark.parametrize("vectors", [[], [[0.5, 0.25]], [[0.5, 0.25]] * 3, [[0.0, 1.0], [1.0, 1.0]]])
def test_without_variance(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    found = whitening.quantised(df)
    model = whitening.fit(found)
    got = whitening.whiten(found, model).collect()
    assert len(got) == len(vectors)
    if vectors:
        rank = len({tuple(v) for v in vectors}) - 1
        assert model.rank == rank
        assert all([v is None for v in r["whitened"]] == [k >= rank for k in range(2)] for r in got)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op12_whitening"](spark, str(tmp_path)).collect() == []


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(120)
    models = [whitening.fit(whitening.quantised(df.repartition(k))) for k in (1, 7)]
    assert models[0].sums == models[1].sums and np.array_equal(models[0].axes, models[1].axes)
