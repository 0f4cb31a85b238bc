"""Hard negatives against plain loops over exact integers; the query itself also against SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm import hard_negatives
from kinweave.llm.catalog import QUERIES
from kinweave.llm.hard_negatives import Best, Choice, Residues, primes_for


def brute(rows, anchors, positives=5, negatives=5, low=80, high=100):
    data = [(i, label, [math.floor(256 * c) for c in v]) for i, label, v in rows]
    found = []
    for anchor, own, x in data:
        if anchor not in anchors:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i, label) for i, label, y in data if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2] == own][:positives]:
            fit = [s for s in scored if s[2] != own and low * -minus <= 100 * -s[0] <= high * -minus][:negatives]
            found += [(anchor, positive, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(found)


def mined(spark, rows, is_anchor, choice=Choice()):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = hard_negatives.mine(hard_negatives.prepared(df, F.col("label")), is_anchor, choice)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("spread", [0.4, 40.0, 4000.0])
def test_against_brute_force(spark, monkeypatch, spread):
    """Small cells, blocks and tiles, many ties, scores of either sign, from two primes to many."""
    for name, value in (("ANCHOR_BLOCK", 7), ("LEAST_ROWS", 16), ("MOST_ROWS", 64), ("TILE_ANCHORS", 3), ("TILE_ROWS", 5)):
        monkeypatch.setattr(hard_negatives, name, value)
    draw = np.random.default_rng(11)
    base = draw.uniform(-spread, spread, (60, 6))
    rows = [(i, int(draw.integers(0, 3)), [float(c) for c in base[draw.integers(0, 60)] + draw.choice([0, 0.004])]) for i in range(240)]
    anchors = set(range(0, 240, 9))
    assert mined(spark, rows, F.col("_id") % 9 == 0) == brute(rows, anchors)
    assert mined(spark, rows, F.col("_id") % 9 == 0, Choice(2, 3, 50, 90)) == brute(rows, anchors, 2, 3, 50, 90)


@pytest.mark.parametrize("length", [1, 64, 5000])
@pytest.mark.parametrize("reach", [1, 150, 40_000, 2**24])
def test_scores_are_exact(length, reach):
    if length * reach**2 >= 2**59:
        reach = int((2**58 / length) ** 0.5)
    draw = np.random.default_rng(length)
    a, b = (draw.integers(-reach, reach + 1, (n, length)).astype(np.int32) for n in (9, 14))
    a[0], b[0], b[1] = reach, reach, -reach
    bound = length * reach**2
    primes = primes_for(bound, length)
    assert np.prod([float(p) for p in primes]) > 2 * bound
    got = Residues(a, primes).scores(Residues(b, primes), slice(2, None), slice(None))
    want = a.astype(object) @ b.astype(object).T
    assert (got == want[2:]).all()
    assert (Residues(a, primes).scores(Residues(b, primes), slice(0, 1), slice(0, 2)) == want[:1, :2]).all()


def test_best_keeps_the_first():
    best = Best(2, 2)
    best.add(np.array([0, 0, 0]), np.array([5, 7, 5]), np.array([9, 4, 3]))
    best.add(np.array([0, 1]), np.array([5, -3]), np.array([1, 8]))
    assert best.id[0].tolist() == [4, 1] and best.score[0].tolist() == [7, 5]
    assert best.id[1][0] == 8 and best.score[1].tolist() == [-3, hard_negatives.NONE]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.0]), (3, 2, [1.0, 0.0]), (4, 3, [1.0, 1.0])]
    bad = [(None, 1, [1.0, 0.0]), (5, None, [1.0, 0.0]), (6, 1, None), (7, 1, []), (8, 1, [None, 1.0]), (9, 2, [nan, 1.0]),
           (10, 2, [inf, 1.0]), (11, 2, [1.0]), (12, 2, [1e30, 1.0])]
    want = brute(good, {0})
    assert want and mined(spark, good + bad + good, F.col("_id") == 0) == want


def test_clashing_columns(spark):
    rows = [(i, i % 2, [1.0, float(i)]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for name in ("_id", "x", "cell", "is_row", "aims", "_row", "rank", "anchor_id", "_b", "_p"):
        df = df.withColumn(name, F.lit("clash"))
    out = hard_negatives.mine(hard_negatives.prepared(df, F.col("label")), F.col("_id") == 0)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, {0})


def test_no_positive_and_empty(spark, tmp_path):
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])], F.col("_id") == 0) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])], F.col("_id") == 0) == []
    assert mined(spark, [(0, 1, [0.0]), (1, 1, [1.0]), (2, 2, [1.0])], F.col("_id") == 0) == [(0, 1, 1, 2, 0, 0)]
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op13_hard_negatives"](spark, str(tmp_path)).collect() == []
