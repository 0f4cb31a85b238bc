"""Hard negatives by exact integer scores in a residue number system.

Entries become whole numbers, ``floor(256 c)``. A score is the inner product of two such vectors. It is computed once for each of a few
small primes, on residues, as a float32 matrix product: residues are so small that every sum on the way is a whole number below 2^24 and
thus exact. Chinese remaindering puts the signed score back together; the primes' product exceeds twice the greatest squared norm, which
bounds every score (Cauchy-Schwarz) and is measured on all rows.

Anchors meet rows in the cells of a grid: a block of anchors by a range of rows. A task reads its cell's anchors first, then streams its
rows past them and keeps a few best per anchor, so its memory does not depend on the number of rows; neither side is broadcast or
collected. Each score is formed twice: once to find the positives, once, with their scores known, to find the negatives below them. The
best of a cell meet in a window over the anchor.

Rows: without an id, a label or a usable vector (null, empty, with a null, NaN or infinite entry, another length than most, or an entry
beyond what keeps scores below 2^59) a row takes no part. Of rows with the same id the one with the least label, then vector, stands for
all; so a repeated row counts once. Ties go by the smaller id. An anchor without positives, or a positive without negatives, has no rows.
An empty table gives an empty result. Other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinweave.llm.scratch import stored
from kinweave.llm.vectors import common_length, matrix, usable, whole

SCALE = 256
#: Scores stay below this, so that five times a score is a long too.
SCORE_LIMIT = 2**59
#: Greatest entry, either way, that is read at all; the length then sets the tighter bound of ``SCORE_LIMIT``.
LARGEST = float(2**29 // SCALE)

#: Anchors whose best a task holds; about 1 KB each.
ANCHOR_BLOCK = 32_768
#: Rows of a cell: few enough to keep every core busy, many enough to send anchors to few cells.
LEAST_ROWS, MOST_ROWS = 2_048, 1_048_576
#: Scores that are held at a time.
TILE_ANCHORS, TILE_ROWS = 1_024, 2_048
#: Dimensions of one matrix product.
TILE_LENGTH = 4_096
NONE = -(2**62)


@dataclass(frozen=True)
class Choice:
    """Positives of an anchor, negatives of a positive, and the percentages of the positive's score a negative's lies between."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def prepared(df: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``_id``, ``label`` and whole numbers ``x`` of every row that takes part, one for each id, in a written table."""
    vector = F.col(vector_col)
    rows = df.filter(F.col(id_col).isNotNull() & label.isNotNull() & usable(vector, LARGEST)).select(
        F.col(id_col).cast("long").alias("_id"), F.struct(label.cast("long").alias("label"), whole(vector, SCALE, "int").alias("x")).alias("_row"))
    found = stored(rows.groupBy("_id").agg(F.min("_row").alias("_row")).select("_id", "_row.label", "_row.x"), "negatives-rows")
    length = common_length(found, "x")
    most = int((SCORE_LIMIT / max(length, 1)) ** 0.5)
    return found.filter((F.size("x") == length) & F.forall("x", lambda c: F.abs(c) <= most))


def mine(rows: DataFrame, is_anchor: Column, choice: Choice = Choice()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    norm = F.aggregate("x", F.lit(0).cast("long"), lambda s, c: s + c.cast("long") * c.cast("long"))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("x")).alias("length"),
        F.max(norm).alias("bound")).first()
    length, primes = facts["length"] or 1, primes_for(facts["bound"] or 0, facts["length"] or 1)
    grid = _Grid(rows, is_anchor, facts["n"], facts["anchors"])

    positives = grid.cells().mapInArrow(
        _best_positives(length, primes, choice), "anchor_id long, positive_id long, positive_score long")
    by_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = positives.withColumn("_n", F.row_number().over(by_anchor)).filter(F.col("_n") <= choice.positives).drop("_n")
    aims = stored(
        positives.groupBy(F.col("anchor_id").alias("_aimed")).agg(
            F.array_sort(F.collect_list(F.struct("positive_id", "positive_score"))).alias("aims")), "negatives-positives")

    negatives = grid.cells(aims).mapInArrow(
        _best_negatives(length, primes, choice),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    by_positive = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return negatives.withColumn("rank", F.row_number().over(by_positive)).filter(F.col("rank") <= choice.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


class _Grid:
    """Blocks of anchors by ranges of rows. A row goes to every block's cell of its range, an anchor to every range's cell of
    its block."""

    def __init__(self, rows: DataFrame, is_anchor: Column, n: int, anchors: int):
        spark = rows.sparkSession
        self.rows, self.is_anchor = rows, is_anchor
        self.blocks = max(1, -(-anchors // ANCHOR_BLOCK))
        wanted = -(-n * self.blocks // (4 * spark.sparkContext.defaultParallelism))
        self.ranges = max(1, -(-n // min(max(wanted, LEAST_ROWS), MOST_ROWS)))

    def cells(self, aims: DataFrame | None = None) -> DataFrame:
        """Cell after cell: ``cell, is_row, _id, label, x, aims``, anchors before rows."""
        none = F.lit(None).cast("array<struct<positive_id:long,positive_score:long>>")
        block = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(self.blocks)).cast("int")
        part = F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(self.ranges)).cast("int")
        anchors = self.rows.filter(self.is_anchor)
        anchors = anchors.withColumn("aims", none) if aims is None else anchors.join(aims, F.col("_id") == F.col("_aimed"))
        every_range = F.explode(F.sequence(F.lit(0), F.lit(self.ranges - 1)))
        every_block = F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1)))
        cell = (F.col("_b") * self.ranges + F.col("_p")).alias("cell")
        both = anchors.select(block.alias("_b"), every_range.alias("_p"), F.lit(False).alias("is_row"), "_id", "label", "x", "aims").unionByName(
            self.rows.select(every_block.alias("_b"), part.alias("_p"), F.lit(True).alias("is_row"), "_id", "label", "x", none.alias("aims")))
        cells = self.blocks * self.ranges
        return both.select(cell, "is_row", "_id", "label", "x", "aims").repartition(cells, "cell").sortWithinPartitions("cell", "is_row")


def primes_for(bound: int, length: int) -> list[int]:
    """The greatest primes whose residues multiply exactly in float32, as many as tell apart all numbers from -bound to bound."""
    half = int((2**24 / min(length, TILE_LENGTH)) ** 0.5)
    found: list[int] = []
    product, p = 1, 2 * half + 1
    while product <= 2 * bound + 1 or not found:
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


class Residues:
    """The rows of an integer matrix modulo each prime, centred at zero."""

    def __init__(self, x: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [_centred(x, p).astype(np.float32) for p in primes]

    def scores(self, other: Residues, rows: slice, others: slice) -> np.ndarray:
        """Exact inner products of some rows with some of the other's, digit by digit in mixed radix."""
        value, base = None, 1
        for p, a, b in zip(self.primes, self.parts, other.parts, strict=True):
            product = self._product(a[rows], b[others], p)
            if value is None:
                value = _centred(product, p).astype(np.int64)
            else:
                value += base * _centred((product - value) % p * pow(base, -1, p), p)
            base *= p
        return value

    @staticmethod
    def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
        cuts = range(0, a.shape[1], TILE_LENGTH)
        parts = [(a[:, c:c + TILE_LENGTH] @ b[:, c:c + TILE_LENGTH].T).astype(np.int32) for c in cuts]
        return parts[0] if len(parts) == 1 else sum(part % p for part in parts)


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """The residue nearest to zero; exact for the odd primes used here."""
    return (x + p // 2) % p - p // 2


class Best:
    """The few best of each of many lists: greatest score first, then least id."""

    def __init__(self, lists: int, most: int):
        self.most = most
        self.score = np.full((lists, most), NONE)
        self.id = np.full((lists, most), np.iinfo(np.int64).max)

    @property
    def entry(self) -> np.ndarray:
        """The score below which nothing enters a list any more."""
        return self.score[:, -1]

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        lists = np.unique(at)
        if not len(lists):
            return
        at = np.concatenate([np.repeat(lists, self.most), at])
        score = np.concatenate([self.score[lists].ravel(), score])
        ids = np.concatenate([self.id[lists].ravel(), ids])
        order = np.lexsort((ids, -score, at))
        first = np.searchsorted(at[order], lists)
        chosen = order[first[:, None] + np.arange(self.most)]
        self.score[lists], self.id[lists] = score[chosen], ids[chosen]


class _Anchors:
    """The anchors of a cell."""

    def __init__(self, batches: list[pa.RecordBatch], length: int, primes: list[int]):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.ids = table["_id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.residues = Residues(matrix(table["x"].combine_chunks(), length), primes)
        self.aims = table["aims"]


def _stream(batches: Iterator[pa.RecordBatch], length: int, primes: list[int], begin, past, end) -> Iterator[pa.RecordBatch]:
    """Walks over cells: ``begin(anchors)`` makes the state of a cell, ``past(state, ids, labels, scores, tile)`` takes in the
    scores of some anchors with some rows, ``end(state)`` gives a cell's result."""
    cell, heads, state = None, [], None
    for batch in batches:
        cells = batch.column(0).to_numpy()
        is_row = batch.column(1).to_numpy(zero_copy_only=False)
        turns = np.flatnonzero((np.diff(cells) != 0) | (np.diff(is_row.astype(np.int8)) != 0)) + 1
        for lo, hi in zip([0, *turns], [*turns, len(cells)], strict=True):
            if lo == hi:
                continue
            if cells[lo] != cell:
                if state is not None:
                    yield end(state)
                cell, heads, state = cells[lo], [], None
            part = batch.slice(lo, hi - lo)
            if not is_row[lo]:
                heads.append(part)
                continue
            if not heads:
                continue
            if state is None:
                state = begin(_Anchors(heads, length, primes))
            ids, labels = part.column(2).to_numpy(), part.column(3).to_numpy()
            residues = Residues(matrix(part.column(4), length), primes)
            anchors = state[0]
            for r in range(0, len(ids), TILE_ROWS):
                rows = slice(r, r + TILE_ROWS)
                for a in range(0, len(anchors.ids), TILE_ANCHORS):
                    tile = slice(a, a + TILE_ANCHORS)
                    past(state, ids[rows], labels[rows], anchors.residues.scores(residues, tile, rows), tile)
    if state is not None:
        yield end(state)


def _best_positives(length: int, primes: list[int], choice: Choice):
    def begin(anchors: _Anchors):
        return anchors, Best(len(anchors.ids), choice.positives)

    def past(state, ids, labels, scores, tile) -> None:
        anchors, best = state
        allowed = (anchors.labels[tile, None] == labels) & (anchors.ids[tile, None] != ids) & (scores >= best.entry[tile, None])
        at, row = np.nonzero(allowed)
        best.add(at + tile.start, scores[at, row], ids[row])

    def end(state) -> pa.RecordBatch:
        anchors, best = state
        at, k = np.nonzero(best.score > NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors.ids[at]), pa.array(best.id[at, k]), pa.array(best.score[at, k])],
            ["anchor_id", "positive_id", "positive_score"])

    return lambda batches: _stream(batches, length, primes, begin, past, end)


def _best_negatives(length: int, primes: list[int], choice: Choice):
    most = choice.positives

    def begin(anchors: _Anchors):
        n = len(anchors.ids)
        # A list for each anchor and positive; those that are missing accept nothing.
        positive, cap, floor = np.zeros((n, most), np.int64), np.full((n, most), NONE), np.full((n, most), -NONE)
        for i, aims in enumerate(anchors.aims.to_pylist()):
            for j, aim in enumerate(aims):
                s = aim["positive_score"]
                positive[i, j], cap[i, j], floor[i, j] = aim["positive_id"], choice.high * s // 100, -(-choice.low * s // 100)
        scores = np.array([[a["positive_score"] for a in aims] + [0] * (most - len(aims)) for aims in anchors.aims.to_pylist()])
        return anchors, Best(n * most, choice.negatives), positive, cap, floor, scores

    def past(state, ids, labels, scores, tile) -> None:
        anchors, best, _, cap, floor, _ = state
        other = anchors.labels[tile, None] != labels
        entry = np.maximum(floor, best.entry.reshape(-1, most))[tile]
        for j in range(most):
            at, row = np.nonzero(other & (scores <= cap[tile, j, None]) & (scores >= entry[:, j, None]))
            best.add((at + tile.start) * most + j, scores[at, row], ids[row])

    def end(state) -> pa.RecordBatch:
        anchors, best, positive, _, _, scores = state
        at, k = np.nonzero(best.score > NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors.ids[at // most]), pa.array(positive.ravel()[at]), pa.array(scores.ravel()[at]), pa.array(best.id[at, k]),
             pa.array(best.score[at, k])],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return lambda batches: _stream(batches, length, primes, begin, past, end)
