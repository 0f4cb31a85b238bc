"""Jaro-Winkler similarity, which Spark lacks, as an Arrow-batched UDF.

The batch is worked on as numpy matrices of code points: the loops run over character positions, never over
rows. The common-prefix boost applies only above a Jaro similarity of 0.7.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F


#: Cells of a matrix of code points; pairs are taken in order of length so that short ones are not padded to long ones.
CELLS = 1 << 20


def kernels():
    """``matrix``, ``chunk`` and ``similarities``, which tasks are sent as they are."""
    import numpy as np

    def matrix(texts, pad):
        """Distinct texts as rows of code points, and their lengths."""
        lengths = np.array([len(t) for t in texts], dtype=np.int32)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
        cells = np.full((len(texts), max(lengths.max(initial=0), 1)), pad, dtype=np.int32)
        cells[np.arange(cells.shape[1]) < lengths[:, None]] = points
        return (cells.astype(np.int16) if points.max(initial=0) < 1 << 15 else cells), lengths

    def chunk(a, a_len, b, b_len):
        reach = np.maximum(np.maximum(a_len, b_len) // 2 - 1, 0)
        rows = np.arange(len(a))
        a_hit = np.zeros(a.shape, dtype=bool)
        open_b = np.ones(b.shape, dtype=bool)
        positions = np.arange(b.shape[1], dtype=np.int32)
        for i in range(a.shape[1]):
            # What fills up the rows differs on both sides and is no code point, so it equals nothing.
            free = (b == a[:, i:i + 1]) & open_b & (np.abs(positions - i)[None, :] <= reach[:, None])
            at = free.argmax(axis=1)
            found = free[rows, at]
            a_hit[:, i] = found
            open_b[rows[found], at[found]] = False
        b_hit = ~open_b

        matches = a_hit.sum(axis=1)
        # Line the matched characters of each side up, in order, and count those out of place.
        a_seq = np.take_along_axis(a, np.argsort(~a_hit, axis=1, kind="stable"), axis=1)
        b_seq = np.take_along_axis(b, np.argsort(~b_hit, axis=1, kind="stable"), axis=1)
        width = min(a_seq.shape[1], b_seq.shape[1])
        in_play = np.arange(width)[None, :] < matches[:, None]
        moved = ((a_seq[:, :width] != b_seq[:, :width]) & in_play).sum(axis=1) // 2
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(matches > 0, (matches / a_len + matches / b_len + (matches - moved) / matches) / 3.0, 0.0)
        head = min(4, a.shape[1], b.shape[1])
        same = a[:, :head] == b[:, :head]
        prefix = np.cumprod(same, axis=1).sum(axis=1)
        return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1.0 - jaro), jaro)

    def similarities(a_texts, b_texts, a_of, b_of):
        """Of each two texts, given by their places among the texts of either side."""
        a_len, b_len = (np.array([len(t) for t in texts]) for texts in (a_texts, b_texts))
        longest = np.maximum(np.maximum(a_len[a_of], b_len[b_of]), 1)
        order = np.argsort(longest, kind="stable")
        scores, first = np.empty(len(a_of)), 0
        while first < len(order):
            # The longest text of a run comes last: take as many pairs as fit beside it.
            fits = np.arange(1, len(order) - first + 1) * longest[order[first:]] <= CELLS
            own = order[first:first + max(1, int(fits.argmin()) if not fits.all() else len(fits))]
            used = [np.unique(side[own], return_inverse=True) for side in (a_of, b_of)]
            (a, a_len_), (b, b_len_) = (
                matrix([texts[k] for k in at], pad) for texts, (at, _), pad in ((a_texts, used[0], -1), (b_texts, used[1], -2)))
            (_, i), (_, j) = used
            scores[own] = chunk(a[i], a_len_[i], b[j], b_len_[j])
            first += len(own)
        return scores

    return matrix, chunk, similarities


def _build():
    import numpy as np

    *_, similarities = kernels()

    def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
        """Similarity is computed once for each two values of the batch."""
        out = np.full(len(left), np.nan)
        known = (left.notna() & right.notna()).to_numpy()
        if known.any():
            (a_of, a_texts), (b_of, b_texts) = (pd.factorize(side[known].to_numpy(dtype=object)) for side in (left, right))
            pairs, place = np.unique(a_of * len(b_texts) + b_of, return_inverse=True)
            out[known] = similarities(a_texts, b_texts, *np.divmod(pairs, len(b_texts)))[place]
        return pd.Series(out, index=left.index).astype("Float64")

    return F.pandas_udf(jaro_winkler, "double")


def jaro_winkler(left, right):
    """Similarity in [0, 1] of two text columns; NULL if either is NULL."""
    return _build()(left, right)
