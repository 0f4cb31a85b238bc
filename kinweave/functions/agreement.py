"""Levels of agreement of every lead of a list with every person of another, as an Arrow UDF.

People go to Python once for each tile of a block, and a number of two bytes comes back for each pair. All similarities of a tile are found
together: matched characters are bits of a word, and the loops run over character positions. A character is matched as in
:mod:`kinweave.functions.similarity`, so the levels are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.functions.similarity import kernels

#: Texts of more code points than this are compared pair by pair, as are tiles of few pairs.
BITS = 64
FEW_PAIRS = 256
#: Values that meet: up to so many in a batch, they are all compared at once. Pairs compared one by one at a time.
ALL_PAIRS = 1 << 14
AT_ONCE = 1 << 18
#: Tables of levels by lengths that a task keeps, and the cells of each at most.
TABLES, TABLE_CELLS = 64, 1 << 19


def pattern(levels: Sequence[int]) -> int:
    """The number of a pattern of levels, each from -1 to 3: three bits for each, at most five."""
    number = 0
    for level in levels:
        number = 8 * number + level + 1
    return number


def pattern_level(number: str, place: int, fields: int) -> str:
    """The level at ``place`` of a pattern, as SQL."""
    return f"(shiftright(CAST({number} AS INT), {3 * (fields - 1 - place)}) & 7) - 1"


def _build(fields: int, close: float, near: float):
    import numpy as np

    matrix, _, similarities = kernels()

    def graded(score):
        return np.where(score >= close, np.int8(2), np.where(score >= near, np.int8(1), np.int8(0)))

    tables = {}

    def table(a_lens, b_lens):
        """Levels by the places of two lengths, matched characters, those out of place, and the common prefix."""
        if (key := (*a_lens, -1, *b_lens)) not in tables:
            if len(tables) >= TABLES:
                tables.clear()
            most = max(a_lens[-1], b_lens[-1])
            matches, moved, prefix = np.ogrid[:most + 1, :most // 2 + 1, :5]
            tables[key] = np.stack([
                graded(jaro_winkler(matches, max(x, 1), max(y, 1), moved, prefix)) for x in a_lens for y in b_lens])
        return tables[key]

    def jaro_winkler(matches, a_len, b_len, moved, prefix):
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(matches > 0, (matches / a_len + matches / b_len + (matches - moved) / matches) / 3.0, 0.0)
        return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1.0 - jaro), jaro)

    def crossed(a, a_len, b, b_len, kind):
        """Levels of each row of ``a`` with each of ``b``, neither of more than ``kind`` has bits."""
        width = int(a_len.max(initial=0))
        a, rows, columns = a[:, :max(width, 1)], len(a), len(b)
        chars, idx = np.unique(a, return_inverse=True)
        idx = np.ascontiguousarray(idx.reshape(a.shape).T)
        at = np.searchsorted(chars, b).clip(0, len(chars) - 1)
        known = (chars[at] == b) & (np.arange(b.shape[1]) < b_len[:, None])
        at = np.where(known, at, len(chars))
        places = np.zeros((len(chars) + 1, columns), dtype=kind)
        every = np.arange(columns)
        for j in range(int(b_len.max(initial=0))):
            places[at[:, j], every] |= kind(1 << j)
        places[len(chars)] = 0

        # What all texts begin with is matched with itself.
        alike, head = 0, a[0]
        most = int(min(a_len.min(), b_len.min()))
        while alike < most and (a[:, alike] == head[alike]).all() and (b[:, alike] == head[alike]).all():
            alike += 1
        (a_lens, a_at), (b_lens, b_at) = (np.unique(lens, return_inverse=True) for lens in (a_len, b_len))
        reaches = np.maximum(np.maximum(a_lens[:, None], b_lens[None, :]) // 2 - 1, 0)
        constant = int(reaches.flat[0]) if (reaches == reaches.flat[0]).all() else None
        top = (1 << np.dtype(kind).itemsize * 8) - 1
        shape = (rows, columns)
        free = np.full(shape, top - ((1 << alike) - 1), dtype=kind)
        spot, low = np.empty(shape, dtype=kind), np.empty(shape, dtype=kind)
        hits = np.empty((max(width, 1), *shape), dtype=bool)
        matches = np.full(shape, alike, dtype=np.uint8)
        if constant is None:
            # Positions in reach of the first character that is sought.
            first = np.array([((1 << alike + int(r) + 1) - (1 << max(alike - int(r), 0))) & top for r in reaches.flat], dtype=kind)
            window = first.reshape(reaches.shape)[a_at][:, b_at]
            reach = reaches.astype(np.uint8)[a_at][:, b_at]
            entered = np.empty(shape, dtype=bool)
        for i in range(alike, width):
            np.take(places, idx[i], axis=0, out=spot)
            spot &= free
            if constant is None:
                spot &= window
                window <<= kind(1)
                if i < reaches.min():
                    window |= kind(1)
                elif i < reaches.max():
                    window |= np.greater(reach, i, out=entered)
            else:
                spot &= kind(((1 << i + constant + 1) - (1 << max(i - constant, 0))) & top)
            np.negative(spot, out=low)
            low &= spot
            free ^= low
            np.not_equal(low, 0, out=hits[i])
            matches += hits[i].view(np.uint8)

        head = min(4, a.shape[1], b.shape[1])
        prefix = np.full(shape, min(alike, head), dtype=np.uint8)
        if alike < head:
            same = np.ones(shape, dtype=bool)
            for i in range(alike, head):
                same &= (a[:, i, None] == b[None, :, i]) & (i < a_len)[:, None] & (i < b_len)[None, :]
                prefix += same.view(np.uint8)
        longest = int(max(a_lens[-1], b_lens[-1]))
        by_matches = (longest // 2 + 1) * 5
        cells = (longest + 1) * by_matches
        if cells * reaches.size <= TABLE_CELLS:
            flat = table(a_lens.tolist(), b_lens.tolist()).ravel()
            begin = (np.arange(reaches.size, dtype=np.int32) * cells).reshape(reaches.shape)[a_at][:, b_at]
            begin += matches.astype(np.int32) * np.int32(by_matches)
            begin += prefix

            def level(moved, at=...):
                return flat.take(begin[at] + moved * np.int32(5))
        else:
            a_n, b_n = (np.broadcast_to(n, shape) for n in (a_len[:, None].astype(np.int64), b_len[None, :].astype(np.int64)))

            def level(moved, at=...):
                return graded(jaro_winkler(matches[at].astype(np.int64), a_n[at], b_n[at], moved, prefix[at].astype(np.int64)))
        levels = level(np.zeros((), dtype=np.int32))
        open_ = levels != level(((matches - np.uint8(alike)) >> np.uint8(1)).astype(np.int32))
        open_ &= levels > 0
        at = np.flatnonzero(open_)
        if not len(at):
            return levels
        # Matched characters are lined up, and those out of place are counted, where that makes a difference.
        taken = ~free
        taken &= kind(top - ((1 << alike) - 1))
        one_by_one = len(at) * 3 < open_.size
        if one_by_one:
            row, column = np.divmod(at, columns)
            taken = taken.ravel()[at]
            spot, low = np.empty(len(at), dtype=kind), np.empty(len(at), dtype=kind)
            flat_places = places.ravel()
        moved = np.zeros(taken.shape, dtype=np.uint8)
        for i in range(alike, width):
            hit = hits[i].ravel()[at] if one_by_one else hits[i]
            np.negative(taken, out=low)
            low &= taken
            low *= hit
            taken ^= low
            if one_by_one:
                flat_places.take((idx[i] * columns)[row] + column, out=spot)
            else:
                np.take(places, idx[i], axis=0, out=spot)
            spot &= low
            moved += (hit > (spot != 0)).view(np.uint8)
        moved >>= np.uint8(1)
        if one_by_one:
            levels.ravel()[at] = level(moved.astype(np.int32), np.unravel_index(at, shape))
            return levels
        return level(moved.astype(np.int32))

    class Values:
        """The values of a field in a batch: each distinct text has a number, unknown ones have -1."""

        def __init__(self, leads, persons):
            coded = pa.concat_arrays([leads, persons]).dictionary_encode()
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            self.lead, self.person = codes[:len(leads)], codes[len(leads):]
            self.texts = coded.dictionary.to_pylist()
            self.met = None

        def prepare(self, pairs):
            """If few values meet often, all of them are compared now."""
            self.points, self.sizes = matrix([t if len(t) <= BITS else "" for t in self.texts], -1)
            self.long = np.array([len(t) > BITS for t in self.texts], dtype=bool)
            leads, persons = (np.unique(c[c >= 0]) for c in (self.lead, self.person))
            if 0 < len(leads) * len(persons) <= min(ALL_PAIRS, pairs):
                place = [np.full(len(self.texts) + 1, -1, dtype=np.int64) for _ in range(2)]
                for at, codes in zip(place, (leads, persons)):
                    at[codes] = np.arange(len(codes))
                self.met = (*place, np.pad(self.distinct(leads, persons), ((0, 1), (0, 1)), constant_values=-1))

        def distinct(self, a, b):
            """Levels of the distinct codes ``a`` with ``b``."""
            a_long, b_long = self.long[a], self.long[b]
            if a_long.any() or b_long.any():
                out = np.empty((len(a), len(b)), dtype=np.int8)
                if not a_long.all() and not b_long.all():
                    out[np.ix_(~a_long, ~b_long)] = self.short(a[~a_long], b[~b_long])
                i, j = np.nonzero(a_long[:, None] | b_long[None, :])
                out[i, j] = graded(similarities(self.texts, self.texts, a[i], b[j]))
            else:
                out = self.short(a, b)
            _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            out[i, j] = 3
            return out

        def short(self, a, b):
            a_len, b_len = self.sizes[a], self.sizes[b]
            longest = int(max(a_len.max(), b_len.max()))
            kind = np.uint16 if longest <= 16 else np.uint32 if longest <= 32 else np.uint64
            return crossed(self.points[a, :max(longest, 1)], a_len, self.points[b, :max(longest, 1)], b_len, kind)

        def tile(self, leads, persons):
            """Levels of the leads at a slice with the persons at a slice."""
            a, b = self.lead[leads], self.person[persons]
            if self.met:
                a_at, b_at, levels = self.met
                return levels.take(a_at[a], 0).take(b_at[b], 1)
            (x, i), (y, j) = (np.unique(c, return_inverse=True) for c in (a, b))
            if len(x) == len(a) and len(y) == len(b) and x[0] >= 0 and y[0] >= 0:
                return self.distinct(a, b)
            levels = np.full((len(x), len(y)), -1, dtype=np.int8)
            first, second = int(x[0] < 0), int(y[0] < 0)
            if len(x) > first and len(y) > second:
                levels[first:, second:] = self.distinct(x[first:], y[second:])
            return levels.take(i, 0).take(j, 1)

        def single(self, leads, persons):
            """Levels of pairs, given by the place of each in the batch."""
            a, b = self.lead[leads], self.person[persons]
            levels = np.where((a < 0) | (b < 0), np.int8(-1), np.int8(3))
            asked = np.flatnonzero((a >= 0) & (b >= 0) & (a != b))
            if len(asked):
                met, place = np.unique(a[asked] * len(self.texts) + b[asked], return_inverse=True)
                levels[asked] = graded(similarities(self.texts, self.texts, *np.divmod(met, len(self.texts))))[place]
            return levels

    def numbered(levels, shape):
        number = np.zeros(shape, dtype=np.int16)
        for level in levels:
            number <<= np.int16(3)
            number += level
            number += np.int16(1)
        return number

    def patterns(leads: pa.Array, persons: pa.Array, leg: pa.Array) -> pa.Array:
        n, m = (side.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for side in (leads, persons))
        legs = leg.to_numpy(zero_copy_only=False)
        own, other = leads.flatten(), persons.flatten()
        columns = [Values(own.field(k), other.field(k)) for k in range(own.type.num_fields)]
        compared, keys = columns[:fields], columns[fields:]
        for column in compared:
            column.prepare(int((n * m).sum()))
        lead_at, person_at, out_at = (np.concatenate([[0], np.cumsum(sizes)]) for sizes in (n, m, n * m))
        out = np.empty(out_at[-1], dtype=np.int16)
        few = n * m < FEW_PAIRS
        for t in np.flatnonzero(~few):
            rows, others = slice(lead_at[t], lead_at[t + 1]), slice(person_at[t], person_at[t + 1])
            number = numbered((c.tile(rows, others) for c in compared), (n[t], m[t]))
            for key in keys[:legs[t]]:
                a = key.lead[rows]
                number[(a[:, None] == key.person[others][None, :]) & (a >= 0)[:, None]] = -1
            out[out_at[t]:out_at[t + 1]] = number.ravel()
        small = np.flatnonzero(few & (n * m > 0))
        ends = np.cumsum((n * m)[small])
        done = 0
        while done < len(small):
            # As many small tiles as hold a bounded number of pairs.
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + AT_ONCE, side="right")))
            tiles = small[done:upto]
            sizes = (n * m)[tiles]
            tile = np.repeat(tiles, sizes)
            within = np.arange(len(tile)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            row, column = np.divmod(within, m[tile])
            a, b = lead_at[tile] + row, person_at[tile] + column
            number = numbered((c.single(a, b) for c in compared), len(tile))
            for k, key in enumerate(keys):
                number[(key.lead[a] == key.person[b]) & (key.lead[a] >= 0) & (legs[tile] > k)] = -1
            out[out_at[tile] + within] = number
            done = upto
        return pa.ListArray.from_arrays(pa.array(out_at, pa.int32()), pa.array(out))

    return F.arrow_udf(patterns, "array<smallint>")


def patterns(leads: Column, persons: Column, leg: Column, fields: int, close: float, near: float) -> Column:
    """For every lead of a list, and every person of another, the pattern of their levels, lead by lead; -1 for a pair that an earlier leg has.

    Both are arrays of structs: the compared ``fields`` first, then the keys of the legs; ``leg`` is the leg that the lists agree on.
    """
    return _build(fields, close, near)(leads, persons, leg)
