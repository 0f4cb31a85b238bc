"""Best-fit packing of tokenised documents into sequences of fixed size.

The plan is made on counts by length, a table no longer than a sequence, whatever the number of documents: best fit,
longest first, places runs of equal lengths into runs of equally filled sequences. Documents then take the planned
slots by their rank within their length. Ranks are counted while a slice is tokenised, so no task holds a length.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.scratch import stored
from kinweave.llm.units import IdEncoder, encoder

#: Token that ends a document.
END_ID = 0
_BATCH_BYTES = 1 << 23


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    ranks: dict[int, int] = defaultdict(int)
    slice_id = TaskContext.get().partitionId()
    end = np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        rows: list[tuple] = []
        owners, held = [], 0
        for i, ids in enumerate(encoder(IdEncoder, tokenizer).encode(batch.column(1).fill_null("").to_pylist())):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                own = ids[at:at + 4 * size]
                n = len(own) // 4
                rows.append((piece, at // 4, n, own, slice_id, ranks[n]))
                owners.append(i)
                ranks[n] += 1
                held += len(own)
            if held >= _BATCH_BYTES:
                yield _batch(batch.column(0), owners, rows, schema)
                rows, owners, held = [], [], 0
        yield _batch(batch.column(0), owners, rows, schema)


def _batch(ids: pa.Array, owners: list[int], rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * (len(schema) - 1)
    made = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(owners, pa.int64())), *made], schema=schema)


def pieces(
    docs: DataFrame, tokenizer: str, size: int, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``_id, piece, start, length, ids, slice, place`` for each row of ``docs``, tokenised and closed with ``END_ID``.

    ``ids`` holds little-endian unsigned 32-bit numbers. A longer document is cut into pieces of ``size`` tokens, the last
    may be shorter. ``place`` counts the pieces of a length within a slice. Null and empty texts are the end token alone.
    Write the result before using it twice: slices are those of the tasks that wrote it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = {
        "piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids": T.BinaryType(),
        "slice": T.LongType(), "place": T.LongType()}
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_column].dataType), *(T.StructField(n, k) for n, k in kinds.items())])
    arrow = to_arrow_schema(schema)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return rows.mapInArrow(lambda batches: _pieces(batches, tokenizer, size, arrow), schema)


@dataclass(frozen=True)
class Slots:
    """Pieces of ``length`` with ranks from ``first_rank`` to before ``end_rank`` go, ``each`` at a time, into the
    sequences from ``first_sequence`` on, behind ``offset`` tokens."""

    length: int
    first_rank: int
    end_rank: int
    first_sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], size: int) -> list[Slots]:
    """Best fit, longest first, for ``counts`` pieces of each length: the fullest sequence with room comes first."""
    out: list[Slots] = []
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    n_sequences = 0

    def give(room: int, first: int, end: int) -> None:
        if room and end > first:
            if room not in free:
                bisect.insort(rooms, room)
            free.setdefault(room, []).append((first, end))

    for length in sorted(counts, reverse=True):
        rank, count = 0, counts[length]
        while rank < count:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else size
            each = room // length
            wanted = -(-(count - rank) // each)
            if at < len(rooms):
                first, end = free[room].pop()
                if end - first > wanted:
                    free[room].append((first + wanted, end))
                    end = first + wanted
                if not free[room]:
                    del free[room], rooms[at]
            else:
                first, end = n_sequences, n_sequences + wanted
                n_sequences = end
            placed = min(count - rank, (end - first) * each)
            out.append(Slots(length, rank, rank + placed, first, each, size - room))
            full, over = divmod(placed, each)
            give(room - each * length, first, first + full)
            if over:
                give(room - over * length, first + full, first + full + 1)
            rank += placed
    return out


def pack(cut: DataFrame, size: int) -> DataFrame:
    """``cut``, written :func:`pieces` without their ids, with ``sequence_id`` and ``offset`` for each row.

    Sequences hold at most ``size`` tokens without gaps. The driver sees one count per length, never a piece.
    """
    counted = stored(cut.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("_n")), "packing-counts")
    totals = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = plan(totals, size)
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select(
        F.col("length").alias("_length"), F.col("slice").alias("_slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = cut.join(bases, (F.col("length") == F.col("_length")) & (F.col("slice") == F.col("_slice"))).withColumn(
        "_rank", F.col("_base") + F.col("place")).drop("_length", "_slice")
    schema = "_length long, _first long, _end long, _sequence long, _each long, _offset long"
    rows = [(s.length, s.first_rank, s.end_rank, s.first_sequence, s.each, s.offset) for s in slots]
    # At most a few rows for each length: small whatever the input.
    known = F.broadcast(cut.sparkSession.createDataFrame(rows, schema))
    taken = ranked.join(
        known, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
    turn = F.col("_rank") - F.col("_first")
    return taken.select(
        *cut.columns, (F.col("_sequence") + F.expr("(_rank - _first) DIV _each")).alias("sequence_id"),
        (F.col("_offset") + turn % F.col("_each") * F.col("length")).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, documents``: the tokens of each sequence in place; ``packed`` must carry the ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "_id", "piece")))
    return packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.aggregate("_parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
        F.transform("_parts", lambda p: F.struct(p["_id"].alias("id"), p["piece"].alias("piece"), p["offset"].alias("offset")))
        .alias("documents"))
