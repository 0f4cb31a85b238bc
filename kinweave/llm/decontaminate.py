"""Passages of a benchmark in documents: word windows of the items against word windows of every text.

The windows of the items are a hash set of checked size, broadcast; a larger benchmark is taken block by block. A
window found by its hash is compared word by word before it counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm import wordhash
from kinweave.llm.names import free
from kinweave.llm.wordhash import ALPHANUMERIC, Words

WINDOW_WORDS = 13
#: Windows broadcast at a time, each of a few hundred bytes at most.
BLOCK_WINDOWS = 200_000
#: A document is contaminated if one word in so many is hit.
ONE_IN = 20

_SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("first_word", "end_word", "first_byte", "end_byte")])
_WINDOWS = "size int, hash long, words binary, item string"


@dataclass
class _Block:
    """Windows of one size: a table of hash bits that rules out most, sorted hashes, and words with their items."""

    size: int
    hashes: np.ndarray
    bits: np.ndarray
    items: dict[bytes, list[str]]

    @staticmethod
    def of(size: int, rows: list) -> _Block:
        items: dict[bytes, set[str]] = defaultdict(set)
        for r in rows:
            items[bytes(r["words"])].add(r["item"])
        hashes = np.unique(np.array([r["hash"] for r in rows], np.int64).view(np.uint64))
        bits = np.zeros(1 << 20, bool)
        bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
        return _Block(size, hashes, bits, {k: sorted(v) for k, v in items.items()})

    def find(self, hashes: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        return maybe[self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes[maybe]]


def _phrase(words: Words, first: int, n: int) -> bytes:
    return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[first:first + n], words.ends[first:first + n]))


def _item_windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = wordhash.text_bytes(batch.column(1))
        words = Words(data, bounds, ALPHANUMERIC)
        hashes = words.hashes()
        out: list[tuple] = []
        for i, item in enumerate(batch.column(0).to_pylist()):
            a, b = int(words.of_text[i]), int(words.of_text[i + 1])
            n = min(size, b - a)
            if n:
                found, at = wordhash.windows(hashes[a:b], np.array([0, b - a]), n)
                out += [(n, int(h), _phrase(words, a + int(k), n), item) for h, k in zip(found.view(np.int64), at, strict=True)]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["size", "hash", "words", "item"])


def item_windows(
    benchmark: DataFrame, size: int = WINDOW_WORDS, id_column: str = "item_id", text_column: str = "text",
) -> DataFrame:
    """``size, hash, words, item``: the distinct windows of each item; of a shorter one the whole, of an empty one none.

    Words are runs of ASCII letters and digits and anything beyond ASCII, A-Z in lower case. A null id becomes ``''``.
    """
    item = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    rows = benchmark.select(item.alias("item"), F.col(text_column).alias("_text"))
    return rows.mapInArrow(lambda batches: _item_windows(batches, size), _WINDOWS).distinct()


def _scan(batches: Iterator[pa.RecordBatch], blocks: list[_Block], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = wordhash.text_bytes(batch.column(1))
        n_words, spans, items = [], [], []
        for i, j in wordhash.chunks(bounds):
            words = Words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], ALPHANUMERIC)
            hashes = words.hashes()
            hits: list[tuple[int, int]] = []
            found: dict[int, set[str]] = defaultdict(set)
            for block in blocks:
                windows, at = wordhash.windows(hashes, words.of_text, block.size)
                for first in at[block.find(windows)].tolist():
                    if known := block.items.get(_phrase(words, first, block.size)):
                        hits.append((first, first + block.size))
                        text = int(np.searchsorted(words.of_text, first, side="right")) - 1
                        found[text].update(known)
            n_words += np.diff(words.of_text).tolist()
            own: dict[int, list[dict]] = defaultdict(list)
            for first, end in _merged(hits, words.of_text):
                text = int(np.searchsorted(words.of_text, first, side="right")) - 1
                base, start = int(words.of_text[text]), int(words.bounds[text])
                own[text].append({
                    "first_word": first - base, "end_word": end - base, "first_byte": int(words.starts[first]) - start,
                    "end_byte": int(words.ends[end - 1]) - start})
            spans += [own.get(k, []) for k in range(j - i)]
            items += [sorted(found.get(k, ())) for k in range(j - i)]
        columns = (batch.column(0), n_words, spans, items)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(
            columns, schema, strict=True)], schema=schema)


def _merged(hits: list[tuple[int, int]], of_text: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching runs of words of one text made one."""
    limits = set(of_text.tolist())
    out: list[tuple[int, int]] = []
    for first, end in sorted(set(hits)):
        if out and first <= out[-1][1] and not (first == out[-1][1] and first in limits):
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _found_in(docs: DataFrame, rows: list) -> DataFrame:
    """``_id, n_words, spans, items`` of each row of (``_id``, ``_text``) for one block of windows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    by_size: dict[int, list] = defaultdict(list)
    for r in rows:
        by_size[r["size"]].append(r)
    held = docs.sparkSession.sparkContext.broadcast([_Block.of(n, own) for n, own in sorted(by_size.items())])
    schema = T.StructType([
        T.StructField("_id", docs.schema["_id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("items", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)
    return docs.mapInArrow(lambda batches: _scan(batches, held.value, arrow), schema)


def contamination(
    docs: DataFrame, windows: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``id_column, n_words, n_hit, n_items, items, spans, contaminated`` for each row of ``docs``.

    ``windows`` comes from :func:`item_windows`, best written before. A word inside any occurrence of a window is hit;
    ``spans`` has the merged runs of hit words with their places in words and in UTF-8 bytes, ``items`` the sorted ids of
    the items. Contaminated: some word is hit, and at least one in ``ONE_IN``. Null and empty texts have no words.
    Rows that repeat are judged each; without windows nothing is hit; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    n_blocks = max(1, -(-windows.count() // block_windows))
    if n_blocks == 1:
        found = _found_in(rows, windows.collect())
    else:
        found = _by_blocks(rows, windows, n_blocks)
    hit = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["end_word"] - F.greatest(s["first_word"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], s["end_word"]).alias("upto")),
        lambda a: a["n"])
    counted = found.withColumn("n_hit", hit).withColumn("items", F.array_sort(F.array_distinct("items")))
    return counted.select(
        F.col("_id").alias(id_column), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
        ((F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def _by_blocks(rows: DataFrame, windows: DataFrame, n_blocks: int) -> DataFrame:
    """One scan per block of windows, by hash; the findings of equal rows are put together."""
    keyed = rows.select(F.struct("_id", F.md5(F.coalesce("_text", F.lit(""))).alias("same")).alias("_id"), "_text")
    block = F.pmod(F.col("hash"), F.lit(n_blocks))
    parts = [_found_in(keyed, windows.filter(block == i).collect()) for i in range(n_blocks)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = union.groupBy("_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
        F.flatten(F.collect_set("items")).alias("items"), (F.count(F.lit(1)) / n_blocks).cast("int").alias("_copies"))
    return merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        F.col("_id._id").alias("_id"), "n_words", "spans", "items")


def without_spans(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the bytes of every hit run cut from the text; ids must be unique. Other texts are untouched."""
    hit, spans = free("_hit", docs), free("_spans", docs)
    hits = found.filter(F.size("spans") > 0).select(F.col(id_column).alias(hit), F.array_sort("spans").alias(spans))
    text = F.col(text_column).cast("binary")
    kept = F.transform(
        F.concat(F.array(F.lit(0).cast("long")), F.col(f"{spans}.end_byte")),
        lambda start, i: F.substring(
            text, (start + 1).cast("int"),
            (F.coalesce(F.get(F.col(f"{spans}.first_byte"), i), F.octet_length(text).cast("long")) - start).cast("int")))
    cut = F.when(F.col(spans).isNull(), F.col(text_column)).otherwise(
        F.aggregate(kept, F.lit(b""), lambda a, x: F.concat(a, x)).cast("string"))
    return docs.join(hits, F.col(id_column) == F.col(hit), "left").withColumn(text_column, cut).drop(hit, spans)
