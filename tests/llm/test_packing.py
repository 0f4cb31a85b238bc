"""Packing: every token of every document once, sequences full but without overlap."""

import random
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

from kinweave.llm import packing
from kinweave.llm.catalog import QUERIES
from kinweave.llm.scratch import stored
from kinweave.llm.units import packed as as_bytes

from tests.conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, size):
    """Best fit for single pieces, longest first: the number of sequences."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


def check_places(rows, size):
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        own.sort()
        assert own[0][0] == 0 and sum(n for _, n in own) <= size
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    return len(spans)


def test_plan_is_best_fit_on_counts():
    rnd = random.Random(2)
    for _ in range(200):
        size = rnd.choice([10, 32, 100])
        lengths = [rnd.randint(1, size) for _ in range(rnd.randint(0, 120))]
        counts = defaultdict(int)
        for n in lengths:
            counts[n] += 1
        slots = packing.plan(counts, size)
        used = defaultdict(int)
        for s in slots:
            for k in range(s.first_rank, s.end_rank):
                used[s.first_sequence + (k - s.first_rank) // s.each] += s.length
        assert sum(s.end_rank - s.first_rank for s in slots) == len(lengths)
        assert all(v <= size for v in used.values())
        assert len(used) == one_by_one(lengths, size)


def test_query_packs_every_token(spark):
    rows = QUERIES["op7_best_fit_packing"](spark, SF).collect()
    tokenizer = Tokenizer.from_file(PATH)
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    expected = []
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at:at + 2048]
            expected.append((doc_id, piece, at, len(own), zlib.crc32(as_bytes(own))))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    n = check_places(rows, 2048)
    assert n == one_by_one([r[3] for r in expected], 2048)


def test_sequences_and_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "a b c d e f g h i", "z"), (4, "one two", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    cut = stored(packing.pieces(docs, PATH, 4), "pieces")
    placed = packing.pack(cut, 4)
    assert check_places(placed.collect(), 4) == 4
    full = packing.sequences(placed).collect()
    tokens = sorted(len(r.ids) // 4 for r in full)
    assert sum(tokens) == 3 + 10 + 3 and max(tokens) == 4
    assert all([d.offset for d in r.documents] == sorted(d.offset for d in r.documents) for r in full)
    assert packing.pack(stored(packing.pieces(docs.limit(0), PATH, 4), "pieces"), 4).collect() == []
