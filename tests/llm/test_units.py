"""Unit-wise encoding against the library on whole texts."""

import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinweave.llm import units

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "a", "a b", " a  b ", "a\n\nb", "it's o' s don't", "x<|endoftext|>y <|endoftext|> z", "<|ENDOFTEXT|> A",
    "<|startoftext|>", "tab\tand\x1cfs\x85nel nbsp　wide", "ΟΔΟΣ ΑΣ. Σ", "é ́x", "1,000.5 m² 10kg.", "ﬁ ǅ İI",
    "日本語。テスト 中文", "a" * 3000, "word. " * 50 + "end", "🙂🙂 x﻿ y​ z", "A.\nB, c;\nd", "a.", ".a", "a.b,c", "x_. y", "e.g., z", "end.\n", "a , b .", "á. b", "². ¾,", "a.\tb. c", "EVİ.", "Xİ. y", "DİYARBAKİ, x", "क़. a", "foo \n bar\n", "'s 's\n's",
]


def pieces():
    rnd = random.Random(5)
    alphabet = ["a", "B", "é", "Σ", " ", " ", "\n", ".", ",", "'", "s", "1", "²", "\t", "<|endoftext|>", "́", "🙂"]
    return ["".join(rnd.choices(alphabet, k=rnd.randint(1, 40))) for _ in range(3000)]


def corpus():
    return [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]


@pytest.mark.parametrize("texts", [ODD, pieces(), corpus()], ids=["odd", "random", "corpus"])
def test_units_give_the_ids_of_the_whole_text(texts, monkeypatch):
    monkeypatch.setattr(units, "BATCH_CHARS", 64)
    monkeypatch.setattr(units, "REMEMBERED", 50_000)
    monkeypatch.setattr(units, "JOINED", 7)
    for path, make in ((BYTE, units.LengthEncoder), (WORD, units.IdEncoder)):
        whole = Tokenizer.from_file(path)
        expected = [whole.encode(t, add_special_tokens=False).ids for t in texts]
        got = list(make(path).encode(texts))
        assert got == [len(x) if make is units.LengthEncoder else units.packed(x) for x in expected]


@pytest.mark.parametrize("form", ["ab{}. x", "ab{}, x", "a.{}x b", "a ,{} b", "{}.", ".{}", "x{}"])
def test_marks_beside_every_code_point(form):
    """Full stops and commas before and behind each code point of the basic plane."""
    texts = [form.format(chr(c)) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for path, make in ((BYTE, units.LengthEncoder), (WORD, units.IdEncoder)):
        expected = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        got = make(path).encode(texts)
        assert all(g == (len(e) if make is units.LengthEncoder else units.packed(e)) for g, e in zip(got, expected, strict=True))


def test_memory_is_bounded(monkeypatch):
    """However many units go by, both generations together hold little more than the bound, and frequent units stay."""
    monkeypatch.setattr(units, "REMEMBERED", 400_000)
    encoder = units.IdEncoder(WORD)
    for k in range(40):
        list(encoder.encode([" ".join(["often", *(f"w{k}x{j}" for j in range(200))])]))
        assert "often" in encoder.known.of or "often" in encoder.known.older
        weight = sum(units._weight(u, v) for table in (encoder.known.of, encoder.known.older) for u, v in table.items())
        assert weight <= 400_000 + 2 * 250 * 200


def test_segments_join_to_the_text():
    for text in [*ODD, *pieces()]:
        assert "".join(units.segments(text, 7)) == text


def test_ids_are_looked_up_once_for_each_distinct_word(monkeypatch):
    class Counted(dict):
        asked = 0

        def __getitem__(self, unit):
            Counted.asked += 1
            return super().__getitem__(unit)

    encoder = units.IdEncoder(WORD)
    encoder.known.of = Counted()
    texts = ["one two\nthree, two. " * 500, "", "two " * 300]
    alone = [units.packed(encoder.known.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert list(encoder.encode(texts)) == alone
    assert Counted.asked <= 8


def test_marks_beside_others_are_found_wherever_they_stand():
    import random
    import re

    plain = re.compile(r"(?:[^\w\s]|[_\x1c-\x1f])[.,]|[.,](?:[^\w\s]|[_\x1c-\x1f])")
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choices("a. ,_\n\x1cé-̇٣", k=draw.randint(0, 6)))
        assert (units._ODD_BARE_MARK.search(text) is None) == (plain.search(text) is None), text
