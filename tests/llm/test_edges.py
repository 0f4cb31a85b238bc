"""Nulls, empty and long texts, ties, repeated rows, empty tables, and columns whose names clash with inner ones."""

import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinweave.llm import decontaminate, quality, token_counts, url_filter, warc
from kinweave.llm.catalog import URL_RULES
from kinweave.llm.scratch import drop_stored, new_path, stored

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def text_rows(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, _id string, n_words string")


def test_quality(spark):
    group = ("lang", "source")
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{good} more{i}", "en", "s0") for i in range(250)]
    rows += [(300, None, "en", "s0"), (301, "", None, None), (302, good, None, "s9"), (302, good, None, "s9"), (None, good, "en", None)]
    rows += [(303, " ".join(f"{w}###" for w in good.split()), "en", "s1"), (304, "a b c d e " * 20, "en", "s0")]
    rows += [(305, "\n".join([good, f"{good} z", good, "", "\t", "\t"]), "en", "s0"), (306, "w " * 50_000, "en", "s0")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, _row string")
    counted = stored(quality.text_counts(docs), "counts")
    sketch = stored(quality.sketches(counted, group), "sketches")
    got = {}
    for r in quality.judge(counted, quality.group_fences(counted, sketch, group), group).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all(got[i][0].kept for i in range(250))
    for i in (300, 301):
        assert (got[i][0].n_words, got[i][0].base_failed, got[i][0].kept) == (0, True, False)
    # Too small a group takes the fences of all; a null id and a null language are judged like others.
    assert [r.kept for r in got[302]] == [True, True] and got[None][0].kept
    assert got[303][0].n_symbols == 120 and not got[303][0].base_failed and not got[303][0].kept
    assert got[304][0].n_repeat_words == 100 and got[304][0].base_failed
    assert got[305][0].n_dup_lines == 1 and got[306][0].n_repeat_words == 50_000
    empty = stored(quality.text_counts(docs.limit(0)), "counts")
    assert quality.judge(empty, quality.group_fences(empty, quality.sketches(empty, group), group), group).collect() == []


def test_token_counts(spark):
    texts = [None, "", " ", "x" * 50_000, "word " * 30_000, "a <|endoftext|> b", "<|endoftext|>", "é\n\nß", "a\x00b"]
    rows = [*enumerate(texts), (1, ""), (None, "a b")]
    got = token_counts.token_counts(text_rows(spark, rows), BYTE, 1024).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    expected = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    key = str
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(expected, key=key)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts.token_counts(text_rows(spark, []), BYTE, 1024).collect() == []


def words_of(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("block", [1000, 3])
def test_contamination(spark, block):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    benchmark = spark.createDataFrame(
        [(1, passage, "x"), (2, "Short ITEM", "x"), (3, None, "x"), (4, "", "x"), (2, "short item", "x"), (12, passage, "y")],
        "item_id long, text string, item string")
    rows = [(1, None), (2, ""), (3, passage.upper()), (4, passage.replace(" ", ", ")), (5, " ".join(passage.split()[:12])),
            (6, "some short-item here"), (7, "shortitem"), (8, f"{'w ' * 5_000}short item"), (3, passage.upper()), (None, passage)]
    windows = stored(decontaminate.item_windows(benchmark), "windows")
    found = decontaminate.contamination(text_rows(spark, rows), windows, block_windows=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in found.collect()), key=str)
    assert got == sorted([
        (1, 0, 0, [], False), (2, 0, 0, [], False), (3, 15, 15, ["1", "12"], True), (3, 15, 15, ["1", "12"], True),
        (4, 15, 15, ["1", "12"], True), (5, 12, 0, [], False), (6, 4, 2, ["2"], True), (7, 1, 0, [], False),
        (8, 5002, 2, ["2"], False), (None, 15, 15, ["1", "12"], True)], key=str)
    nothing = decontaminate.contamination(text_rows(spark, rows), windows.limit(0))
    assert nothing.filter("contaminated OR n_hit > 0").isEmpty() and nothing.count() == len(rows)
    assert decontaminate.contamination(text_rows(spark, []), windows).collect() == []


def test_spans_are_cut(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(1, f"Größe: {passage.upper()}! Rest é {passage}."), (2, "clean"), (3, None)]
    docs = text_rows(spark, rows)
    found = stored(decontaminate.contamination(docs, decontaminate.item_windows(benchmark)), "found")
    got = {r.doc_id: r.text for r in decontaminate.without_spans(docs, found).collect()}
    assert got == {1: "Größe: ! Rest é .", 2: "clean", 3: None}


def test_urls(spark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme casino": ("", "", None, "block"),
        "http://A.Example.NET/en/x?y": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"), "http://net": ("net", "", None, "allow"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "http://x.example.com/de/a": ("x.example.com", "/de/a", "example.com/de/", "block"),
        "http://b.org/fr/casino": ("b.org", "/fr/casino", "org/fr/", "allow"),
        "http://casino.org/": ("casino.org", "/", None, "block"), "http://casinos.org/": ("casinos.org", "/", None, "allow"),
        "http://cheap-pills.org/": ("cheap-pills.org", "/", None, "block"),
        "http://cheap-cheap.org/": ("cheap-cheap.org", "/", None, "allow"),
        "http://x.org/écheap_pills": ("x.org", "/écheap_pills", None, "allow"),
        "a://b://c/d#e": ("b:", "//c/d", None, "allow"), "http://x.org/a\nb?q": ("x.org", "/a\nb", None, "allow"),
        "http://x.org/" + "a" * 50_000: ("x.org", "/" + "a" * 50_000, None, "allow"),
    }
    rows = [(i, u, "x") for i, u in enumerate(cases)]
    pages = spark.createDataFrame([*rows, rows[0], (None, "http://casino.org/", "y")], "page_id long, url string, host string")
    got = url_filter.judge_urls(pages, URL_RULES, url_filter.VOCABULARY).collect()
    assert len(got) == len(rows) + 2
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by_id == {i: cases[u] for i, u, _ in rows} | {None: ("casino.org", "/", None, "block")}
    assert url_filter.judge_urls(pages.limit(0), URL_RULES, url_filter.VOCABULARY).collect() == []


def test_warc_round_trip(spark):
    long = ("WARC/1.1\r\n\r\n0\r\n\r\n" + "é" * 30_000).encode()
    same = b"s" * 1_000
    binary = bytes(range(256)) * 500
    rows = [(1, "http://a/\r\nX: y", None), (2, None, b""), (3, "u", long), (4, "u", binary), (5, "u", same), (6, "u", same),
            (7, "u", same), (8, "u", same[1:]), (9, "u", same[1:]), (9, "u", same[1:]), (4, "u", binary), (None, "u", same), (10, "u", b"\n")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html binary, payload string")
    owners = stored(warc.payload_owners(pages.select(F.col("page_id").alias("_id"), F.col("html").alias("_payload"))), "owners")
    path = new_path(spark, "archives")
    warc.write_archives(pages, owners, path, "2024-01-01T00:00:00Z")
    records = stored(warc.read_archives(spark, path), "records")
    assert records.filter("fault IS NOT NULL").isEmpty()
    responses = sorted(bytes(r.payload) for r in records.filter("warc_type = 'response'").collect())
    assert responses == sorted(b or b"" for i, _, b in rows if not (b == same and i in (5, 6)))
    facts = warc.payload_facts(warc.facts_of_responses(records)).collect()
    got = sorted((r.record_id.split(":")[2], r.warc_type, r.payload_bytes, r.payload_digest) for r in facts)
    assert got == sorted((
        "" if i is None else str(i), "revisit" if b == same and i in (5, 6) else "response", len(b or b""),
        hashlib.sha1(b or b"").hexdigest()) for i, _, b in rows)
    assert {r.refers_to.split(":")[2] for r in facts if r.refers_to} == {"7"}


def test_warc_faults(spark, tmp_path):
    block = warc._HTTP + warc.chunked(b"p" * 100)

    def segment(kind, n, body, total=None, record="<urn:a>"):
        fields = {"WARC_Segment_Number": n, "WARC_Segment_Total_Length": total}
        own = record if kind == "response" else f"<urn:{n}>"
        origin = {} if kind == "response" else {"WARC_Segment_Origin_ID": record}
        return warc._record(kind, own, body, **fields, **origin)

    def read(name, *records):
        folder = tmp_path / name
        folder.mkdir()
        for i, r in enumerate(records):
            (folder / f"{i}.warc").write_bytes(r)
        return [(r.record_id, r.payload and bytes(r.payload), r.fault) for r in warc.read_archives(spark, str(folder)).collect()]

    first, second, last = segment("response", 1, block[:50]), segment("continuation", 2, block[50:90]), segment(
        "continuation", 3, block[90:], len(block))
    assert read("apart", last, first, second) == [("<urn:a>", b"p" * 100, None)]
    assert read("twice", last, first + first, second + second, last) == [("<urn:a>", b"p" * 100, None)] * 2
    assert read("gap", first, last)[0][1:] == (None, "a segment is missing")
    wrong = segment("continuation", 3, block[90:], len(block) + 1)
    assert read("length", first, second, wrong)[0][2].startswith(f"{len(block)} bytes")
    assert read("frame", warc._record("response", "<urn:b>", block[:-20]))[0][1:] == (None, "a chunk is cut short")
    with pytest.raises(Exception, match="cut short"):
        read("broken", first[:-10])
    drop_stored(spark)
