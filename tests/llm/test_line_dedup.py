"""Removed lines against brute force over all pairs of lines."""

import random

import duckdb

from kinweave.llm import line_dedup

from tests.conftest import SF


def brute(rows):
    sets, out = [], {}
    for doc, text in sorted((r for r in rows if r[0] is not None and r[1] is not None)):
        kept = []
        for line in text.split("\n"):
            own = {w for w in _split(line.lower()) if w}
            n = len(own)
            if n >= 1:
                near = any(
                    100 * min(n, len(s)) >= 85 * max(n, len(s)) and 100 * (k := len(own & s)) >= 85 * (n + len(s) - k)
                    for s in sets)
                sets.append(own)
                if near:
                    continue
            kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def _split(line):
    for c in "\t\n\x0b\x0c\r":
        line = line.replace(c, " ")
    return line.split(" ")


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got == brute(rows)


def test_table_against_brute_force(spark):
    check(spark, duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def test_variants_around_the_threshold(spark):
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    bases = [rnd.sample(vocabulary, rnd.randint(5, 30)) for _ in range(12)]
    rows = []
    for doc in range(60):
        lines = []
        for _ in range(rnd.randint(1, 6)):
            words = list(rnd.choice(bases))
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = rnd.choice([*vocabulary, f"x{rnd.random()}"])
            rnd.shuffle(words)
            lines.append(rnd.choice([" ", "  ", "\t"]).join(words))
        rows.append((doc, "\n".join(lines)))
    rnd.shuffle(rows)
    check(spark, rows)


def test_edge_rows(spark):
    line = "one two three four five six"
    docs = spark.createDataFrame(
        [(3, f"{line}\nshort\n\n{line.upper()}", "a"), (4, line, "b"), (4, line, "b"), (None, line, "c"), (6, None, "d"),
         (7, "", "e"), (8, "short\nshort", "f")], "doc_id long, text string, _id string")
    got = sorted(((r.doc_id, r.text, r._id, r.n_lines, r.n_removed) for r in line_dedup.without_repeated_lines(docs).collect()), key=str)
    assert got == sorted([
        (3, f"{line}\nshort\n", "a", 4, 1), (4, "", "b", 1, 1), (4, "", "b", 1, 1), (None, line, "c", 1, 0), (6, None, "d", 0, 0),
        (7, "", "e", 1, 0), (8, "", "f", 2, 2)], key=str)
    assert line_dedup.without_repeated_lines(docs.limit(0)).collect() == []


def test_short_lines_go_as_well(spark):
    texts = [
        "All rights reserved.\nyes\n\n \t", "yes\nYES yes\nAll rights reserved.", "buy buy buy buy buy buy\none two three four",
        "Buy\nfour three two one\none two three", "a b c d e\na b c d e f\na b c d e f g\n\n", "e d c b a\na b c d e x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.without_repeated_lines(docs).collect()}
    # Seven words nearly equal six of them; five words and six do not.
    assert got == {
        0: (texts[0], 0), 1: ("", 3), 2: (texts[2], 0), 3: ("one two three", 2), 4: ("a b c d e\na b c d e f\n\n", 1),
        5: ("a b c d e x", 1)}
