"""Near duplicates against brute force."""

import random
import re

import duckdb
import pytest

from kinweave.llm import minhash
from kinweave.llm.components import components


def brute_sets(texts):
    out = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()})
    return out


def brute_components(ids, sets, percent=85):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(range(len(ids)), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1:]:
            if not sets[i] or 100 * len(sets[i]) < percent * len(sets[j]):
                if sets[i]:
                    break
                continue
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((root(ids[i]), root(ids[j])))
                parent[b] = a
    return {i: root(i) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    ids, sets = [r[0] for r in rows], brute_sets([r[1] for r in rows])
    expected = brute_components(ids, sets)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in zip(ids, sets, strict=True)}
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_table_against_brute_force(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    check(spark, rows)


def test_families_of_variants_around_the_threshold(spark):
    rnd = random.Random(3)
    rows = []
    for family in range(6):
        base = [f"w{family}x{rnd.randint(0, 400)}" for _ in range(100)]
        for k in range(40):
            words = list(base)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(100)] = f"v{rnd.random()}"
            rows.append((family * 100 + k, " ".join(words)))
    rows += [(1000 + i, rows[0][1].upper()) for i in range(50)]
    rnd.shuffle(rows)
    check(spark, rows)


def test_chain_of_shifted_texts(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 104])) for i in range(60)]
    check(spark, rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE\ntwo"), (6, "one two three"), (7, "a " * 3000), (8, "é É")]
    check(spark, rows)
    docs = spark.createDataFrame([(5, "a b c", "x"), (5, "a b c", "y"), (None, "a b c", "z")], "doc_id long, text string, _id string")
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str) == [
        (5, 1, 5, True), (5, 1, 5, True), (None, 1, None, True)]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(100)], [(0, i) for i in range(1, 200)], [(9, 5), (5, 9), (7, 9)]])
def test_components(spark, links):
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = sorted({x for link in links for x in link})
    least = dict(zip(nodes, nodes, strict=True))
    for _ in nodes:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {n: m for n, m in least.items() if n != m}


@pytest.mark.parametrize("percent, values", [(85, 6), (80, 5)])
def test_similarity_of_the_caller(spark, percent, values):
    assert minhash.band_values(percent) == values
    rnd = random.Random(8)
    rows = []
    for family in range(8):
        base = [f"w{family}x{i}" for i in range(100)]
        for k in range(12):
            words = list(base)
            for at in rnd.sample(range(100), rnd.randint(0, 3)):
                words[at] = f"v{rnd.random()}"
            rows.append((family * 100 + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, percent=percent).collect()}
    sets = brute_sets([t for _, t in rows])
    least, changed = {i: i for i, _ in rows}, True
    near = [(a, b) for (a, _), s in zip(rows, sets) for (b, _), t in zip(rows, sets) if 100 * len(s & t) >= percent * len(s | t)]
    while changed:
        changed = False
        for a, b in near:
            if least[b] < least[a]:
                least[a], changed = least[b], True
    assert got == least
