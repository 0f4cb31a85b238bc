"""Scores against held-out labels, and the rule that makes them."""

import zlib

import numpy as np
import pyarrow as pa

from kinweave.llm import toxicity
from kinweave.llm.catalog import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, MIDDLE).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    unseen = [(labels[i], r.predicted) for i, r in rows.items() if r.held_out and i in labels]
    assert not any(said for true, said in unseen if not true)
    # The table has 33 toxic documents to learn from, in four languages.
    assert sum(said for true, said in unseen if true) >= 0.6 * sum(true for true, _ in unseen)


def texts(n, toxic):
    filler = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rnd = np.random.default_rng(8)
    out = []
    for i in range(n):
        sentences = [" ".join(rnd.choice(filler, 6)) for _ in range(5)]
        if toxic[i]:
            sentences[rnd.integers(5)] = f"alpha {rnd.choice(['badness', 'badly', 'awful'])} gamma"
        out.append(". ".join(sentences) + ".")
    return out


def test_sentences_are_found_from_document_labels(spark):
    toxic = np.arange(400) % 4 == 0
    model = toxicity.fit(pa.array(texts(400, toxic)), toxic)
    rows = [(1, "Alpha beta. You are AWFUL gamma! Zeta."), (2, "alpha beta."), (3, None), (4, ""), (4, ""), (None, "awful")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    got = [(r.doc_id, r.score, r.offending) for r in toxicity.score(docs, model).collect()]
    first = next(g for g in got if g[0] == 1)
    assert first[1] > 0.7 and [rows[0][1][p.first_byte:p.end_byte] for p in first[2]] == ["You are AWFUL gamma"]
    assert next(g for g in got if g[0] is None)[1] > 0.7
    assert all(g[1] < 0.05 and not g[2] for g in got if g[0] in (2, 3, 4)) and len(got) == 6
    assert sorted(r.doc_id for r in toxicity.without_toxic(docs, model, 0.7).collect()) == [2, 3, 4, 4]
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, None), (None, 1)]):
        model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert toxicity.score(docs, model).first().score < 0.01
