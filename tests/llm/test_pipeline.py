"""The stages of the pipeline, each on its own input, against brute force."""

import re

import pytest

import corpus_pipeline
from kinweave.llm.catalog import QUERIES
from kinweave.llm.scratch import stored

from tests.conftest import SF
from tests.llm import test_line_dedup, test_minhash
from tests.llm import test_packing as packed


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return dict(out)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(steps):
    names = list(steps)
    assert names == ["documents", "toxicity", "line_dedup", "minhash", "decontaminate", "packing"]
    assert all(steps[n].dtypes == steps["documents"].dtypes for n in names[:-1])


def test_toxic_documents_go_and_others_stay(spark, steps):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = rows(steps["documents"]), rows(steps["toxicity"])
    assert all(after[i] == before[i] for i in after)
    gone = set(before) - set(after)
    assert not [i for i in gone if labels.get(i) == 0]
    assert gone == {r.doc_id for r in QUERIES["op8_toxicity"](spark, SF).filter("predicted = 1").collect()}


def test_lines(steps):
    before, after = rows(steps["toxicity"]), rows(steps["line_dedup"])
    expected = test_line_dedup.brute([(r.doc_id, r.text) for r in before.values()])
    kept = {i: t for i, t in expected.items() if t == before[i].text or t.split()}
    assert {i: r.text for i, r in after.items()} == kept
    assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)


def test_near_duplicates(steps):
    before, after = rows(steps["line_dedup"]), rows(steps["minhash"])
    component = test_minhash.brute_components(
        list(before), test_minhash.brute_sets([r.text for r in before.values()]), corpus_pipeline.NEAR_PERCENT)
    assert after == {i: r for i, r in before.items() if component[i] == i}


def test_contaminated(spark, steps):
    def words(text):
        return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} - {()}
    sizes = {len(w) for w in windows}
    before, after = rows(steps["minhash"]), rows(steps["decontaminate"])
    kept = {}
    for i, r in before.items():
        w = words(r.text)
        hit = {k for n in sizes for a in range(len(w) - n + 1) if tuple(w[a:a + n]) in windows for k in range(a, a + n)}
        if not hit or 20 * len(hit) < len(w):
            kept[i] = r
    assert after == kept


def test_packing(steps):
    placed = steps["packing"].collect()
    assert {r.doc_id for r in placed} == set(rows(steps["decontaminate"]))
    assert packed.check_places(placed, 2048) == packed.one_by_one([r.length for r in placed], 2048)


def test_near_duplicates_from_80_percent_on(spark):
    words = [f"w{i}" for i in range(100)]
    # 86 shingles of 106 are shared, 81 %; of the third 81 of 111 with the first, 73 %.
    two, three = (" ".join(f"{n}{i}" if i in (20, 50, 80)[:n] else w for i, w in enumerate(words)) for n in (2, 3))
    docs = spark.createDataFrame([(1, " ".join(words)), (2, two), (3, three)], "doc_id long, text string")
    assert sorted(rows(corpus_pipeline.drop_near_duplicates(spark, docs, SF))) == [1, 3]


def test_contaminated_rows_go_by_their_own_text(spark):
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r.text or "").split()) >= 13)
    docs = spark.createDataFrame(
        [(None, item, "a"), (None, "clean words", "b"), (5, item, "c"), (5, "clean too", "d"), (6, None, "e"), (None, None, "f")],
        "doc_id long, text string, source string")
    assert sorted(r.source for r in corpus_pipeline.drop_contaminated(spark, docs, SF).collect()) == ["b", "d", "e", "f"]


@pytest.mark.parametrize("name", ["toxicity", "minhash", "decontaminate", "packing"])
def test_workers_get_small_batches(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    wide = spark.range(3_000, numPartitions=1).selectExpr("repeat(cast(id % 10 as string), 10000) text")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    spark.conf.unset(corpus_pipeline.BATCH_SETTING)
    try:
        dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
        found = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.unset(corpus_pipeline.BATCH_SETTING)
    assert sum(found) >= 30_000_000 and max(found) < 2 * corpus_pipeline.BATCH_BYTES
