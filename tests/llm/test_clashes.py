"""Extra columns called like the ones operators use inside or add, null ids and empty tables, through operators and pipeline stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinweave.llm import decontaminate, line_dedup, quality
from kinweave.llm.catalog import table
from kinweave.llm.names import aside, free

from tests.conftest import SF

NAMES = ("_id", "_text", "_row", "_words", "_lines", "_rejected", "_hit", "_spans", "_gone", "_gone_id", "n_lines", "n_words", "n_removed",
         "n_symbols", "kept", "score", "spans", "component_id", "contaminated", "is_duplicate")


def crowded(docs):
    for name in NAMES:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return docs


def sample(spark):
    docs = table(spark, SF, "documents").limit(120)
    line = "one two three four five six seven"
    more = spark.createDataFrame(
        [(None, f"{line}\n{line}", "en", "s", 3), (None, None, "en", "s", 0), (-1, f"{line}\nshort", None, None, None), (-2, f"x y\n{line}", "en", "s", 1),
         (-3, "", "en", "s", 0)], docs.schema)
    return docs.unionByName(more)


def rows(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_pass_on_clashing_columns(spark, name, stage):
    docs = sample(spark)
    plain = stage(spark, docs, SF)
    full = stage(spark, crowded(docs), SF)
    assert full.columns == crowded(docs).columns
    assert rows(full, docs.columns) == rows(plain, docs.columns)
    for r in full.collect():
        assert all(r[c] == f"{c}:{'none' if r['doc_id'] is None else r['doc_id']}" for c in NAMES)


def test_packing_ignores_other_columns(spark):
    docs = sample(spark).limit(20)
    name, stage = corpus_pipeline.STAGES[-1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert name == "packing" and rows(stage(spark, crowded(docs), SF), columns) == rows(stage(spark, docs, SF), columns)


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert found.collect() == []
        if name != "packing":
            assert found.columns == docs.columns


def test_operators_with_clashing_columns(spark):
    docs = sample(spark)
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    assert rows(quality.text_counts(crowded(docs)), counts) == rows(quality.text_counts(docs), counts)
    columns = ["doc_id", "text", "n_lines", "n_removed"]
    assert rows(line_dedup.without_repeated_lines(crowded(docs)), columns) == rows(line_dedup.without_repeated_lines(docs), columns)
    unique = docs.filter("doc_id IS NOT NULL")
    windows = decontaminate.item_windows(table(spark, SF, "benchmark"))
    found = decontaminate.contamination(unique, windows)
    cut = decontaminate.without_spans(crowded(unique), found)
    assert cut.columns == crowded(unique).columns
    assert rows(cut, ["doc_id", "text"]) == rows(decontaminate.without_spans(unique, found), ["doc_id", "text"])


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, A_own int, b int")
    assert free("c", df) == "c" and free("B", df) == "B_"
    other, back = aside(df, "A", "z")
    assert other.columns == ["a_own_", "A_own", "b"]
    assert back(other.withColumn("a", F.lit(9))).columns == ["a", "A_own", "b"]
    assert back(other.withColumn("a", F.lit(9))).first()["a"] == 1
