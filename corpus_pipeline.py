"""A training corpus from raw documents: each stage works on all that the one before it kept.

All stages but the last return the columns of ``documents``. Rows with a null id pass the stages that compare documents;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import decontaminate, line_dedup, minhash, toxicity
from kinweave.llm.catalog import TOXIC_SCORE, packed_documents, table, training_labels
from kinweave.llm.names import aside, free
from kinweave.llm.scratch import stored

#: Documents whose shingle sets share this part of their union are near duplicates.
NEAR_PERCENT = 80
#: Bytes of a batch that a Python worker gets at a time. Workers outlive a stage and keep what their largest batch took.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Holds for the session from here on, as a stage's rows are made when they are written; the session's own limit stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    small_batches(spark)
    model = toxicity.train(docs, training_labels(spark, sf_dir))
    return toxicity.without_toxic(docs, model, TOXIC_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that nearly equal an earlier one; a document left without any word goes."""
    rows, back = aside(docs, "n_lines", "n_removed")
    cut = line_dedup.without_repeated_lines(rows)
    changed = F.col("n_removed") > 0
    rest = cut.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    rest = rest.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return back(rest).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    small_batches(spark)
    found = minhash.near_duplicates(docs, percent=NEAR_PERCENT)
    rejected = free("_rejected", docs)
    ids = stored(found.filter(~F.col("kept")).select(F.col("doc_id").alias(rejected)).distinct(), "rejected")
    return docs.join(ids, F.col("doc_id") == F.col(rejected), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which too little is in the benchmark to call them contaminated. Rows are told by their texts, on which
    alone the verdict depends, so ids may be null or repeat."""
    small_batches(spark)
    windows = stored(decontaminate.item_windows(table(spark, sf_dir, "benchmark")), "benchmark-windows")
    digest = F.sha2("text", 256)
    texts = docs.select(digest.alias("_rejected"), "text")
    found = decontaminate.contamination(texts, windows, "_rejected").filter("contaminated")
    name = free("_rejected", docs)
    rejected = stored(found.select(F.col("_rejected").alias(name)).distinct(), "rejected")
    return docs.join(rejected, digest == F.col(name), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of fixed size."""
    small_batches(spark)
    return packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: Learned scores, components and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
