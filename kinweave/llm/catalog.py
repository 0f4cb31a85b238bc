"""The queries over the given tables: each applies its operator to the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import (
    boilerplate, decontaminate, hard_negatives, line_dedup, minhash, packing, quality, substrings, token_counts, toxicity, url_filter, warc,
    whitening,
)
from kinweave.llm.scratch import new_path, stored

TOKEN_LIMIT = 1024
SEQUENCE_TOKENS = 2048
TOXIC_SCORE = 0.7
ARCHIVE_DATE = "2024-01-01T00:00:00Z"

#: Fixed values.
URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = ("lang", "source")
    docs = table(spark, sf_dir, "documents").select("doc_id", *group, "text")
    counted = stored(quality.text_counts(docs), "quality-counts")
    sketch = stored(quality.sketches(counted, group), "quality-sketches")
    judged = quality.judge(counted, quality.group_fences(counted, sketch, group), group)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return cut.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    payloads = pages.select(F.col("page_id").alias("_id"), F.col("html").cast("binary").alias("_payload"))
    owners = stored(warc.payload_owners(payloads), "warc-owners")
    path = new_path(spark, "archives")
    warc.write_archives(pages, owners, path, ARCHIVE_DATE)
    facts = stored(warc.facts_of_responses(warc.read_archives(spark, path)), "warc-facts")

    def page(record: Column) -> Column:
        return F.nullif(F.regexp_extract(record, "^<urn:page:([^:]*):", 1), F.lit("")).cast("long")

    return warc.payload_facts(facts).select(
        page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), page(F.col("refers_to")).alias("refers_to"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, url_filter.VOCABULARY)


def packed_documents(docs: DataFrame) -> DataFrame:
    """The place of every piece; ids are reduced to a checksum as soon as they are made."""
    cut = packing.pieces(docs, tokenizer_path("word_bpe_49k.json"), SEQUENCE_TOKENS)
    cut = stored(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "packing-pieces")
    return packing.pack(cut, SEQUENCE_TOKENS).select(
        F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from; the others are held out."""
    return table(spark, sf_dir, "labels").filter(~held_out())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, training_labels(spark, sf_dir))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = stored(decontaminate.item_windows(table(spark, sf_dir, "benchmark")), "benchmark-windows")
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), windows)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_text(table(spark, sf_dir, "pages")).select(
        F.col("_id").alias("page_id"), F.col("_url").alias("url"), "text", F.length("text").cast("long").alias("n_chars"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.quantised(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(vectors)
    shares = [] if model is None else model.explained.tolist()
    explained = F.array(*map(F.lit, shares)).cast("array<double>")
    rows = whitening.whiten(vectors, model).select("_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return rows.select(
        F.col("_id").alias("vec_id"), (F.col("_at") + 1).alias("component"), F.lit(model.n if model else None).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("_at")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mine(rows, F.col("_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash": op2_minhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_suffix_array": op4_suffix_array,
    "op5_warc": op5_warc,
    "op6_url_filter": op6_url_filter,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_counts": op10_token_counts,
    "op11_html_extraction": op11_html_extraction,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}
