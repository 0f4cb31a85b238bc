"""Token counts of whole texts.

Arrow functions return lengths only. Texts are batched by characters, not by rows; a long text is cut at places where
no token can reach over, and a distinct unit is encoded once for as long as its worker remembers it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.units import LengthEncoder, encoder


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``id_column, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    ``tokenizer`` is the path of a byte-level tokenizer file. Null and empty texts have 0 bytes and 0 tokens; special
    strings inside a text count as the library takes them by default. Repeated rows and rows with a null id are counted
    each; other columns are not read. An empty table gives an empty result.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = encoder(LengthEncoder, tokenizer)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            n_tokens = pa.array(lengths.encode(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n_tokens], ["_id", "n_bytes", "n_tokens"])

    schema = T.StructType([
        T.StructField("_id", docs.schema[id_column].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType())])
    counted = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(count, schema)
    return counted.select(
        F.col("_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
