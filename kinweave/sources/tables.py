"""Reading source tables, the upsert of a table that supports MERGE, and intermediate tables.

How a run writes and publishes its own tables is in :mod:`kinweave.sources.publication`.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import shared_folder

_tables = itertools.count()


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet path, or a catalog table if the name has no slash. A given schema skips inference."""
    if "/" not in source:
        return spark.table(source)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(source)


def merge_versions(changed: DataFrame, table: str, keys: Sequence[str], update: Sequence[str]) -> None:
    """The gold upsert as a MERGE, for a catalog table whose format supports row-level changes."""
    on = None
    for key in keys:
        same = F.col(f"{table}.{key}") == F.col(f"changed.{key}")
        on = same if on is None else on & same
    (
        changed.alias("changed").mergeInto(table, on)
        .whenMatched().update({c: F.col(f"changed.{c}") for c in update})
        .whenNotMatched().insertAll()
        .merge()
    )


def written(spark: SparkSession, steps: Sequence[str] | None = None) -> Callable[[str, DataFrame], DataFrame]:
    """A ``keep`` for :class:`kinweave.plans.daily.DailyRun`: cuts lineage with a table in the shared folder.

    Written once, read by any executor, and still there when one is lost. ``steps`` names the steps worth writing
    when only part of a run is wanted; all of them by default.
    """
    folder = f"{shared_folder(spark)}/kinweave/{spark.sparkContext.applicationId}"

    def keep(name: str, df: DataFrame) -> DataFrame:
        if steps is not None and name not in steps:
            return df
        path = f"{folder}/{next(_tables)}-{name}"  # Never the same twice: someone may still be reading it.
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep
