"""Lookups and rankings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.session import shared_folder

# Rows with no key spread over this many values.
SPREAD = 4_096


def lookup(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Adds the columns of ``right``, unique per string key ``on``, to ``left``.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``; the last two add no columns.

    Adaptive execution cuts the partition of a hot left key into pieces and joins them in parallel, but only if
    both sides come straight from a shuffle. A right side that was just aggregated by the same key does not: it would
    be joined in place. So its key is re-derived, which gives it an exchange of its own; it is the small side. Left
    rows with no key match nothing and are spread instead of piling up in the partition of NULL.
    """
    payload = [c for c in right.columns if c != on]
    answers = right.select(F.concat(F.col(on), F.lit("")).alias("_key"), *payload)
    if how in ("left", "left_anti"):
        nowhere = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD)).cast("string"))
        asked = left.withColumn("_asked", F.coalesce(F.col(on), nowhere))
    else:
        asked = left.withColumn("_asked", F.col(on))
    return asked.join(answers, F.col("_asked") == F.col("_key"), how).drop("_asked", "_key")


def ranked(
    df: DataFrame, group: Sequence[str], order: Column, rank: str, value: str, distinct: str,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``row_number`` within a group by ascending ``order`` as ``rank``, and the group's distinct values of ``value`` as ``distinct``.

    Rows are sorted into ranges by group and ``order``, whose bounds Spark samples; a large group fills several ranges. A row's
    rank is its place among its group's rows in its range, plus the group's rows in the ranges before: a table with a row for each
    group and range. Values are counted from distinct (group, value) rows. So no task ever holds a group, whatever its size.

    ``keep`` writes the ranges, which must not be drawn anew: it is :func:`checkpointed` unless given.
    """
    keys = [F.col(c) for c in group]
    sort = [f"_sort.{f}" for f in df.select(order.alias("_sort")).schema["_sort"].dataType.names]
    ranges = df.withColumn("_sort", order).repartitionByRange(*keys, *sort).withColumn("_range", F.spark_partition_id())
    ranges = (keep or checkpointed)("ranked_ranges", ranges)

    rows = ranges.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    values = ranges.select(*group, value).distinct().groupBy(*group).agg(F.count(value).alias(distinct))
    places = rows.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).join(values, list(group))
    same = F.col("_range") == F.col("_r")
    for c in group:
        same = same & (F.col(c) == F.col(f"_g_{c}"))
    places = places.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_range").alias("_r"), "_before", distinct)
    within = Window.partitionBy(*group, "_range").orderBy("_sort")
    return ranges.withColumn("_place", F.row_number().over(within)).join(places, same).withColumn(
        rank, F.col("_place") + F.col("_before")).select(*df.columns, rank, distinct)


def checkpointed(name: str, df: DataFrame) -> DataFrame:
    """Cuts lineage with a table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/kinweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
