"""Data-quality checks. Each returns the offending rows or keys; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def dq_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def is_incomplete(cols: Sequence[str]) -> Column:
    broken = F.lit(False)
    for name in cols:
        broken = broken | F.col(name).isNull()
    return broken


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(is_incomplete(cols))


def dq_relationships(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their row count. Both sides shrink to keys before the join."""
    complete = F.lit(True)
    for name in on:
        complete = complete & F.col(name).isNotNull()
    keys = child.filter(complete).groupBy(*on).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(parent.select(*on).distinct(), list(on), "left_anti")


def is_unknown(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def dq_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(is_unknown(column, values))


class QualityError(Exception):
    """A data-quality check found offending rows."""


class Measured:
    """Checks of single rows, counted while the table is written instead of in a scan of their own.

    ``offending`` names each check and the rows that fail it. A task that runs twice may count twice, so only
    whether a count is zero means something.
    """

    def __init__(self, df: DataFrame, offending: dict[str, Column]):
        self._names = list(offending)
        self._seen = Observation()
        counts = [F.count_if(broken).alias(f"c{i}") for i, broken in enumerate(offending.values())]
        self.table = df.observe(self._seen, *counts)

    def require_clean(self) -> None:
        """Fails the run if a row failed a check. Call it once the table is written."""
        counts = self._seen.get
        broken = {name: counts[f"c{i}"] for i, name in enumerate(self._names) if counts[f"c{i}"]}
        if broken:
            raise QualityError(f"rows that fail a check: {broken}")


class Casts:
    """A ledger of texts that are no value of their column's type, which a cast would turn into NULL unseen.

    ``casts`` names for each column its text and its type. ``rejects`` has a row for each text that fails; all texts are
    counted in the same pass, so that a share of failures can be too much.
    """

    def __init__(self, df: DataFrame, table: str, key: str, casts: dict[str, tuple[Column, str]]):
        self._seen = Observation()
        given = [F.count(text) for text, _ in casts.values()]
        failed = {c: text.isNotNull() & text.try_cast(kind).isNull() for c, (text, kind) in casts.items()}
        observed = df.observe(
            self._seen, sum(given[1:], given[0]).alias("given"),
            sum((F.count_if(f) for f in failed.values()), F.lit(0)).alias("failed"))
        rows = [F.when(failed[c], F.struct(
            F.lit(table).alias("table_name"), F.col(key).cast("string").alias("row_key"), F.lit(c).alias("column_name"),
            text.alias("raw_text"), F.lit(f"not a {kind}").alias("reason"))) for c, (text, kind) in casts.items()]
        self.rejects = observed.select(F.inline(F.array_compact(F.array(*rows))))

    def require_share(self, limit: float) -> None:
        """Fails the run if more than ``limit`` of the texts failed. Call it once the ledger is written."""
        counts = self._seen.get
        if counts["failed"] > limit * counts["given"]:
            raise QualityError(f"{counts['failed']} of {counts['given']} texts do not fit their type; {limit:.2%} may")


def require_clean(offending: DataFrame, check: str, show: int = 5) -> None:
    """Fails the run if the check found anything; reads no more than ``show`` rows."""
    rows = offending.take(show)
    if rows:
        raise QualityError(f"{check}: {[r.asDict() for r in rows]}")
