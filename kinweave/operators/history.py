"""Versioned history (SCD2): closed and open versions of the same key in one table.

Plain files have no row-level update, so each function takes the old table and returns the new one. Closed
versions pass straight through and never enter the shuffle; store the table partitioned by
``current_record_indicator`` and they are not even read for the join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import keys as key_functions
from kinweave.schemas import OPEN_END

XREF_KEYS = ("source_system", "source_id")
XREF_TRACKED = ("customer_key", "match_rule_code", "is_quarantined")


def _is_current() -> Column:
    return F.coalesce("current_record_indicator", F.lit(False))


def scd2_apply(
    snapshot: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: dt.date,
    stamps: Mapping[str, str] | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """New state of ``dim`` after ``snapshot``, one row per key, becomes the truth of ``run_date``."""
    merged = scd2_merge(snapshot, dim.filter(_is_current()), keys, tracked, run_date, stamps, close_missing)
    return dim.filter(~_is_current()).unionByName(merged)


def scd2_merge(
    snapshot: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: dt.date,
    stamps: Mapping[str, str] | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """What ``snapshot`` makes of the ``current`` versions: those that go on, those it closes, and those it opens.

    A changed key has its version closed and a new one opened; a version opened on this very date is replaced, so
    a re-run of the date changes nothing. NULL counts as a value in the comparison. A key missing from the snapshot
    stays open unless ``close_missing``. ``stamps`` are further columns of an opened version, as SQL. One full outer
    join over keys that are unique on both sides.
    """
    start = f"TIMESTAMP_NTZ'{run_date} 00:00:00'"
    fresh = {
        "valid_from_ts": start, "valid_to_ts": f"TIMESTAMP_NTZ'{OPEN_END} 00:00:00'", "current_record_indicator": "true",
        **(stamps or {}),
    }
    types = {f.name: f.dataType.simpleString() for f in current.schema.fields}

    def version(base: str, **changes: str) -> str:
        fields = [f"CAST({changes.get(c, f'{base}.`{c}`')} AS {types[c]}) AS `{c}`" for c in current.columns]
        return f"struct({', '.join(fields)})"

    old = current.select(*keys, F.struct(*current.columns).alias("_old"))
    new = snapshot.select(*keys, F.struct(*[c for c in current.columns if c not in fresh]).alias("_new"))

    kept = version("_old")
    closed = version("_old", valid_to_ts=start, current_record_indicator="false")
    opened = version("_new", **fresh)
    same = " AND ".join(f"_old.`{c}` <=> _new.`{c}`" for c in tracked)
    versions = f"""inline(CASE
        WHEN _old IS NULL THEN array({opened})
        WHEN _new IS NULL THEN array({closed if close_missing else kept})
        WHEN {same} THEN array({kept})
        WHEN _old.valid_from_ts = {start} THEN array({opened})
        ELSE array({closed}, {opened}) END)"""
    return old.join(new, list(keys), "full_outer").selectExpr(versions)


def xref_scd2_apply(xref: DataFrame, links: DataFrame, run_date: dt.date, close_missing: bool = False) -> DataFrame:
    """Link history after today's links: changed links closed and reopened, new ones opened."""
    return scd2_apply(
        links, xref, XREF_KEYS, XREF_TRACKED, run_date,
        stamps={"_batch_run_date": f"'{run_date}'"}, close_missing=close_missing)


def xref_scd2_merge(current: DataFrame, links: DataFrame, run_date: dt.date, close_missing: bool = False) -> DataFrame:
    """The part of :func:`xref_scd2_apply` that a day writes, from the current links alone."""
    return scd2_merge(
        links, current, XREF_KEYS, XREF_TRACKED, run_date,
        stamps={"_batch_run_date": f"'{run_date}'"}, close_missing=close_missing)


def xref_close(xref: DataFrame, links: DataFrame, run_date: dt.date) -> DataFrame:
    """First half of :func:`xref_scd2_apply`: changed links closed, none opened yet."""
    start = key_functions.start_of(run_date)
    today = links.select(*XREF_KEYS, F.struct(*XREF_TRACKED).alias("_new"))
    history = xref.filter(~_is_current())
    current = xref.filter(_is_current()).withColumn("_old", F.struct(*XREF_TRACKED)).join(today, list(XREF_KEYS), "left")
    is_changed = F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))
    checked = (
        current.withColumn("_is_changed", is_changed)
        .filter(~(F.col("_is_changed") & (F.col("valid_from_ts") == start)))
        .withColumn("valid_to_ts", F.when(F.col("_is_changed"), start).otherwise(F.col("valid_to_ts")))
        .withColumn("current_record_indicator", ~F.col("_is_changed"))
    )
    return history.unionByName(checked.select(*xref.columns))


def xref_open(closed_xref: DataFrame, links: DataFrame, run_date: dt.date) -> DataFrame:
    """Second half: the versions to add, one for each link without a current row."""
    current = closed_xref.filter(_is_current()).select(*XREF_KEYS)
    return links.join(current, list(XREF_KEYS), "left_anti").select(
        *links.columns,
        key_functions.start_of(run_date).alias("valid_from_ts"),
        key_functions.open_end().alias("valid_to_ts"),
        F.lit(True).alias("current_record_indicator"),
        F.lit(run_date.isoformat()).alias("_batch_run_date"),
    )
