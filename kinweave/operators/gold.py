"""Keeps the serving copy of the golden history in step with the last few days of changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import keys
from kinweave.operators.devices import LATE_DAYS
from kinweave.schemas import GOLDEN

VERSION_KEY = ("customer_key", "valid_from_ts")
REFRESHED = ("valid_to_ts", "current_record_indicator")


def gold_changed_versions(dim: DataFrame, run_date: dt.date) -> DataFrame:
    """Versions opened since the start of the window, or closed within it."""
    since, until = keys.start_of(run_date - dt.timedelta(days=LATE_DAYS)), keys.start_of(run_date)
    changed = (F.col("valid_from_ts") >= since) | F.col("valid_to_ts").between(since, until)
    return dim.filter(changed).select(*GOLDEN.names)


def gold_upsert(gold: DataFrame, changed: DataFrame) -> DataFrame:
    """Known versions get the new end date and flag and nothing else; unknown ones are added whole.

    One full outer join on (customer key, start), which is unique on both sides, so no key is hot; each side is read once.
    A run joins the current slice of gold only, see :func:`gold_merge`.
    """
    old = gold.select(*VERSION_KEY, F.struct(*GOLDEN.names).alias("_old"))
    new = changed.select(*VERSION_KEY, F.struct(*GOLDEN.names).alias("_new"))

    def value(name: str) -> Column:
        known, news = F.col("_old").getField(name), F.col("_new").getField(name)
        first, second = (("_new", news), known) if name in REFRESHED else (("_old", known), news)
        return F.when(F.col(first[0]).isNotNull(), first[1]).otherwise(second).alias(name)

    return old.join(new, list(VERSION_KEY), "full_outer").select(*map(value, GOLDEN.names))


def gold_merge(current: DataFrame, lately_closed: DataFrame, changed: DataFrame) -> DataFrame:
    """What ``changed`` makes of the ``current`` slice of gold: versions that go on, that it closes, and that it adds.

    A closed version never changes again, so those that gold has closed within the window already are left alone.
    """
    keys_of = [F.col(k).alias(f"_{k}") for k in VERSION_KEY]
    same = (F.col("customer_key") == F.col("_customer_key")) & (F.col("valid_from_ts") == F.col("_valid_from_ts"))
    return gold_upsert(current, changed.join(lately_closed.select(*keys_of), same, "left_anti"))
