"""Deterministic surrogate keys: the same input gives the same key on every run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.schemas import OPEN_END


def mint_key(source_system: str, source_id: Column) -> Column:
    """Customer key minted from the first source record of a customer."""
    return F.concat(F.lit("CUS_"), F.substring(F.sha2(F.concat(F.lit(f"{source_system}|"), source_id), 256), 1, 24))


def exception_key(identity: Column, run_date: dt.date) -> Column:
    return F.sha2(F.concat_ws("|", identity, F.lit(run_date.isoformat())), 256)


def start_of(run_date: dt.date) -> Column:
    return F.lit(run_date).cast("timestamp_ntz")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")
