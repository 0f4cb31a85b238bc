"""The golden record: one row per customer, projected from the survivors and their core-banking identity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from kinweave.operators.history import scd2_apply, scd2_merge
from kinweave.operators.links import CERTAIN
from kinweave.operators.survivorship import ATTRIBUTES
from kinweave.schemas import GOLDEN, SCORE

VERSION_COLUMNS = ("valid_from_ts", "valid_to_ts", "current_record_indicator")
SNAPSHOT_COLUMNS = tuple(n for n in GOLDEN.names if n not in VERSION_COLUMNS)
TRACKED = tuple(n for n in SNAPSHOT_COLUMNS if n != "customer_key")


def _shown(attributes: Sequence[str]) -> str:
    values = ", ".join(f"{a}.attribute_value" for a in attributes) or "CAST(NULL AS STRING)"
    return f"core IS NOT NULL AND (is_conflict OR coalesce({values}) IS NOT NULL)"


def _snapshot_row(attributes: Sequence[str]) -> list[str]:
    """A conflicted customer shows key, CIF and token only, with score 0. An attribute without a rule is a typed NULL."""
    columns = {
        "customer_key": "customer_key",
        "primary_cif_id": "core.source_id",
        "emirates_id_token": "core.anchor_token",
        "idr_confidence_score": f"CAST(CASE WHEN is_conflict THEN 0 ELSE {CERTAIN} END AS {SCORE.simpleString()})",
        "idr_is_entity_conflict": "is_conflict",
        **{a: f"CASE WHEN NOT is_conflict THEN {a}.attribute_value END" if a in attributes else "CAST(NULL AS STRING)"
           for a in ATTRIBUTES},
    }
    columns["date_of_birth"] = f"try_cast({columns['date_of_birth']} AS DATE)"
    return [f"{columns[name]} AS {name}" for name in SNAPSHOT_COLUMNS]


def golden_snapshot(survivors: DataFrame) -> DataFrame:
    """All customers with a current core link: a projection of the survivors, no further shuffle."""
    attributes = [a for a in ATTRIBUTES if a in survivors.columns]
    return survivors.filter(_shown(attributes)).selectExpr(*_snapshot_row(attributes))


def golden_customer(survivors: DataFrame) -> DataFrame:
    """Customers whose current core links are all clean and that have a value."""
    return golden_snapshot(survivors.filter("NOT is_conflict"))


def golden_quarantined(survivors: DataFrame) -> DataFrame:
    """Customers with any quarantined core link: visible, flagged, score 0, no attribute values."""
    return golden_snapshot(survivors.filter("is_conflict"))


def golden_history(snapshot: DataFrame, dim: DataFrame, run_date: dt.date, close_missing: bool = False) -> DataFrame:
    return scd2_apply(snapshot, dim, ["customer_key"], TRACKED, run_date, close_missing=close_missing)


def golden_merge(snapshot: DataFrame, current: DataFrame, run_date: dt.date, close_missing: bool = False) -> DataFrame:
    """The part of :func:`golden_history` that a day writes, from the current records alone."""
    return scd2_merge(snapshot, current, ["customer_key"], TRACKED, run_date, close_missing=close_missing)
