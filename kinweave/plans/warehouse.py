"""A business date end to end on a folder of Parquet tables: read, resolve, check, publish.

Layout under the root: ``source/<table>`` and ``events`` (partitioned by ``event_date``) as delivered, and what runs publish, see
:mod:`kinweave.sources.publication`: ``state/<table>/<run>`` and ``_manifests``. A run starts from the manifest of the date
before, writes each table once, to where it stays, and publishes all of them in one step or none. ``source/exception_resolution``, if
there is one, names the exceptions that people have resolved, by ``exception_key``.

Events are never rewritten: a run adds the customers it has found for anonymous ones, a row for each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.tokens import Tokenizer
from kinweave.operators import devices
from kinweave.operators.gold import VERSION_KEY
from kinweave.operators.golden import SNAPSHOT_COLUMNS
from kinweave.operators.history import XREF_KEYS
from kinweave.operators.links import R1_EID, R1_PASSPORT, R2, R3
from kinweave.operators.quality import Casts, Measured, dq_relationships, dq_unique, is_incomplete, is_unknown, require_clean
from kinweave.plans.daily import DailyRun, Inputs, Settings
from kinweave.schemas import BRIDGE, EXCEPTION, GOLDEN, LEAD_REVIEW, LINEAGE, OPEN_SUBJECT, REJECT, STITCH, XREF, conform_schema
from kinweave.sources.publication import Attempt, Manifest, Versions, _Files, published, read_folders, read_versions
from kinweave.sources.rules import DEFAULT_RULES, Rule
from kinweave.sources.tables import read_table

#: Tables with history, with the key their current versions are bucketed by.
HISTORY = {"xref": (XREF, XREF_KEYS), "dim_customer": (GOLDEN, ("customer_key",)), "gold": (GOLDEN, VERSION_KEY)}
#: Tables without history; the queue and the stitches have a slot for each date.
PLAIN = {
    "bridge": BRIDGE, "lineage": LINEAGE, "lead_review": LEAD_REVIEW, "cast_rejects": REJECT, "open_subjects": OPEN_SUBJECT, "queue": EXCEPTION,
    "stitches": STITCH}
#: Buckets of the tables with history, once and for all: each should take a few hundred MB.
BUCKETS = 200


def history(spark: SparkSession, root: str, manifest: Manifest | None, table: str) -> Versions:
    schema, keys = HISTORY[table]
    return read_versions(spark, root, manifest, table, schema, keys)


def state(spark: SparkSession, root: str, manifest: Manifest | None, table: str, slot: dt.date | None = None) -> DataFrame:
    """A published table: whole, or one date's slot of it."""
    if table in HISTORY:
        slices = history(spark, root, manifest, table)
        return slices.current().unionByName(slices.closed(None))
    bounds = (slot.isoformat(), (slot + dt.timedelta(days=1)).isoformat()) if slot else ()
    return read_folders(spark, root, manifest.folders(table, *bounds) if manifest else [], PLAIN[table])


def events(spark: SparkSession, root: str, manifest: Manifest | None, since: dt.date | None = None) -> DataFrame:
    """Events as delivered, with the customers that published runs have given them. ``since`` limits what is read."""
    delivered = read_table(spark, f"{root}/events")
    given = manifest.folders("stitches", since.isoformat() if since else "") if manifest else []
    if since:
        delivered = delivered.filter(F.col("event_date") >= F.lit(since))
    if not given:
        return delivered
    return devices.with_stitches(delivered, read_folders(spark, root, given, STITCH))


def open_inputs(spark: SparkSession, root: str, previous: Manifest | None, run_date: dt.date) -> Inputs:
    """Tables of a run; on the first one (``previous`` is None) the state is empty."""
    def source(name: str):
        return lambda: read_table(spark, f"{root}/source/{name}")

    resolution = f"{root}/source/exception_resolution"
    since = run_date - dt.timedelta(days=devices.LATE_DAYS)
    return Inputs(
        party=source("dim_party"), document=source("dim_identification_document"),
        contact_point=source("dim_contact_point"), account=source("sf_person_account"),
        app_user=source("map_app_user_cif"), events=lambda: events(spark, root, previous, since),
        xref=history(spark, root, previous, "xref"), bridge=lambda: state(spark, root, previous, "bridge"),
        open_subjects=lambda: state(spark, root, previous, "open_subjects"),
        raised=lambda: state(spark, root, previous, "queue", run_date),
        dim_customer=history(spark, root, previous, "dim_customer"), gold=history(spark, root, previous, "gold"),
        resolved=(lambda: read_table(spark, resolution)) if _Files(spark, root).exists(resolution) else None,
    )


class _Writer:
    """Writes a run's tables as its steps are asked for, counting rows that break a check on the way."""

    def __init__(self, attempt: Attempt):
        self.attempt = attempt
        self.offending = {
            "xref": {
                "incomplete link": is_incomplete(["customer_key", "match_rule_code", "valid_from_ts"]),
                "unknown match rule": is_unknown("match_rule_code", [R1_EID, R1_PASSPORT, R2, R3])},
            "queue": {"incomplete exception": is_incomplete(["exception_key", "exception_type_code", "source_id"])},
        }

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        measured = Measured(df, self.offending[name]) if name in self.offending else None
        rows = measured.table if measured else df
        if name in HISTORY:
            schema, keys = HISTORY[name]
            found = self.attempt.versions(name, conform_schema(rows) if schema is GOLDEN else rows, keys)
        elif name == "queue":
            found = self.attempt.whole(name, rows, self.attempt.run_date.isoformat())
        elif name in PLAIN:
            found = self.attempt.whole(name, rows)
        else:
            found = self.attempt.scratch(name, rows)
        if measured:
            measured.require_clean()
        return found


def _checks(run: DailyRun) -> None:
    """What cannot be seen row by row. Current slices are bucketed by their keys, so no key is shuffled to count it."""
    links = run.xref_day.filter("current_record_indicator")
    golden = run.dim_day.filter("current_record_indicator")
    require_clean(dq_unique(links, XREF_KEYS), "one current link per source record")
    require_clean(dq_unique(golden, ["customer_key"]), "one current golden record per customer")
    require_clean(dq_relationships(golden, run.xref, ["customer_key"]), "every golden record has a link")
    require_clean(dq_unique(run.bridge, ["customer_key", "device_key"]), "one row per customer and device")
    require_clean(dq_unique(run.gold_day, VERSION_KEY), "one gold row per version")


def run_day(
    spark: SparkSession, root: str, run_date: dt.date, tokenizer: Tokenizer, rules: Sequence[Rule] = DEFAULT_RULES,
    settings: Settings = Settings(), buckets: int = BUCKETS, previous_tokenizer: Tokenizer | None = None,
) -> Manifest:
    """Resolves one date from what is published for the date before it. Nothing is published unless the quality checks pass.

    On the first date under a new key of the tokens, ``previous_tokenizer`` is that of the old key.
    """
    previous = published(spark, root, before=run_date)
    attempt = Attempt(spark, root, run_date, previous, buckets)
    try:
        run = DailyRun(
            open_inputs(spark, root, previous, run_date), run_date, tokenizer, rules, _Writer(attempt).keep, settings,
            previous_tokenizer)
        if "date_of_birth" in run.survivors.columns:
            casts = Casts(run.survivors, "dim_customer", "customer_key", {
                "date_of_birth": (F.col("date_of_birth.attribute_value"), "date")})
            attempt.whole("cast_rejects", casts.rejects)
            casts.require_share(settings.reject_share)
        attempt.whole("lineage", run.lineage)
        attempt.by_day("stitches", run.new_stitches, "event_date")
        attempt.whole("open_subjects", run.open_subjects)
        if settings.review_leads:
            attempt.whole("lead_review", run.lead_review)
        _checks(run)
        return attempt.publish()
    finally:
        attempt.close()


def golden_view(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    """Current golden records as published for a date."""
    return history(spark, root, manifest, "gold").current().select(*SNAPSHOT_COLUMNS)
