"""The daily run: source tables of a business date to link history, golden record, queue, devices and gold.

Steps are lazy properties. Those that several later steps read go through ``keep``, which writes them once to the
shared folder and hands back the written table; the default keeps nothing and leaves one plan per result.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame

from kinweave.functions.tokens import Tokenizer
from kinweave.operators import (
    devices, exceptions, gold, golden, history, leads, links, standardise, survivorship,
)
from kinweave.schemas import LINK
from kinweave.sources.publication import Versions
from kinweave.sources.rules import DEFAULT_RULES, Rule

Keep = Callable[[str, DataFrame], DataFrame]
Table = Callable[[], DataFrame]


def keep_nothing(name: str, df: DataFrame) -> DataFrame:
    return df


@dataclasses.dataclass(frozen=True)
class Inputs:
    """How to read the source tables, and the run's own tables as the previous run left them."""

    party: Table
    document: Table
    contact_point: Table
    account: Table
    app_user: Table
    events: Table
    xref: Versions
    #: Subjects of open exceptions, and the queue's rows of the run date.
    open_subjects: Table
    raised: Table
    bridge: Table
    dim_customer: Versions
    gold: Versions
    #: Keys of exceptions that people have resolved since the previous run.
    resolved: Table | None = None


@dataclasses.dataclass(frozen=True)
class Settings:
    """Choices a run leaves to its owner. ``close_missing``: a link or golden record whose source is gone is closed.
    ``require_verified``: only verified documents anchor a CIF. ``exclude_quarantined``: logins of quarantined links
    tie no device. ``review_leads``: leads are matched with customers and likely pairs written for review.
    ``reject_share``: part of the texts that may fail their cast before the run does."""

    close_missing: bool = False
    require_verified: bool = False
    exclude_quarantined: bool = False
    review_leads: bool = False
    reject_share: float = 0.01


@dataclasses.dataclass
class DailyRun:
    inputs: Inputs
    run_date: dt.date
    tokenizer: Tokenizer
    rules: Sequence[Rule] = DEFAULT_RULES
    keep: Keep = keep_nothing
    settings: Settings = Settings()
    #: The tokenizer of the previous run, on the day the key of the tokens changes.
    previous_tokenizer: Tokenizer | None = None

    # Links are computed from the old xref once; every later step reads the new one.

    @cached_property
    def token_bridge(self) -> DataFrame:
        return self.keep("token_bridge", standardise.token_bridge(
            self.inputs.party(), self.inputs.document(), self.previous_tokenizer, self.tokenizer))

    def _golden(self, versions: Versions) -> DataFrame:
        """Current golden records with today's tokens: a new key for tokens is no change of the customer."""
        if self.previous_tokenizer is None:
            return versions.current()
        return standardise.retokenised(versions.current(), self.token_bridge, "emirates_id_token")

    @cached_property
    def anchors(self) -> DataFrame:
        return standardise.anchor_documents(self.inputs.party(), self.inputs.document(), self.tokenizer)

    @cached_property
    def anchored_links(self) -> DataFrame:
        primary = links.primary_anchor(self.anchors, self.settings.require_verified)
        return self.keep("anchored_links", links.anchored_links(primary, self.inputs.xref.current()))

    @cached_property
    def core_links(self) -> DataFrame:
        return self.anchored_links.select(*LINK.names)

    @cached_property
    def primary(self) -> DataFrame:
        return self.anchored_links.select("cif_id", "party_key", "doc_type_code", "anchor_token", "is_quarantined")

    @cached_property
    def conflicts(self) -> DataFrame:
        return links.anchor_conflicts(self.primary.filter("is_quarantined"))

    @cached_property
    def sf_links(self) -> DataFrame:
        return self.keep("sf_links", links.salesforce_links(self.inputs.account(), self.core_links))

    @cached_property
    def app_links(self) -> DataFrame:
        return links.app_user_links(self.inputs.app_user(), self.core_links)

    @cached_property
    def links_today(self) -> DataFrame:
        return links.links_today(self.core_links, self.sf_links, self.app_links)

    # Of a table with history, a day has the versions that it writes; the whole table adds those closed before.

    @cached_property
    def xref_day(self) -> DataFrame:
        return self.keep("xref", history.xref_scd2_merge(
            self.inputs.xref.current(), self.links_today, self.run_date, self.settings.close_missing))

    @cached_property
    def xref(self) -> DataFrame:
        return self.inputs.xref.closed(None).unionByName(self.xref_day)

    @cached_property
    def contact_norm(self) -> DataFrame:
        return standardise.contact_points_norm(self.inputs.contact_point())

    @cached_property
    def candidates(self) -> DataFrame:
        """The long form, for inspection; no later step reads it."""
        return survivorship.survivorship_candidates(
            self.inputs.party(), self.inputs.account(), self.contact_norm, self.xref)

    @cached_property
    def fragments(self) -> DataFrame:
        return survivorship.survivorship_fragments(
            self.inputs.party(), self.inputs.account(), self.contact_norm, self.xref, self.primary)

    @cached_property
    def survivors(self) -> DataFrame:
        return self.keep("survivors", survivorship.surviving_values(self.fragments, self.rules))

    @cached_property
    def survivor_rows(self) -> DataFrame:
        return survivorship.surviving_rows(self.survivors)

    @cached_property
    def lineage(self) -> DataFrame:
        return survivorship.attribute_lineage(self.survivor_rows, self.run_date)

    @cached_property
    def snapshot(self) -> DataFrame:
        return golden.golden_snapshot(self.survivors)

    @cached_property
    def dim_day(self) -> DataFrame:
        return self.keep("dim_customer", golden.golden_merge(
            self.snapshot, self._golden(self.inputs.dim_customer), self.run_date, self.settings.close_missing))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.inputs.dim_customer.closed(None).unionByName(self.dim_day)

    @cached_property
    def leads(self) -> DataFrame:
        return leads.lead_rows(self.inputs.account(), self.contact_norm)

    @cached_property
    def persons(self) -> DataFrame:
        return leads.person_rows(self.snapshot)

    @cached_property
    def lead_candidates(self) -> DataFrame:
        """Pairs of a lead and a customer worth comparing."""
        return leads.lead_blocks(self.leads, self.persons)

    @cached_property
    def lead_review(self) -> DataFrame:
        """Likely pairs, for a steward. Runs jobs while it is planned, for the parameters of the scores."""
        return leads.review_leads(self.keep("lead_rows", self.leads), self.keep("person_rows", self.persons), self.keep)

    @cached_property
    def exception_candidates(self) -> DataFrame:
        return reduce(DataFrame.unionByName, (
            exceptions.exc_multi_cif(self.conflicts),
            exceptions.exc_sf_conflict(self.sf_links),
            exceptions.exc_sf_unknown_cif(self.inputs.account(), self.core_links),
            exceptions.exc_attribute_mismatch(self.survivor_rows),
        ))

    @cached_property
    def new_exceptions(self) -> DataFrame:
        return self.keep("queue", exceptions.raise_new(
            self.exception_candidates, self.inputs.open_subjects(), self.inputs.raised(), self.run_date))

    @cached_property
    def open_subjects(self) -> DataFrame:
        resolved = self.inputs.resolved() if self.inputs.resolved else None
        return exceptions.still_open(self.inputs.open_subjects(), self.new_exceptions, resolved)

    @cached_property
    def bridge(self) -> DataFrame:
        return self.keep("bridge", devices.device_bridge_upsert(
            self.inputs.bridge(), self.inputs.events(), self.xref_day, self.run_date, self.settings.exclude_quarantined))

    @cached_property
    def stitched_window(self) -> DataFrame:
        return devices.stitched_window(self.inputs.events(), self.bridge, self.run_date)

    @cached_property
    def new_stitches(self) -> DataFrame:
        return devices.new_stitches(self.inputs.events(), self.bridge, self.run_date)

    @cached_property
    def gold_day(self) -> DataFrame:
        since = self.run_date - dt.timedelta(days=devices.LATE_DAYS)
        lately = self.inputs.dim_customer.closed(since).unionByName(self.dim_day)
        return self.keep("gold", gold.gold_merge(
            self._golden(self.inputs.gold), self.inputs.gold.closed(since), gold.gold_changed_versions(lately, self.run_date)))

    @cached_property
    def gold(self) -> DataFrame:
        return self.inputs.gold.closed(None).unionByName(self.gold_day)


def register_views(run: DailyRun, prefix: str = "idr_") -> list[str]:
    """Temporary views of the run's steps, for those who ask in SQL."""
    steps = (
        "anchors", "contact_norm", "primary", "conflicts", "core_links", "sf_links", "app_links", "links_today", "xref",
        "candidates", "survivor_rows", "lineage", "snapshot", "dim_customer", "bridge", "gold")
    for step in steps:
        getattr(run, step).createOrReplaceTempView(prefix + step)
    return [prefix + step for step in steps]
