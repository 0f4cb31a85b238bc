"""One runnable query per operator, over the fixtures derived from the given tables.

Upstream steps that several later ones read are written to the shared folder, as the daily run does; the operator
under test stays the lazy result. Far-future timestamps and arrays are returned as text, so that any client can
read them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, RUN_DATE, TOKEN_KEY, TOKEN_KEY_2, Fixtures
from kinweave.functions import keys, masks, tokens
from kinweave.operators import (
    devices, exceptions, gold, golden, history, leads, links, masking, quality, serving, standardise, survivorship,
)
from kinweave.plans.daily import DailyRun, Inputs, Keep
from kinweave.schemas import COREBANKING, EXCEPTION, conform_schema, fill_columns
from kinweave.session import shared_folder
from kinweave.sources.publication import Versions
from kinweave.sources.rules import rules_table, survivorship_rules
from kinweave.sources.tables import written

# Fixed weights for the scoring queries: (m, u) for exact, close, near and different values of any field.
LEAD_WEIGHTS = {3: (0.80, 0.02), 2: (0.10, 0.02), 1: (0.05, 0.06), 0: (0.05, 0.90)}
LEAD_PRIOR = 0.001
# Attributes whose change opens a new version in the history query.
HISTORY_TRACKED = ("full_name", "date_of_birth", "nationality_code", "gender_code", "language_code")
EM_ROUNDS = 8
# Steps that more than one branch of a single query reads.
KEPT = ("anchored_links", "sf_links", "xref", "bridge", "candidates")


class Case:
    """Fixtures and the steps between them for one (session, scale factor)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.fx = Fixtures.of(spark, sf_dir)

    @cached_property
    def tokenizer(self) -> tokens.Tokenizer:
        return tokens.native_tokenizer(TOKEN_KEY)

    @cached_property
    def run(self) -> DailyRun:
        return DailyRun(Inputs(
            party=lambda: self.fx.fx_party, document=lambda: self.fx.fx_document,
            contact_point=lambda: self.fx.fx_contact_point, account=lambda: self.fx.fx_sf_account,
            app_user=lambda: self.fx.fx_app_user, events=lambda: self.fx.fx_app_event,
            xref=Versions.of(lambda: self.fx.fx_xref_prior), bridge=lambda: self.fx.fx_bridge_prior,
            open_subjects=lambda: exceptions.open_subjects(self.fx.queue()),
            raised=lambda: fill_columns(self.fx.queue(), EXCEPTION).filter(F.col("detected_date") == F.lit(RUN_DATE)),
            dim_customer=Versions.of(lambda: self.fx.fx_dim_prior), gold=Versions.of(lambda: self.fx.fx_gold_prior),
        ), RUN_DATE, self.tokenizer, keep=written(self.spark, KEPT))

    @cached_property
    def dim_new(self) -> DataFrame:
        return history.scd2_apply(
            self.run.snapshot, self.fx.fx_dim_prior, ["customer_key"], HISTORY_TRACKED, RUN_DATE)

    @cached_property
    def keep(self) -> Keep:
        return written(self.spark)

    @cached_property
    def pairs(self) -> DataFrame:
        return leads.lead_blocks(self.fx.fx_lead, self.fx.fx_person)

    @cached_property
    def compared(self) -> DataFrame:
        sides = (leads.told_repeats(self.fx.fx_lead), leads.told_repeats(self.fx.fx_person))
        return leads.lead_compare(leads.lead_blocks(*sides, ("repeats",), bundled=True, apart="repeats"))

    @cached_property
    def weights(self) -> list[leads.Weight]:
        return [leads.Weight(f, level, m, u) for f in leads.FIELDS for level, (m, u) in LEAD_WEIGHTS.items()]

    @cached_property
    def scored(self) -> DataFrame:
        return leads.lead_score(self.compared, self.weights, LEAD_PRIOR)


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _joined(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.array_join(column, ","))


def _versions(df: DataFrame) -> DataFrame:
    return _text(df, "valid_from_ts", "valid_to_ts")


def _document_norm(c: Case) -> DataFrame:
    return standardise.document_norm(c.fx.fx_document).select("party_key", "doc_type_code", "doc_number_norm")


def _token(tokenizer: tokens.Tokenizer, c: Case) -> DataFrame:
    return c.fx.fx_party.select("cif_id", tokenizer("CIF", F.col("cif_id")).alias("token"))


def _mint_key(c: Case) -> DataFrame:
    return c.fx.fx_party.select("cif_id", keys.mint_key(COREBANKING, F.col("cif_id")).alias("customer_key"))


def _conflicts(c: Case) -> DataFrame:
    return links.anchor_conflicts(links.primary_anchor(c.run.anchors))


def _sf_links(c: Case) -> DataFrame:
    return links.salesforce_links(c.fx.fx_sf_account, c.run.core_links)


def _rule_use(c: Case) -> DataFrame:
    """The rules, read from a CSV file written from the default ones, with the number of values each one governs."""
    path = f"{shared_folder(c.spark)}/rules-{uuid.uuid4().hex}"
    rules_table(c.spark).write.option("header", True).csv(path)
    rules = survivorship_rules(c.spark, path)
    used = c.run.candidates.groupBy("attribute_name", "source_system").agg(
        F.count("attribute_value").alias("value_count"))
    return rules_table(c.spark, rules).drop("rationale").join(
        used, ["attribute_name", "source_system"], "left").fillna(0, ["value_count"])


def _ranked(c: Case) -> DataFrame:
    candidates = c.run.keep("candidates", c.run.candidates)
    return survivorship.survivorship_ranked(candidates, keep=c.keep).drop("is_verified")


def _masked(roles: Sequence[str]) -> Callable[[Case], DataFrame]:
    return lambda c: masking.masked_view(c.run.snapshot, roles)


def _mask(table: str, column: str, mask) -> Callable[[Case], DataFrame]:
    def query(c: Case) -> DataFrame:
        source = c.run.contact_norm if table == "contact" else c.fx.fx_party
        return source.select(
            "contact_point_key" if table == "contact" else "cif_id", mask(F.col(column)).alias("masked"))
    return query


def _show(c: Case) -> DataFrame:
    return c.fx.fx_party.select(
        "cif_id", masks.redact_varchar(F.col("full_name")).alias("redacted"),
        masks.show_varchar(F.col("full_name")).alias("shown_text"),
        masks.show_date(F.col("date_of_birth")).alias("shown_date"))


def _raised(c: Case) -> DataFrame:
    return _joined(c.run.new_exceptions, "candidate_customer_keys")


def _candidates(build: Callable[[Case], DataFrame]) -> Callable[[Case], DataFrame]:
    return lambda c: _joined(build(c), "candidate_customer_keys")


def _relationships(c: Case) -> DataFrame:
    """Current CIFs that got no link because no document of theirs yields a token."""
    return quality.dq_relationships(
        c.fx.fx_party.filter("current_record_indicator"),
        links.primary_anchor(c.run.anchors).select("cif_id"), ["cif_id"])


def _score(c: Case) -> DataFrame:
    scored = leads.lead_score(c.compared, c.weights, LEAD_PRIOR, digits=(6, 9))
    return scored.select("lead_id", "person_id", "match_weight", "match_probability")


def _review(c: Case) -> DataFrame:
    sides = leads.lead_classes(c.fx.fx_lead), leads.lead_classes(c.fx.fx_person)
    scored = leads.lead_score(leads.class_pairs(*sides, c.keep), c.weights, LEAD_PRIOR)
    return leads.lead_review(*sides, scored).select(
        "lead_id", "person_id", F.round("match_weight", 6).alias("match_weight"),
        F.round("match_probability", 9).alias("match_probability"), "link_class")


def _estimate_m(c: Case) -> DataFrame:
    people, people_u = leads.lead_patterns(c.compared), leads.lead_estimate_u(c.fx.fx_lead, c.fx.fx_person)
    weights, _ = leads.lead_estimate_m(people, people_u, rounds=EM_ROUNDS)
    return leads.weights_table(people, weights).select(
        "field", "level", F.round("m", 6).alias("m"), F.round("u", 6).alias("u"))


QUERIES: dict[str, Callable[[Case], DataFrame]] = {
    "document_norm": _document_norm,
    "anchor_documents": lambda c: c.run.anchors,
    "pii_token": lambda c: _token(c.tokenizer, c),
    "pii_token_arrow": lambda c: _token(tokens.arrow_tokenizer(lambda: b"fixture-key"), c),
    "contact_points_norm": lambda c: c.run.contact_norm,
    "primary_anchor": lambda c: links.primary_anchor(c.run.anchors),
    "anchor_conflicts": _conflicts,
    "corebanking_links": lambda c: links.corebanking_links(
        links.primary_anchor(c.run.anchors), c.fx.fx_xref_prior),
    "mint_key": _mint_key,
    "salesforce_links": _sf_links,
    "app_user_links": lambda c: links.app_user_links(c.fx.fx_app_user, c.run.core_links),
    "links_today": lambda c: c.run.links_today,
    "route_leads": lambda c: links.route_leads(c.fx.fx_sf_account),
    "xref_close": lambda c: _versions(history.xref_close(c.fx.fx_xref_prior, c.run.links_today, RUN_DATE)),
    "xref_open": lambda c: _versions(history.xref_open(
        history.xref_close(c.fx.fx_xref_prior, c.run.links_today, RUN_DATE), c.run.links_today, RUN_DATE)),
    "xref_scd2_apply": lambda c: _versions(
        history.xref_scd2_apply(c.fx.fx_xref_prior, c.run.links_today, RUN_DATE)),
    "exc_multi_cif": _candidates(lambda c: exceptions.exc_multi_cif(_conflicts(c))),
    "exc_sf_conflict": _candidates(lambda c: exceptions.exc_sf_conflict(_sf_links(c))),
    "exc_sf_unknown_cif": _candidates(
        lambda c: exceptions.exc_sf_unknown_cif(c.fx.fx_sf_account, c.run.core_links)),
    "raise_exceptions": _raised,
    "exc_attribute_mismatch": _candidates(lambda c: exceptions.exc_attribute_mismatch(c.run.survivor_rows)),
    "survivorship_rules": _rule_use,
    "candidates_core": lambda c: survivorship.candidates_core(c.fx.fx_party, c.run.xref),
    "candidates_sf": lambda c: survivorship.candidates_sf(c.fx.fx_sf_account, c.run.xref),
    "candidates_contact": lambda c: survivorship.candidates_contact(c.run.contact_norm, c.run.xref),
    "survivorship_candidates": lambda c: c.run.candidates,
    "survivorship_ranked": _ranked,
    "attribute_lineage": lambda c: c.run.lineage,
    "golden_customer": lambda c: golden.golden_customer(c.run.survivors),
    "golden_quarantined": lambda c: golden.golden_quarantined(c.run.survivors),
    "golden_snapshot": lambda c: c.run.snapshot,
    "scd2_apply": lambda c: _versions(c.dim_new),
    "golden_history": lambda c: _versions(golden.golden_history(c.run.snapshot, c.fx.fx_dim_prior, RUN_DATE)),
    "device_bridge_upsert": lambda c: devices.device_bridge_upsert(
        c.fx.fx_bridge_prior, c.fx.fx_app_event, c.run.xref, RUN_DATE),
    "single_owner_devices": lambda c: devices.single_owner_devices(c.run.bridge),
    "stitch_events": lambda c: devices.stitch_events(c.fx.fx_app_event, c.run.bridge, RUN_DATE),
    "gold_changed_versions": lambda c: _versions(gold.gold_changed_versions(c.fx.fx_dim_prior, RUN_DATE)),
    "gold_upsert": lambda c: _versions(gold.gold_upsert(
        c.fx.fx_gold_prior, gold.gold_changed_versions(c.fx.fx_dim_prior, RUN_DATE))),
    "mask_email": _mask("contact", "contact_value_norm", masks.mask_email),
    "mask_mobile": _mask("contact", "contact_value_norm", masks.mask_mobile),
    "mask_name": _mask("party", "full_name", masks.mask_name),
    "mask_dob_year": _mask("party", "date_of_birth", masks.mask_dob_year),
    "redact_and_show": _show,
    "masked_view_t0": _masked(()),
    "masked_view_t1": _masked((masking.T1,)),
    "masked_view_t2": _masked((masking.T2,)),
    "masked_view_t3": _masked((masking.T3,)),
    "car_personalisation": lambda c: serving.car_personalisation(c.fx.fx_car_daily, c.fx.fx_consent, AS_OF),
    "car_risk_features": lambda c: serving.car_risk_features(c.fx.fx_car_daily),
    "dq_unique": lambda c: quality.dq_unique(c.fx.fx_sf_account, ["salesforce_account_id"]),
    "dq_not_null": lambda c: quality.dq_not_null(c.run.contact_norm, ["contact_value_norm"]),
    "dq_relationships": _relationships,
    "dq_accepted_values": lambda c: quality.dq_accepted_values(
        c.run.contact_norm, "contact_type_code", ["EMAIL", "MOBILE"]),
    "cast_rejects": lambda c: quality.Casts(
        c.fx.fx_document, "dim_identification_document", "party_key", {"doc_number": (F.col("doc_number"), "bigint")}).rejects,
    "token_bridge": lambda c: standardise.token_bridge(
        c.fx.fx_party, c.fx.fx_document, c.tokenizer, tokens.native_tokenizer(TOKEN_KEY_2, 2)),
    "conform_schema": lambda c: _versions(conform_schema(c.dim_new)),
    "lead_rows": lambda c: leads.lead_rows(c.fx.fx_sf_account, c.run.contact_norm),
    "person_rows": lambda c: leads.person_rows(c.run.snapshot),
    "lead_candidates": lambda c: c.run.lead_candidates.select("lead_id", "person_id", "block"),
    "lead_blocks": lambda c: c.pairs.select("lead_id", "person_id", "block"),
    "lead_block_members": lambda c: leads.lead_block_members(c.fx.fx_lead, c.fx.fx_person),
    "lead_compare": lambda c: c.compared,
    "lead_estimate_u": lambda c: leads.lead_estimate_u(c.fx.fx_lead, c.fx.fx_person),
    "lead_estimate_m": _estimate_m,
    "lead_score": _score,
    "lead_review": _review,
    "lead_classify": lambda c: leads.lead_classify(c.scored).select("lead_id", "person_id", "link_class"),
}


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Case(spark, sf_dir))
