"""Which source's value survives for each attribute of a customer.

The working form is wide: one *fragment* per source record, with a column per attribute it can supply, and one marker
per current link. Survivors and the core identity of a customer come from one aggregation by customer, so a record is shuffled once rather than once per attribute, and each
group combines before the shuffle however many records share a customer. The long (attribute, value) form is
unpivoted from fragments or survivors without a shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions import ordering, text
from kinweave.operators import skew
from kinweave.schemas import COREBANKING, SALESFORCE
from kinweave.sources.rules import DEFAULT_RULES, VERIFIED_RECENCY, Rule, check_rules, rules_table

CORE_ATTRIBUTES = ("full_name", "date_of_birth", "nationality_code", "gender_code", "language_code")
SF_ATTRIBUTES = ("full_name", "date_of_birth", "language_code", "marketing_channel_code")
CONTACT_ATTRIBUTES = ("primary_email", "primary_mobile")
ATTRIBUTES = CORE_ATTRIBUTES + ("marketing_channel_code",) + CONTACT_ATTRIBUTES

_RECORD = ("customer_key", "source_system", "source_record_id", "is_verified", "source_effective_ts")


def clean_links(xref: DataFrame) -> DataFrame:
    return xref.filter(F.col("current_record_indicator") & ~F.col("is_quarantined"))


def _linked(records: DataFrame, xref: DataFrame, system: str, attributes: Sequence[str]) -> DataFrame:
    links = clean_links(xref).filter(F.col("source_system") == system).select(
        F.col("source_id").alias("source_record_id"), "customer_key")
    return skew.lookup(records, links, "source_record_id", "inner").withColumn("source_system", F.lit(system)).select(
        *_RECORD, *attributes)


def core_fragments(party: DataFrame, xref: DataFrame) -> DataFrame:
    records = party.filter("current_record_indicator").select(
        F.col("cif_id").alias("source_record_id"),
        F.lit(True).alias("is_verified"),
        F.col("source_updated_ts").alias("source_effective_ts"),
        "full_name", F.col("date_of_birth").cast("string").alias("date_of_birth"),
        "nationality_code", "gender_code", "language_code",
    )
    return _linked(records, xref, COREBANKING, CORE_ATTRIBUTES)


def sf_fragments(account: DataFrame, xref: DataFrame) -> DataFrame:
    """CRM records; a name with no parts is missing, not empty."""
    records = account.filter(F.col("current_record_indicator") & ~F.col("is_deleted")).select(
        F.col("salesforce_account_id").alias("source_record_id"),
        F.lit(False).alias("is_verified"),
        F.col("last_modified_ts").alias("source_effective_ts"),
        text.blank_to_null(F.concat_ws(" ", "first_name", "last_name")).alias("full_name"),
        F.col("birthdate").cast("string").alias("date_of_birth"),
        F.col("preferred_language_code").alias("language_code"),
        F.col("preferred_channel_code").alias("marketing_channel_code"),
    )
    return _linked(records, xref, SALESFORCE, SF_ATTRIBUTES)


def _contact_points(contact_norm: DataFrame) -> DataFrame:
    """Live primary e-mails and mobiles."""
    kind, value = F.col("contact_type_code"), F.col("contact_value_norm")
    return contact_norm.filter(
        F.col("is_primary") & ~F.col("is_deleted") & kind.isin(text.EMAIL, text.MOBILE)
    ).select(
        "customer_key", "source_system", F.col("source_id").alias("source_record_id"), "is_verified",
        "source_effective_ts",
        F.when(kind == text.EMAIL, value).alias("primary_email"),
        F.when(kind == text.MOBILE, value).alias("primary_mobile"),
        kind.alias("_kind"),
    )


def link_markers(xref: DataFrame, primary: DataFrame) -> DataFrame:
    """Per current link what it says of its customer: whether it is clean, and for core links the CIF with its own
    Emirates ID token and whether it conflicts."""
    tokens = primary.filter(F.col("doc_type_code") == text.EMIRATES_ID).select(
        F.col("cif_id").alias("source_id"), "anchor_token")
    current = xref.filter("current_record_indicator")
    clean = (~F.col("is_quarantined")).alias("is_linked")
    core = current.filter(F.col("source_system") == COREBANKING).join(tokens, "source_id", "left").select(
        "customer_key", clean, F.struct("source_id", "anchor_token").alias("core"), F.col("is_quarantined").alias("is_conflict"))
    others = current.filter(F.col("source_system") != COREBANKING).select("customer_key", clean)
    return core.unionByName(others, allowMissingColumns=True)


def survivorship_fragments(
    party: DataFrame, account: DataFrame, contact_norm: DataFrame, xref: DataFrame, primary: DataFrame,
) -> DataFrame:
    """All fragments and link markers in one table, to be aggregated by customer once.

    Contact points name their customer themselves, so they are not joined to the links here: the markers in the
    same aggregation tell whether the customer has a clean link.
    """
    parts = (
        sf_fragments(account, xref), _contact_points(contact_norm).drop("_kind"), link_markers(xref, primary))
    table = core_fragments(party, xref)
    for part in parts:
        table = table.unionByName(part, allowMissingColumns=True)
    return table


def _unpivot(fragments: DataFrame, attributes: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{a}', `{a}`" for a in attributes)
    unpivoted = f"stack({len(attributes)}, {pairs}) AS (attribute_name, attribute_value)"
    return fragments.selectExpr(*_RECORD, unpivoted).select(
        "customer_key", "source_system", "source_record_id", "attribute_name", "attribute_value", "is_verified",
        "source_effective_ts")


def candidates_core(party: DataFrame, xref: DataFrame) -> DataFrame:
    return _unpivot(core_fragments(party, xref), CORE_ATTRIBUTES)


def candidates_sf(account: DataFrame, xref: DataFrame) -> DataFrame:
    return _unpivot(sf_fragments(account, xref), SF_ATTRIBUTES)


def candidates_contact(contact_norm: DataFrame, xref: DataFrame) -> DataFrame:
    """Contact points of customers that have a link out of quarantine."""
    points = skew.lookup(
        _contact_points(contact_norm), clean_links(xref).select("customer_key"), "customer_key", "left_semi")
    return points.select(
        "customer_key", "source_system", "source_record_id",
        F.concat(F.lit("primary_"), F.lower("_kind")).alias("attribute_name"),
        F.coalesce("primary_email", "primary_mobile").alias("attribute_value"), "is_verified", "source_effective_ts")


def survivorship_candidates(party: DataFrame, account: DataFrame, contact_norm: DataFrame, xref: DataFrame) -> DataFrame:
    return (
        candidates_core(party, xref)
        .unionByName(candidates_sf(account, xref))
        .unionByName(candidates_contact(contact_norm, xref))
    )


def _preference(strategy: str, priority: str) -> str:
    """Sort key of a candidate: verification and recency where the strategy asks for them, then source, then id."""
    by_recency = f"{strategy} = '{VERIFIED_RECENCY}'"
    dated = f"(CASE WHEN {by_recency} THEN source_effective_ts END)"
    return (
        f"CASE WHEN {by_recency} THEN {ordering.true_first('is_verified')} ELSE 2 END, "
        f"{ordering.latest_ts_first(dated)}, {priority}, source_record_id")


def survivorship_ranked(
    candidates: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, keep: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every candidate that may compete, with its rank and the number of distinct values in its group.

    For inspection: the golden record needs only the winners, see :func:`surviving_values`. Sources without a rule
    for an attribute and NULL values do not compete. Groups are ranked across ranges of the sorted candidates, so one that holds a
    third of them is spread like any other; ``keep`` writes the ranges, see :func:`kinweave.operators.skew.ranked`.
    """
    group = ["customer_key", "attribute_name"]
    config = rules_table(candidates.sparkSession, rules).select(
        "attribute_name", "source_system", "strategy", "source_priority")
    competing = candidates.filter(F.col("attribute_value").isNotNull()).join(
        F.broadcast(config), ["attribute_name", "source_system"])
    order = F.expr(f"struct({_preference('strategy', 'source_priority')}, attribute_value)")
    return skew.ranked(competing, group, order, "survivor_rank", "attribute_value", "distinct_value_count", keep)


def surviving_values(fragments: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Per customer and attribute the winning value, as one struct column per attribute.

    Struct fields: ``attribute_value, source_system, source_record_id, strategy, candidate_count,
    has_source_mismatch``; NULL if no source has a value. Rules become constants of the plan. ``core``, ``is_linked``
    and ``is_conflict`` sum up the link markers; customers without any current link are left out.
    """
    by_attribute: dict[str, list[Rule]] = {}
    for rule in check_rules(rules):
        if rule.attribute_name not in ATTRIBUTES:
            raise ValueError(f"a rule names the unknown attribute {rule.attribute_name!r}")
        by_attribute.setdefault(rule.attribute_name, []).append(rule)
    attributes = [a for a in fragments.columns if a in by_attribute]

    def per_source(attribute: str, field: str) -> str:
        arms = " ".join(
            f"WHEN {ordering.literal(r.source_system)} THEN {ordering.literal(getattr(r, field))}"
            for r in by_attribute[attribute])
        return f"(CASE source_system {arms} END)"

    aggregates = []
    for a in attributes:
        strategy = per_source(a, "strategy")
        value = f"(CASE WHEN {strategy} IS NOT NULL THEN `{a}` END)"
        preference = _preference(strategy, per_source(a, "source_priority"))
        aggregates += [
            f"min(CASE WHEN {value} IS NOT NULL THEN struct({preference}, `{a}` AS attribute_value, source_system, "
            f"{strategy} AS strategy) END) AS `{a}_best`",
            f"min({value}) <> max({value}) AS `{a}_differs`",
            f"count({value}) AS `{a}_count`",
        ]
    aggregates += [
        "bool_or(is_linked) AS is_linked", "max(core) AS core", "coalesce(bool_or(is_conflict), false) AS is_conflict"]
    grouped = fragments.groupBy("customer_key").agg(*map(F.expr, aggregates)).filter("is_linked OR is_conflict")
    return grouped.selectExpr("customer_key", "core", "is_linked", "is_conflict", *[
        f"CASE WHEN `{a}_best` IS NOT NULL THEN struct(`{a}_best`.attribute_value, `{a}_best`.source_system, "
        f"`{a}_best`.source_record_id, `{a}_best`.strategy, `{a}_count` AS candidate_count, "
        f"`{a}_differs` AS has_source_mismatch) END AS `{a}`"
        for a in attributes
    ])


def surviving_rows(survivors: DataFrame) -> DataFrame:
    """:func:`surviving_values` as one row per customer and attribute that has a value."""
    attributes = [c for c in survivors.columns if c in ATTRIBUTES]
    rows = ", ".join(
        f"CASE WHEN `{a}` IS NOT NULL THEN struct('{a}' AS attribute_name, `{a}`.*) END" for a in attributes)
    return survivors.filter("is_linked").selectExpr("customer_key", f"inline(array_compact(array({rows})))")


def attribute_lineage(survivor_rows: DataFrame, run_date: dt.date) -> DataFrame:
    """Where each surviving value came from and whether the candidates agreed."""
    mismatch = F.col("has_source_mismatch")
    return survivor_rows.select(
        "customer_key", "attribute_name",
        F.col("source_system").alias("winning_source_system"),
        F.col("source_record_id").alias("winning_source_record_id"),
        F.col("strategy").alias("survivorship_strategy"),
        (~mismatch & (F.col("candidate_count") > 1)).alias("is_corroborated"),
        mismatch.alias("has_source_mismatch"),
        F.lit(run_date).alias("snapshot_date"),
    )
