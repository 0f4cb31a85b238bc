"""Survivorship rules as data: which source may supply an attribute, in what order and by which strategy."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from kinweave.schemas import COREBANKING, RULE, SALESFORCE

PRIORITY = "PRIORITY"
VERIFIED_RECENCY = "VERIFIED_RECENCY"
STRATEGIES = (PRIORITY, VERIFIED_RECENCY)
MAX_RULES = 10_000


class Rule(NamedTuple):
    attribute_name: str
    attribute_group: str
    source_system: str
    source_priority: int
    strategy: str
    rationale: str | None = None


# The default rules.
DEFAULT_RULES = (
    Rule("full_name", "IDENTITY_KYC", COREBANKING, 1, PRIORITY),
    Rule("full_name", "IDENTITY_KYC", SALESFORCE, 2, PRIORITY),
    Rule("date_of_birth", "IDENTITY_KYC", COREBANKING, 1, PRIORITY),
    Rule("date_of_birth", "IDENTITY_KYC", SALESFORCE, 2, PRIORITY),
    Rule("nationality_code", "IDENTITY_KYC", COREBANKING, 1, PRIORITY),
    Rule("gender_code", "IDENTITY_KYC", COREBANKING, 1, PRIORITY),
    Rule("language_code", "PREFERENCE", SALESFORCE, 1, PRIORITY),
    Rule("language_code", "PREFERENCE", COREBANKING, 2, PRIORITY),
    Rule("marketing_channel_code", "PREFERENCE", SALESFORCE, 1, PRIORITY),
    Rule("primary_email", "CONTACT", COREBANKING, 1, VERIFIED_RECENCY),
    Rule("primary_email", "CONTACT", SALESFORCE, 2, VERIFIED_RECENCY),
    Rule("primary_mobile", "CONTACT", COREBANKING, 1, VERIFIED_RECENCY),
    Rule("primary_mobile", "CONTACT", SALESFORCE, 2, VERIFIED_RECENCY),
)


def check_rules(rules: Iterable[Rule]) -> list[Rule]:
    rules = [Rule(*r) for r in rules]
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} survivorship rules")
    seen = set()
    for rule in rules:
        if rule.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {rule.strategy!r} for {rule.attribute_name}")
        if not rule.attribute_name or not rule.source_system or rule.source_priority is None:
            raise ValueError(f"incomplete rule {rule}")
        if (rule.attribute_name, rule.source_system) in seen:
            raise ValueError(f"two rules for {rule.attribute_name} from {rule.source_system}")
        seen.add((rule.attribute_name, rule.source_system))
    return rules


def survivorship_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rules of a CSV file with a header row, read with a fixed schema and checked. ``MAX_RULES`` bounds the read."""
    table = spark.read.csv(path, header=True, schema=RULE, enforceSchema=False, mode="FAILFAST")
    return check_rules(Rule(*row) for row in table.take(MAX_RULES + 1))


def rules_table(spark: SparkSession, rules: Iterable[Rule] = DEFAULT_RULES) -> DataFrame:
    """The checked rules as a local DataFrame, small enough to broadcast by ``MAX_RULES``."""
    return spark.createDataFrame(check_rules(rules), RULE)
