"""Masking policies as data: which mask a grantee gets on a column, and which attachment wins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kinweave.operators.masking import DEFAULT_POLICIES, MASKS, PUBLIC, Policy
from kinweave.schemas import GOLDEN

POLICY = T.StructType([
    T.StructField("mask", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("grantee", T.StringType()),
    T.StructField("priority", T.IntegerType()),
])
#: Policies are the driver's to resolve; more of them are a mistake in the file.
MAX_POLICIES = 10_000


def check_policies(policies: Iterable[Sequence], schema: T.StructType = GOLDEN) -> list[Policy]:
    """The policies, if each names a known mask that fits the type of a known column, and none contradicts another."""
    policies = [Policy(*p) for p in policies]
    if len(policies) > MAX_POLICIES:
        raise ValueError(f"more than {MAX_POLICIES} masking policies")
    seen: dict[tuple, Policy] = {}
    for policy in policies:
        if policy.mask not in MASKS:
            raise ValueError(f"unknown mask {policy.mask!r}")
        if policy.column not in schema.names:
            raise ValueError(f"a policy names the unknown column {policy.column!r}")
        if not policy.grantee or policy.priority is None:
            raise ValueError(f"incomplete policy {policy}")
        is_date = isinstance(schema[policy.column].dataType, T.DateType)
        if is_date != (policy.mask in ("mask_dob_year", "show_date")):
            raise ValueError(f"mask {policy.mask} does not fit column {policy.column}")
        if (other := seen.setdefault((policy.column, policy.grantee, policy.priority), policy)) is not policy:
            raise ValueError(f"two policies of one priority: {other} and {policy}")
    hidden = {p.column for p in policies if p.grantee == PUBLIC}
    for policy in policies:
        if policy.column not in hidden:
            raise ValueError(f"column {policy.column} is open to all but those with a policy: it lacks one for {PUBLIC}")
    return policies


def masking_policies(spark: SparkSession, path: str, schema: T.StructType = GOLDEN) -> list[Policy]:
    """Policies of a CSV file with a header row, read with a fixed schema and checked."""
    table = spark.read.csv(path, header=True, schema=POLICY, enforceSchema=False, mode="FAILFAST")
    return check_policies((tuple(row) for row in table.take(MAX_POLICIES + 1)), schema)


def policies_table(spark: SparkSession, policies: Iterable[Policy] = DEFAULT_POLICIES) -> DataFrame:
    """The checked policies as a local DataFrame."""
    return spark.createDataFrame([tuple(p) for p in check_policies(policies)], POLICY)
