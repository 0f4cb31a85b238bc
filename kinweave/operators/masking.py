"""Column masking by access tier, driven by a table of policy attachments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions import masks

PUBLIC = "PUBLIC"
T0, T1, T2, T3 = "t0_aggregate", "t1_pseudonymised", "t2_operational", "t3_privileged"

MASKS = {
    f.__name__: f
    for f in (masks.mask_email, masks.mask_mobile, masks.mask_name, masks.mask_dob_year, masks.redact_varchar,
              masks.show_varchar, masks.show_date)
}


class Policy(NamedTuple):
    mask: str
    column: str
    grantee: str
    priority: int


# The attachments on the golden record.
DEFAULT_POLICIES = (
    Policy("mask_name", "full_name", PUBLIC, 0),
    Policy("mask_email", "primary_email", PUBLIC, 0),
    Policy("mask_mobile", "primary_mobile", PUBLIC, 0),
    Policy("mask_dob_year", "date_of_birth", PUBLIC, 0),
    Policy("redact_varchar", "primary_cif_id", PUBLIC, 0),
    Policy("redact_varchar", "emirates_id_token", PUBLIC, 0),
    Policy("show_varchar", "emirates_id_token", T1, 10),
    Policy("show_varchar", "full_name", T2, 20),
    Policy("show_varchar", "primary_email", T2, 20),
    Policy("show_varchar", "primary_mobile", T2, 20),
    Policy("show_varchar", "primary_cif_id", T2, 20),
    Policy("show_varchar", "full_name", T3, 30),
    Policy("show_varchar", "primary_email", T3, 30),
    Policy("show_varchar", "primary_mobile", T3, 30),
    Policy("show_varchar", "primary_cif_id", T3, 30),
    Policy("show_varchar", "emirates_id_token", T3, 30),
    Policy("show_date", "date_of_birth", T3, 30),
)


def resolve(policies: Iterable[Policy], roles: Sequence[str]) -> dict[str, str]:
    """Mask per column: the attachment of highest priority among the caller's roles and PUBLIC."""
    grantees = {PUBLIC, *roles}
    decided: dict[str, Policy] = {}
    for policy in policies:
        if policy.mask not in MASKS:
            raise ValueError(f"unknown mask {policy.mask!r}")
        best = decided.get(policy.column)
        if policy.grantee in grantees and (best is None or policy.priority > best.priority):
            decided[policy.column] = policy
    return {column: policy.mask for column, policy in decided.items()}


def masked_view(
    df: DataFrame, roles: Sequence[str] = (), policies: Iterable[Policy] = DEFAULT_POLICIES,
) -> DataFrame:
    """``df`` as the holder of ``roles`` may see it: one narrow projection."""
    decided = resolve(policies, roles)
    return df.select(*[
        (MASKS[decided[c]](F.col(c)).cast(df.schema[c].dataType) if c in decided else F.col(c)).alias(c)
        for c in df.columns
    ])
