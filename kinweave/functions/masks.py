"""Column masks. Every mask keeps NULL as NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(value: Column) -> Column:
    """Keeps the domain. A value without ``@`` is hidden whole."""
    at = F.instr(value, "@")
    return F.when(at > 0, F.concat(F.lit("****"), F.substr(value, at))).when(value.isNotNull(), F.lit("****"))


def mask_mobile(value: Column) -> Column:
    return F.concat(F.lit("+971*****"), F.right(value, F.lit(3)))


def mask_name(value: Column) -> Column:
    return F.concat(F.left(value, F.lit(1)), F.lit("****"))


def mask_dob_year(value: Column) -> Column:
    return F.trunc(value, "year")


def redact_varchar(value: Column) -> Column:
    return F.lit(None).cast("string")


def show_varchar(value: Column) -> Column:
    return value


def show_date(value: Column) -> Column:
    return value
