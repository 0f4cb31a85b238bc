"""Normal forms of identity documents and contact details."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Document and contact type codes, and the number formats that make a match key.
EMIRATES_ID = "EMIRATES_ID"
PASSPORT = "PASSPORT"
EMAIL = "EMAIL"
MOBILE = "MOBILE"
EMIRATES_ID_FORMAT = "^784[0-9]{12}$"
LOCAL_MOBILE_FORMAT = "^05[0-9]{8}$"
EXIT_CODE_MOBILE_FORMAT = "^00971[0-9]{9}$"
COUNTRY_CODE_MOBILE_FORMAT = "^971[0-9]{9}$"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def document_number(doc_type: Column, number: Column) -> Column:
    """Emirates ID: digits only. Passport: upper case without white space. Any other type: NULL."""
    return F.when(doc_type == EMIRATES_ID, digits(number)).when(
        doc_type == PASSPORT, F.upper(F.regexp_replace(number, r"\s", "")))


def mobile_e164(number_digits: Column) -> Column:
    """E.164 form of a UAE mobile given as digits; NULL for any other shape."""
    return (
        F.when(number_digits.rlike(LOCAL_MOBILE_FORMAT), F.concat(F.lit("+971"), F.substr(number_digits, F.lit(2))))
        .when(number_digits.rlike(EXIT_CODE_MOBILE_FORMAT), F.concat(F.lit("+"), F.substr(number_digits, F.lit(3))))
        .when(number_digits.rlike(COUNTRY_CODE_MOBILE_FORMAT), F.concat(F.lit("+"), number_digits))
    )


def email(value: Column) -> Column:
    return F.lower(F.trim(value))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))
