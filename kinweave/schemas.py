"""Schemas of the tables the operators read and write.

Timestamps are zone-free (``TimestampNTZType``) so that a run date means the same instant whatever the
session time zone is. Maximum lengths of the golden record ride along as field metadata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORE = T.DecimalType(5, 4)
OPEN_END = "9999-12-31"

COREBANKING = "COREBANKING"
SALESFORCE = "SALESFORCE"
AMPLITUDE = "AMPLITUDE"
C360 = "C360"


def _text(name: str, max_length: int, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, {"max_length": max_length})


LINK = T.StructType([
    T.StructField("source_system", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("customer_key", T.StringType()),
    T.StructField("match_rule_code", T.StringType()),
    T.StructField("idr_confidence_score", SCORE),
    T.StructField("is_quarantined", T.BooleanType()),
])

XREF = T.StructType(LINK.fields + [
    T.StructField("valid_from_ts", T.TimestampNTZType()),
    T.StructField("valid_to_ts", T.TimestampNTZType()),
    T.StructField("current_record_indicator", T.BooleanType()),
    T.StructField("_batch_run_date", T.StringType()),
])

EXCEPTION = T.StructType([
    T.StructField("exception_key", T.StringType()),
    T.StructField("exception_type_code", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("candidate_customer_keys", T.ArrayType(T.StringType())),
    T.StructField("detail", T.StringType()),
    T.StructField("detected_date", T.DateType()),
    T.StructField("status_code", T.StringType()),
    T.StructField("resolved_by", T.StringType()),
    T.StructField("resolved_ts", T.TimestampNTZType()),
])

BRIDGE = T.StructType([
    T.StructField("customer_key", T.StringType()),
    T.StructField("device_key", T.StringType()),
    T.StructField("first_linked_ts", T.TimestampNTZType()),
    T.StructField("last_seen_ts", T.TimestampNTZType()),
])

STITCH = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("customer_key", T.StringType()),
])

OPEN_SUBJECT = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("exception_key", T.StringType()),
])

LEAD_REVIEW = T.StructType([
    T.StructField("lead_id", T.StringType()),
    T.StructField("person_id", T.StringType()),
    T.StructField("match_weight", T.DoubleType()),
    T.StructField("match_probability", T.DoubleType()),
    T.StructField("link_class", T.StringType()),
])

REJECT = T.StructType([
    T.StructField(n, T.StringType()) for n in ("table_name", "row_key", "column_name", "raw_text", "reason")])

LINEAGE = T.StructType([
    T.StructField("customer_key", T.StringType()),
    T.StructField("attribute_name", T.StringType()),
    T.StructField("winning_source_system", T.StringType()),
    T.StructField("winning_source_record_id", T.StringType()),
    T.StructField("survivorship_strategy", T.StringType()),
    T.StructField("is_corroborated", T.BooleanType()),
    T.StructField("has_source_mismatch", T.BooleanType()),
    T.StructField("snapshot_date", T.DateType()),
])

RULE = T.StructType([
    T.StructField("attribute_name", T.StringType()),
    T.StructField("attribute_group", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_priority", T.IntegerType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("rationale", T.StringType()),
])

# The golden record as declared for serving, with its maximum text lengths.
GOLDEN = T.StructType([
    _text("customer_key", 40, nullable=False),
    _text("primary_cif_id", 256),
    _text("emirates_id_token", 256),
    _text("full_name", 256),
    T.StructField("date_of_birth", T.DateType()),
    _text("nationality_code", 3),
    _text("gender_code", 1),
    _text("language_code", 5),
    _text("marketing_channel_code", 20),
    _text("primary_email", 256),
    _text("primary_mobile", 256),
    T.StructField("idr_confidence_score", SCORE),
    T.StructField("idr_is_entity_conflict", T.BooleanType()),
    T.StructField("valid_from_ts", T.TimestampNTZType(), False),
    T.StructField("valid_to_ts", T.TimestampNTZType(), False),
    T.StructField("current_record_indicator", T.BooleanType(), False),
])


def _broken(field: T.StructField, source: Column) -> Column:
    """Reason a value breaks its field, NULL if it does not."""
    value = source.try_cast(field.dataType)
    reason = F.when(source.isNotNull() & value.isNull(), F.lit(f"{field.name}: not a {field.dataType.simpleString()}"))
    if not field.nullable:
        reason = reason.when(source.isNull(), F.lit(f"{field.name}: missing"))
    if "max_length" in field.metadata:
        limit = field.metadata["max_length"]
        reason = reason.when(F.char_length(value) > limit, F.lit(f"{field.name}: longer than {limit}"))
    return reason


def schema_violations(df: DataFrame, schema: T.StructType = GOLDEN) -> DataFrame:
    """Rows of ``df`` that break the schema, with the broken fields listed in ``violations``."""
    reasons = F.array_compact(F.array(*[_broken(f, F.col(f.name)) for f in schema.fields]))
    return df.withColumn("violations", F.array_join(reasons, "; ")).filter(F.col("violations") != "")


def conform_schema(df: DataFrame, schema: T.StructType = GOLDEN) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; a value that does not fit fails the job."""
    def fit(field: T.StructField) -> Column:
        value = F.col(field.name).try_cast(field.dataType)
        reason = _broken(field, F.col(field.name))
        return F.when(reason.isNotNull(), F.raise_error(reason).cast(field.dataType)).otherwise(value).alias(field.name)

    return df.select(*[fit(f) for f in schema.fields])


def fill_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the shape of ``schema``, columns it lacks filled with typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
