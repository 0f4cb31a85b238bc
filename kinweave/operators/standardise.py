"""Identity documents and contact points in the normal form that matching relies on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import text
from kinweave.functions.tokens import Tokenizer
from kinweave.operators import skew

# Token types.
EID_TOKEN = "EID"
PASSPORT_TOKEN = "PPT"


def document_norm(documents: DataFrame) -> DataFrame:
    return documents.withColumn("doc_number_norm", text.document_number(F.col("doc_type_code"), F.col("doc_number")))


def anchor_documents(party: DataFrame, document: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Identity documents of current parties with the token that serves as match key.

    An Emirates ID of the wrong shape and a passport without number or country keep their row with no token.
    Both join sides come straight from a scan, so adaptive execution splits a party with very many documents.
    """
    parties = party.filter("current_record_indicator").select("cif_id", "party_key")
    documents = document_norm(
        document.filter(F.col("current_record_indicator") & F.col("doc_type_code").isin(text.EMIRATES_ID, text.PASSPORT)))
    number = F.col("doc_number_norm")
    is_eid = F.col("doc_type_code") == text.EMIRATES_ID
    # One message a row, digested once: a CASE around two digests would not keep Python from computing both.
    message = F.when(is_eid & number.rlike(text.EMIRATES_ID_FORMAT), number).when(
        ~is_eid, F.concat("issuing_country_code", F.lit("|"), number))
    documents = documents.withColumn("_message", message)
    token = tokenizer(F.when(is_eid, EID_TOKEN).otherwise(PASSPORT_TOKEN), F.col("_message"))
    tokenised = documents.select("party_key", "doc_type_code", token.alias("anchor_token"), "is_verified", "expiry_date")
    return parties.join(tokenised, "party_key").select(
        "cif_id", "party_key", "doc_type_code", "anchor_token", "is_verified", "expiry_date")


def contact_points_norm(contact_point: DataFrame) -> DataFrame:
    """Current contact points; a mobile that is not a valid UAE number has no normal form."""
    kind, value = F.col("contact_type_code"), F.col("contact_value")
    return (
        contact_point.filter("current_record_indicator")
        .withColumn("_digits", F.when(kind == text.MOBILE, text.digits(value)))
        .select(
            "contact_point_key", "customer_key", "source_system", "source_id", "contact_type_code",
            F.when(kind == text.EMAIL, text.email(value))
            .when(kind == text.MOBILE, text.mobile_e164(F.col("_digits")))
            .otherwise(value).alias("contact_value_norm"),
            "is_primary", "is_verified", "is_deleted", "source_effective_ts",
        )
    )


def token_bridge(party: DataFrame, document: DataFrame, old: Tokenizer, new: Tokenizer) -> DataFrame:
    """``old_token, new_token`` of every anchor document, from the source, for a change of the tokens' key.

    A token cannot be turned into another; both are computed from the number, in one pass. A token stands for one number, so the pairs are
    unique on either side.
    """
    def both(kind: str | Column, number: Column) -> Column:
        return F.concat_ws("\u0001", old(kind, number), new(kind, number))

    pair = F.split(F.col("anchor_token"), "\u0001")
    return anchor_documents(party, document, both).filter("anchor_token <> ''").select(
        pair[0].alias("old_token"), pair[1].alias("new_token")).distinct()


def retokenised(df: DataFrame, bridge: DataFrame, column: str) -> DataFrame:
    """``df`` with the old tokens of ``column`` replaced by the new ones; one whose document is gone stays."""
    answers = bridge.select(F.col("old_token").alias(column), F.col("new_token").alias("_new_token"))
    found = skew.lookup(df, answers, column)
    return found.select(*[F.coalesce("_new_token", column).alias(c) if c == column else F.col(c) for c in df.columns])
