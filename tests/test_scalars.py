"""Edge rows of the scalar operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kinweave.functions import keys, masks, text, tokens
from kinweave.functions.similarity import jaro_winkler
from kinweave.operators import standardise

KEY = b"fixture-key"
EID_HEX = "9dbd19c8161b3f6ec64407a07c3797164080eb6f22ce24dbb5dcacb32250b73e"


def one(spark, column, **values):
    row = [values] if values else [{"_": 1}]
    schema = ", ".join(f"{k} {'date' if isinstance(v, dt.date) else 'string'}" for k, v in values.items()) or "_ int"
    return spark.createDataFrame(row, schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("kind, number, expected", [
    ("EMIRATES_ID", "784-1990-1234567-1", "784199012345671"),
    ("PASSPORT", " ab 12\t3", "AB123"),
    ("VISA", "123", None),
    ("EMIRATES_ID", None, None),
])
def test_document_number(spark, kind, number, expected):
    assert one(spark, text.document_number(F.col("kind"), F.col("n")), kind=kind, n=number) == expected


@pytest.mark.parametrize("raw, expected", [
    ("050-123 4567", "+971501234567"),
    ("00971 50 123 4567", "+971501234567"),
    ("+971 50 123 4567", "+971501234567"),
    ("+44 20 7946 0000", None),
    ("", None),
    (None, None),
])
def test_mobile(spark, raw, expected):
    assert one(spark, text.mobile_e164(text.digits(F.col("v"))), v=raw) == expected


def test_email(spark):
    assert one(spark, text.email(F.col("v")), v=" A@B.c ") == "a@b.c"


@pytest.mark.parametrize("tokenizer", [tokens.native_tokenizer(KEY), tokens.arrow_tokenizer(lambda: b"fixture-key")])
def test_token(spark, tokenizer):
    token = tokenizer("EID", F.col("v"))
    assert one(spark, token, v="784199012345671") == f"EID_v1_{EID_HEX}"
    assert one(spark, token, v=None) is None


def test_token_matches_hmac_for_any_key_length(spark):
    import hashlib
    import hmac

    for key in (b"", b"k" * 64, b"long key " * 20):
        expected = hmac.new(key, "متن €".encode(), hashlib.sha256).hexdigest()
        assert one(spark, tokens.pii_token("X", F.col("v"), key, 2), v="متن €") == f"X_v2_{expected}"


def test_minted_key(spark):
    assert one(spark, keys.mint_key("COREBANKING", F.col("v")), v="C1") == "CUS_83b5ecebf69becda3a8f15c4"


@pytest.mark.parametrize("mask, value, expected", [
    (masks.mask_email, "x@gmail.com", "****@gmail.com"),
    (masks.mask_email, "no at sign", "****"),
    (masks.mask_email, None, None),
    (masks.mask_mobile, "+971501234567", "+971*****567"),
    (masks.mask_mobile, None, None),
    (masks.mask_name, "Maya", "M****"),
    (masks.mask_name, None, None),
    (masks.mask_dob_year, dt.date(1990, 5, 6), dt.date(1990, 1, 1)),
    (masks.redact_varchar, "x", None),
    (masks.show_varchar, "x", "x"),
    (masks.show_date, dt.date(1990, 5, 6), dt.date(1990, 5, 6)),
])
def test_masks(spark, mask, value, expected):
    assert one(spark, mask(F.col("v")), v=value) == expected


def test_jaro_winkler_known_values(spark):
    pairs = [("martha", "marhta", 0.9611), ("abcd12345", "abcd98765678", 0.6574), ("same", "same", 1.0), ("a", "b", 0.0)]
    df = spark.createDataFrame([p[:2] for p in pairs], "a string, b string")
    got = [r["s"] for r in df.select(jaro_winkler(F.col("a"), F.col("b")).alias("s")).collect()]
    assert [round(s, 4) for s in got] == [p[2] for p in pairs]


def test_jaro_winkler_like_duckdb(spark, duck):
    rng = random.Random(7)
    alphabet = "abcdeéж"
    pairs = [
        ("".join(rng.choices(alphabet, k=rng.randint(0, 12))), "".join(rng.choices(alphabet, k=rng.randint(0, 12))))
        for _ in range(3000)
    ]
    pairs = [(a, b) for a, b in pairs if a.isascii() and b.isascii()] + [(None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("s", jaro_winkler(F.col("a"), F.col("b")))
    for row in df.collect():
        expected = duck.execute("SELECT jaro_winkler_similarity(?, ?)", [row["a"], row["b"]]).fetchall()[0][0]
        if row["a"] is None or row["b"] is None:
            assert row["s"] is None
        else:
            assert row["s"] == pytest.approx(expected, abs=1e-9), (row["a"], row["b"])


def test_similarity_with_one_very_long_text(spark):
    """A long text does not widen the work on the others, and results do not depend on the company."""
    rows = [(f"name{i % 7}", f"nmae{i % 5}") for i in range(3_000)]
    rows += [("a" * 20_000, "a" * 19_999 + "b"), (None, "x"), ("", "x"), ("محمد", "محمود"), ("José", "Jose")]
    table = spark.createDataFrame(rows, "a string, b string").repartition(1)
    got = {(r["a"], r["b"]): r["s"] for r in table.withColumn("s", jaro_winkler(F.col("a"), F.col("b"))).collect()}
    assert got[None, "x"] is None and got["", "x"] == 0 and got[rows[3_000]] > 0.99
    # Known answers: 4 of 4 and 5 letters match in order, prefix 3; 3 of 4 and 4, prefix 3.
    jaro = (4 / 4 + 4 / 5 + 1) / 3
    assert got["محمد", "محمود"] == pytest.approx(jaro + 0.3 * (1 - jaro))
    jaro = (3 / 4 + 3 / 4 + 1) / 3
    assert got["José", "Jose"] == pytest.approx(jaro + 0.3 * (1 - jaro))


def test_a_document_is_digested_once(spark):
    party = spark.createDataFrame([("C1", "P1", True)], "cif_id string, party_key string, current_record_indicator boolean")
    document = spark.createDataFrame(
        [("P1", "PASSPORT", "AE", "x1", None, True, True)],
        "party_key string, doc_type_code string, issuing_country_code string, doc_number string, expiry_date date, "
        "is_verified boolean, current_record_indicator boolean")
    anchors = standardise.anchor_documents(party, document, tokens.arrow_tokenizer(lambda: b"k"))
    plan = anchors._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("digest(") == 1
    assert anchors.first()["anchor_token"].startswith("PPT_v1_")
