"""Links, link history, exceptions and quality checks on hand-made edge rows, and their invariants on the fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.fixtures import RUN_DATE, TOKEN_KEY
from kinweave.functions.tokens import native_tokenizer
from kinweave.operators import exceptions, history, links, quality, standardise
from kinweave.schemas import EXCEPTION, LINK, XREF, fill_columns

PARTY = "cif_id string, party_key string, current_record_indicator boolean"
DOCUMENT = (
    "party_key string, doc_type_code string, issuing_country_code string, doc_number string, expiry_date date, "
    "is_verified boolean, current_record_indicator boolean")
ANCHOR = "cif_id string, party_key string, doc_type_code string, anchor_token string, is_verified boolean, expiry_date date"
ACCOUNT = (
    "salesforce_account_id string, cif_external_id string, last_modified_ts timestamp_ntz, is_deleted boolean, "
    "current_record_indicator boolean")
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def link(source_id, key, rule="R1_EID_EXACT", quarantined=False, system="COREBANKING"):
    return (system, source_id, key, rule, None, quarantined)


def test_bad_documents_keep_their_row_without_token(spark):
    party = spark.createDataFrame([("C1", "P1", True), ("C2", "P2", False)], PARTY)
    documents = [
        ("P1", "EMIRATES_ID", "ARE", "784-12", None, True, True),
        ("P1", "PASSPORT", None, "ab 1", None, True, True),
        ("P1", "PASSPORT", "IN", " ab 1 ", None, True, True),
        ("P1", "VISA", "IN", "1", None, True, True),
        ("P1", "EMIRATES_ID", "ARE", "784199012345671", None, True, False),
        ("P2", "EMIRATES_ID", "ARE", "784199012345671", None, True, True),
    ]
    got = standardise.anchor_documents(
        party, spark.createDataFrame(documents, DOCUMENT), native_tokenizer(TOKEN_KEY)).collect()
    assert len(got) == 3 and {r["cif_id"] for r in got} == {"C1"}
    assert [r["anchor_token"] is None for r in sorted(got, key=lambda r: str(r["anchor_token"]))] == [True, True, False]


def test_primary_anchor_order(spark):
    rows = [
        ("C1", "P", "PASSPORT", "p", True, dt.date(2030, 1, 1)), ("C1", "P", "EMIRATES_ID", "e", False, None),
        ("C2", "P", "EMIRATES_ID", "old", True, dt.date(2025, 1, 1)),
        ("C2", "P", "EMIRATES_ID", "new", False, dt.date(2030, 1, 1)),
        ("C3", "P", "PASSPORT", "a", True, None), ("C3", "P", "PASSPORT", "z", True, dt.date(2020, 1, 1)),
        ("C4", "P", "PASSPORT", "b", True, dt.date(2020, 1, 1)), ("C4", "P", "PASSPORT", "a", True, dt.date(2020, 1, 1)),
        ("C5", "P", "PASSPORT", None, True, None),
        ("C6", "P", "PASSPORT", "unknown", None, None), ("C6", "P", "PASSPORT", "unverified", False, None),
    ]
    anchors = spark.createDataFrame(rows, ANCHOR)
    best = {r["cif_id"]: r["anchor_token"] for r in links.primary_anchor(anchors).collect()}
    assert best == {"C1": "e", "C2": "old", "C3": "z", "C4": "a", "C6": "unverified"}
    verified = {r["cif_id"]: r["anchor_token"] for r in links.primary_anchor(anchors, require_verified=True).collect()}
    assert verified == {"C1": "p", "C2": "old", "C3": "z", "C4": "a"}


def test_salesforce_quarantine_reasons(spark):
    core = spark.createDataFrame(
        [link("C1", "K1"), link("C2", "K2"), link("C3", "K3", quarantined=True), link("C4", "K4")], LINK)
    accounts = spark.createDataFrame([
        ("clean", " C1 ", ts(1), False, True),
        ("two", "C2", ts(3), False, True), ("two", "C4", ts(1), False, True),
        ("older", "C4", ts(1), False, True), ("tie", "C4", None, False, True),
        ("conflicted", "C3", ts(1), False, True),
        ("unknown", "C9", ts(1), False, True), ("lead", None, ts(1), False, True),
        ("gone", "C1", ts(9), True, True), ("past", "C1", ts(9), False, False),
    ], ACCOUNT)
    got = {(r["source_id"], r["customer_key"]): r["is_quarantined"] for r in links.salesforce_links(accounts, core).collect()}
    assert got == {
        ("clean", "K1"): False, ("two", "K2"): True, ("two", "K4"): True, ("older", "K4"): False,
        ("tie", "K4"): True, ("conflicted", "K3"): True}
    # "older" and "two" share CIF and time, so the lower account id is the latest; "tie" has no time and comes last.
    assert [r["salesforce_account_id"] for r in links.route_leads(accounts).collect()] == ["lead"]


def test_collapse_to_one_link_per_record(spark):
    empty = spark.createDataFrame([], LINK)
    apps = spark.createDataFrame([
        link("A", "K2", "R3_APP_USER_ID", False, "AMPLITUDE"), link("A", "K1", "R3_APP_USER_ID", False, "AMPLITUDE"),
        link("B", "K1", "R3_APP_USER_ID", False, "AMPLITUDE")], LINK)
    got = {r["source_id"]: (r["customer_key"], r["is_quarantined"]) for r in links.links_today(empty, empty, apps).collect()}
    assert got == {"A": ("K1", True), "B": ("K1", False)}


def test_conflicts_have_one_shape_at_any_size(spark):
    for n in (3, 10_000, 20_000):
        def keys(count):
            primary = spark.range(count + 1).selectExpr(
                "concat('C', id) AS cif_id", f"CASE WHEN id < {count} THEN 'shared' ELSE 'own' END AS anchor_token")
            report = links.anchor_conflicts(primary)
            raised = exceptions.raise_exceptions(exceptions.exc_multi_cif(report), spark.createDataFrame([], EXCEPTION), D1)
            return {r["exception_key"] for r in raised.collect()}, report
        before, report = keys(n)
        after, _ = keys(n + 1)
        assert len(before) == n and len(after - before) == 1 and before < after
        assert report.filter(f"cif_count <> {n} OR anchor_token <> 'shared'").isEmpty()


def test_link_history(spark, rows):
    start = spark.createDataFrame([], XREF)
    day1 = history.xref_scd2_apply(start, spark.createDataFrame([link("C1", "K1"), link("C2", "K2", None)], LINK), D1)
    assert day1.count() == 2
    changed = spark.createDataFrame([link("C1", "K1", "R1_PASSPORT_EXACT"), link("C2", "K2"), link("C3", "K3")], LINK)
    day2 = history.xref_scd2_apply(day1, changed, D2)
    got = {
        (r["source_id"], r["match_rule_code"], r["valid_from_ts"].day, r["valid_to_ts"].year, r["current_record_indicator"])
        for r in day2.collect()}
    assert got == {
        ("C1", "R1_EID_EXACT", 1, 2024, False), ("C1", "R1_PASSPORT_EXACT", 2, 9999, True),
        ("C2", None, 1, 2024, False), ("C2", "R1_EID_EXACT", 2, 9999, True), ("C3", "R1_EID_EXACT", 2, 9999, True)}
    assert rows(history.xref_scd2_apply(day2, changed, D2)) == rows(day2)

    # A correction on the same date replaces the version opened that date.
    corrected = spark.createDataFrame([link("C1", "K9"), link("C2", "K2"), link("C3", "K3")], LINK)
    fixed = history.xref_scd2_apply(day2, corrected, D2).filter("source_id = 'C1'").collect()
    assert {(r["customer_key"], r["current_record_indicator"]) for r in fixed} == {("K1", False), ("K9", True)}

    # A vanished record stays open unless told otherwise.
    fewer = spark.createDataFrame([link("C2", "K2")], LINK)
    kept = history.xref_scd2_apply(day2, fewer, dt.date(2024, 1, 3))
    assert kept.filter("current_record_indicator").count() == 3
    closed = history.xref_scd2_apply(day2, fewer, dt.date(2024, 1, 3), close_missing=True)
    assert closed.filter("current_record_indicator").count() == 1


def test_two_steps_equal_one_pass(case, rows):
    xref, today = case.fx.fx_xref_prior, case.run.links_today
    closed = history.xref_close(xref, today, RUN_DATE)
    both = closed.unionByName(history.xref_open(closed, today, RUN_DATE))
    assert rows(both) == rows(history.xref_scd2_apply(xref, today, RUN_DATE), *both.columns)


def test_xref_invariants(case):
    xref = case.run.xref
    assert quality.dq_unique(xref.filter("current_record_indicator"), history.XREF_KEYS).isEmpty()
    overlap = xref.alias("a").join(xref.alias("b"), list(history.XREF_KEYS)).filter(
        "a.valid_from_ts < b.valid_from_ts AND a.valid_to_ts > b.valid_from_ts")
    assert overlap.isEmpty()
    assert quality.dq_relationships(case.run.snapshot, xref, ["customer_key"]).isEmpty()


def test_links_do_not_depend_on_row_order(spark, case, rows):
    shuffled = case.fx.fx_document.repartition(7, "doc_number")
    again = links.primary_anchor(standardise.anchor_documents(case.fx.fx_party, shuffled, case.tokenizer))
    assert rows(again) == rows(links.primary_anchor(case.run.anchors))


def candidate(spark, type_code="SF_UNKNOWN_CIF", source_id="S1", detail="d"):
    return spark.createDataFrame(
        [(type_code, "SALESFORCE", source_id, None, detail, f"{type_code}|{source_id}|{detail}")],
        "exception_type_code string, source_system string, source_id string, candidate_customer_keys array<string>, "
        "detail string, identity string")


def test_exceptions_are_raised_once(spark):
    queue = spark.createDataFrame([], EXCEPTION)
    first = exceptions.raise_exceptions(candidate(spark), queue, D1)
    assert [r["status_code"] for r in first.collect()] == ["OPEN"]
    assert exceptions.raise_exceptions(candidate(spark), first, D1).isEmpty()
    assert exceptions.raise_exceptions(candidate(spark), first, D2).isEmpty()
    resolved = first.withColumn("status_code", F.lit("RESOLVED"))
    assert exceptions.raise_exceptions(candidate(spark), resolved, D1).isEmpty()
    assert exceptions.raise_exceptions(candidate(spark), resolved, D2).count() == 1


def test_second_mismatch_of_a_customer_is_not_hidden(spark):
    open_one = exceptions.raise_exceptions(
        candidate(spark, "KYC_MISMATCH", "K1", "attribute=full_name"), spark.createDataFrame([], EXCEPTION), D1)
    other = candidate(spark, "KYC_MISMATCH", "K1", "attribute=date_of_birth")
    assert exceptions.raise_exceptions(other, open_one, D2).count() == 1
    assert exceptions.raise_exceptions(candidate(spark, "KYC_MISMATCH", "K1", "attribute=full_name"), open_one, D2).isEmpty()


def test_raising_twice_adds_nothing(case):
    raised = case.run.new_exceptions
    queue = fill_columns(case.fx.fx_exception_prior, EXCEPTION).unionByName(raised)
    assert exceptions.raise_exceptions(case.run.exception_candidates, queue, RUN_DATE).isEmpty()


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, v int")
    assert [tuple(r) for r in quality.dq_unique(df, ["k", "v"]).collect()] == [("a", 1, 2)]
    assert quality.dq_not_null(df, ["k", "v"]).count() == 2
    assert [tuple(r) for r in quality.dq_relationships(df, df.filter("k = 'a'"), ["k"]).collect()] == [("b", 1)]
    assert [r["k"] for r in quality.dq_accepted_values(df, "k", ["a"]).collect()] == ["b"]
    quality.require_clean(df.filter("v = 9"), "nothing wrong")
    with pytest.raises(quality.QualityError, match="doubles"):
        quality.require_clean(quality.dq_unique(df, ["k"]), "doubles")
