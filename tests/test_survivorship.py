"""Survivorship rules, golden record and its schema."""

import datetime as dt

import pytest

from checks.fixtures import RUN_DATE
from kinweave.operators import golden, skew, survivorship
from kinweave.schemas import GOLDEN, conform_schema, fill_columns, schema_violations
from kinweave.sources.rules import DEFAULT_RULES, Rule, check_rules, rules_table, survivorship_rules

CANDIDATE = (
    "customer_key string, source_system string, source_record_id string, attribute_name string, "
    "attribute_value string, is_verified boolean, source_effective_ts timestamp_ntz")
FRAGMENT = (
    "customer_key string, source_system string, source_record_id string, is_verified boolean, "
    "source_effective_ts timestamp_ntz, full_name string, primary_email string, gender_code string, "
    "is_linked boolean, core struct<source_id: string, anchor_token: string>, is_conflict boolean")
OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
CORE, CRM = "COREBANKING", "SALESFORCE"

# customer, source, record, attribute, value, verified, time; the expected winner of each customer's attribute below.
ROWS = [
    ("verified old beats new", CORE, "1", "primary_email", "old", True, OLD),
    ("verified old beats new", CRM, "2", "primary_email", "new", False, NEW),
    ("newest of verified", CORE, "1", "primary_email", "old", True, OLD),
    ("newest of verified", CRM, "2", "primary_email", "new", True, NEW),
    ("same time: priority", CRM, "1", "primary_email", "crm", True, NEW),
    ("same time: priority", CORE, "2", "primary_email", "core", True, NEW),
    ("same source: lowest id", CORE, "2", "primary_email", "second", True, NEW),
    ("same source: lowest id", CORE, "1", "primary_email", "first", True, NEW),
    ("no flag comes last", CORE, "1", "primary_email", "unknown", None, NEW),
    ("no flag comes last", CRM, "2", "primary_email", "unverified", False, None),
    ("priority ignores time", CORE, "9", "full_name", "core", False, OLD),
    ("priority ignores time", CRM, "1", "full_name", "crm", True, NEW),
    ("null never wins", CORE, "1", "full_name", None, True, NEW),
    ("null never wins", CRM, "2", "full_name", "crm", False, OLD),
    ("no rule, no say", CRM, "1", "gender_code", "X", True, NEW),
    ("agree", CORE, "1", "full_name", "same", True, OLD),
    ("agree", CRM, "2", "full_name", "same", False, OLD),
]
WINNERS = {
    "verified old beats new": "old", "newest of verified": "new", "same time: priority": "core",
    "same source: lowest id": "first", "no flag comes last": "unverified", "priority ignores time": "core",
    "null never wins": "crm", "agree": "same",
}


@pytest.fixture(scope="module")
def candidates(spark):
    return spark.createDataFrame(ROWS, CANDIDATE)


@pytest.fixture(scope="module")
def fragments(spark):
    records = [
        (c, s, r, v, t, *(value if a == name else None for name in ("full_name", "primary_email", "gender_code")),
         None, None, None)
        for c, s, r, a, value, v, t in ROWS]
    markers = [(c, None, None, None, None, None, None, None, True, (f"CIF {c}", None), False) for c in {r[0] for r in ROWS}]
    return spark.createDataFrame(records + markers, FRAGMENT)


def test_ranked(candidates):
    ranked = survivorship.survivorship_ranked(candidates).collect()
    assert {r["customer_key"]: r["attribute_value"] for r in ranked if r["survivor_rank"] == 1} == WINNERS
    counts = {r["customer_key"]: r["distinct_value_count"] for r in ranked}
    assert counts["agree"] == 1 and counts["newest of verified"] == 2 and counts["null never wins"] == 1


def test_survivors_agree_with_ranking(fragments):
    rows = survivorship.surviving_rows(survivorship.surviving_values(fragments))
    assert {r["customer_key"]: r["attribute_value"] for r in rows.collect()} == WINNERS


def test_lineage_flags(fragments):
    rows = survivorship.surviving_rows(survivorship.surviving_values(fragments))
    flags = {
        r["customer_key"]: (r["is_corroborated"], r["has_source_mismatch"])
        for r in survivorship.attribute_lineage(rows, RUN_DATE).collect()}
    assert flags["agree"] == (True, False)
    assert flags["newest of verified"] == (False, True)
    assert flags["null never wins"] == (False, False)


@pytest.mark.parametrize("ranges", [1, 4, 37])
def test_ranks_do_not_depend_on_ranges(spark, rows, ranges):
    """A third of all rows in one group, with ties but for the record id; against a plain sort."""
    data = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 500) END AS customer_key",
        "CASE WHEN id % 2 = 0 THEN 'COREBANKING' ELSE 'SALESFORCE' END AS source_system",
        "concat('r', lpad(CAST(id * 7919 % 3001 AS STRING), 5, '0')) AS source_record_id",
        "'primary_email' AS attribute_name", "concat('v', id % 40) AS attribute_value", "id % 5 = 0 AS is_verified",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, id % 50) AS source_effective_ts")
    priority = {r.source_system: r.source_priority for r in DEFAULT_RULES if r.attribute_name == "primary_email"}
    groups = {}
    for r in data.collect():
        if r["source_system"] in priority:
            groups.setdefault(r["customer_key"], []).append(r)
    expected = []
    for key, own in groups.items():
        own.sort(key=lambda r: (not r["is_verified"], -r["source_effective_ts"].timestamp(), priority[r["source_system"]], r["source_record_id"]))
        expected += [(key, r["source_record_id"], i, len({x["attribute_value"] for x in own})) for i, r in enumerate(own, 1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = {}

    def keep(name, df):
        seen[name] = skew.checkpointed(name, df)
        return seen[name]

    try:
        found = survivorship.survivorship_ranked(data, keep=keep)
        assert rows(found, "customer_key", "source_record_id", "survivor_rank", "distinct_value_count") == sorted(expected, key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = seen["ranked_ranges"].filter("customer_key = 'hot'").groupBy("_range").count().collect()
    assert len(hot) >= ranges // 3 and max(r["count"] for r in hot) <= 2 * 3000 // ranges
    windows = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "row_number()" in line and "Window" in line]
    assert windows and all("_range" in line[line.index("],"):] for line in windows)


def test_unlinked_contacts_do_not_make_a_customer(spark, fragments):
    stray = spark.createDataFrame(
        [("nobody", CORE, "1", True, NEW, None, "e", None, None, None, None)], FRAGMENT)
    survivors = survivorship.surviving_values(fragments.unionByName(stray))
    assert survivors.filter("customer_key = 'nobody'").isEmpty()


def _full(spark, rows):
    wide = spark.createDataFrame(rows, FRAGMENT)
    for name in survivorship.ATTRIBUTES:
        if name not in wide.columns:
            wide = wide.selectExpr("*", f"CAST(NULL AS STRING) AS {name}")
    return survivorship.surviving_values(wide)


def test_golden_conflict_and_highest_cif(spark):
    survivors = _full(spark, [
        ("K1", CORE, "C1", True, NEW, "Name", None, None, None, None, None),
        ("K1", None, None, None, None, None, None, None, True, ("C1", "token 1"), False),
        ("K1", None, None, None, None, None, None, None, True, ("C2", None), False),
        ("K2", CORE, "C3", True, NEW, "Other", None, None, None, None, None),
        ("K2", None, None, None, None, None, None, None, True, ("C3", "token 3"), False),
        ("K2", None, None, None, None, None, None, None, False, ("C4", "token 4"), True),
        ("K3", None, None, None, None, None, None, None, True, ("C5", None), False),
    ])
    got = {r["customer_key"]: r for r in golden.golden_snapshot(survivors).collect()}
    assert set(got) == {"K1", "K2"}  # K3 is linked but has no value
    assert (got["K1"]["primary_cif_id"], got["K1"]["emirates_id_token"], got["K1"]["full_name"]) == ("C2", None, "Name")
    assert (got["K2"]["idr_is_entity_conflict"], float(got["K2"]["idr_confidence_score"])) == (True, 0.0)
    assert (got["K2"]["full_name"], got["K2"]["emirates_id_token"]) == (None, "token 4")
    assert [r["customer_key"] for r in golden.golden_customer(survivors).collect()] == ["K1"]
    assert [r["customer_key"] for r in golden.golden_quarantined(survivors).collect()] == ["K2"]


def test_golden_history_is_idempotent(case, rows):
    once = golden.golden_history(case.run.snapshot, case.fx.fx_dim_prior, RUN_DATE)
    assert rows(golden.golden_history(case.run.snapshot, once, RUN_DATE)) == rows(once)
    current = once.filter("current_record_indicator")
    assert current.count() == current.select("customer_key").distinct().count()


def test_survivors_take_one_shuffle(case):
    """From written links to survivors, the only hash exchange is the one by customer."""
    plan = survivorship.surviving_values(case.run.fragments)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text[:text.index("Initial Plan")] if "Initial Plan" in text else text
    assert final.count("Exchange hashpartitioning") == 1


def test_rules_from_csv(spark, tmp_path):
    header = "attribute_name,attribute_group,source_system,source_priority,strategy,rationale\n"
    body = "".join(f"{r.attribute_name},{r.attribute_group},{r.source_system},{r.source_priority},{r.strategy},\n"
                   for r in DEFAULT_RULES)
    path = tmp_path / "rules.csv"
    path.write_text(header + body)
    assert survivorship_rules(spark, str(path)) == list(DEFAULT_RULES)
    assert rules_table(spark).count() == 13
    path.write_text(header + "a,G,S,1,NEWEST,\n")
    with pytest.raises(ValueError, match="unknown strategy"):
        survivorship_rules(spark, str(path))
    with pytest.raises(ValueError, match="two rules"):
        check_rules([Rule("a", "G", "S", 1, "PRIORITY")] * 2)
    with pytest.raises(ValueError, match="incomplete"):
        check_rules([Rule("a", "G", "S", None, "PRIORITY")])


def test_conform_schema(spark):
    row = [("K", "M" * 2, dt.date(1990, 1, 1), OLD, NEW, True)]
    columns = "customer_key string, gender_code string, date_of_birth date, valid_from_ts timestamp_ntz, " \
              "valid_to_ts timestamp_ntz, current_record_indicator boolean"
    broken = fill_columns(spark.createDataFrame(row, columns), GOLDEN)
    assert "gender_code: longer than 1" in schema_violations(broken).first()["violations"]
    with pytest.raises(Exception, match="longer than 1"):
        conform_schema(broken).collect()
    fits = broken.selectExpr("* EXCEPT (gender_code)", "'M' AS gender_code")
    assert conform_schema(fits).columns == GOLDEN.names and schema_violations(fits).isEmpty()
    missing = fits.selectExpr("* EXCEPT (customer_key)", "CAST(NULL AS STRING) AS customer_key")
    assert "customer_key: missing" in schema_violations(missing).first()["violations"]


def test_rule_sets_other_than_the_default(case):
    """A rule removed, added and reprioritised; an unknown attribute is refused."""
    fragments = case.run.fragments

    def snapshot(rules):
        survivors = survivorship.surviving_values(fragments, rules)
        return {r["customer_key"]: r.asDict() for r in golden.golden_snapshot(survivors).collect()}

    before = snapshot(DEFAULT_RULES)
    without = snapshot([r for r in DEFAULT_RULES if r.attribute_name != "gender_code"])
    assert without == {k: v | {"gender_code": None} for k, v in before.items()}
    flipped = [r._replace(source_priority=3 - r.source_priority) if r.attribute_name == "full_name" else r for r in DEFAULT_RULES]
    assert any(after["full_name"] != before[k]["full_name"] for k, after in snapshot(flipped).items())
    added = [*DEFAULT_RULES, Rule("nationality_code", "IDENTITY_KYC", "SALESFORCE", 2, "PRIORITY")]
    assert snapshot(added) == before
    with pytest.raises(ValueError, match="unknown attribute"):
        snapshot([*DEFAULT_RULES, Rule("shoe_size", "IDENTITY_KYC", "SALESFORCE", 1, "PRIORITY")])
