"""Business dates on a warehouse folder: a changed document, a late event, runs that die, a re-run, what is written and read."""

import datetime as dt
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.fixtures import TOKEN_KEY, TOKEN_KEY_2
from kinweave.functions.tokens import native_tokenizer
from kinweave.operators.gold import gold_merge
from kinweave.operators.history import XREF_KEYS, xref_scd2_merge
from kinweave.operators.quality import Casts, Measured, QualityError, dq_unique, is_incomplete, is_unknown
from kinweave.plans.daily import Settings, register_views
from kinweave.plans.warehouse import HISTORY, PLAIN, events, golden_view, history, run_day, state
from kinweave.schemas import LEAD_REVIEW, LINK
from kinweave.sources import publication
from kinweave.sources.publication import CURRENT, Attempt, manifests, published, remove, unreferenced
from kinweave.sources.tables import read_table

DAYS = [dt.date(2024, 1, 4), dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
SOURCES = {
    "dim_party": "fx_party", "dim_identification_document": "fx_document", "dim_contact_point": "fx_contact_point",
    "sf_person_account": "fx_sf_account", "map_app_user_cif": "fx_app_user"}


@pytest.fixture(scope="module")
def warehouse(spark, case, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    for name, fixture in SOURCES.items():
        getattr(case.fx, fixture).write.parquet(f"{root}/source/{name}")
    case.fx.fx_app_event.write.partitionBy("event_date").parquet(f"{root}/events")
    return root


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def contents(spark, root, manifest):
    found = {t: rows_of(state(spark, root, manifest, t)) for t in (*HISTORY, *PLAIN)}
    return found | {"events": rows_of(events(spark, root, manifest))}


def size_of(root, folders):
    return sum(p.stat().st_size for f in folders for p in Path(root, f).rglob("*.parquet"))


def change_sources(spark, case, root):
    """A customer with passport only gets an Emirates ID; a login arrives two days late. Returns the customer's CIF."""
    links = state(spark, root, published(spark, root), "xref")
    cif = links.filter("match_rule_code = 'R1_PASSPORT_EXACT'").orderBy("source_id").first()["source_id"]
    party = f"PTY{int(cif[3:])}"
    documents = case.fx.fx_document.filter(f"party_key <> '{party}' OR doc_type_code = 'PASSPORT'").unionByName(
        case.fx.fx_document.limit(1).withColumns({
            "party_key": F.lit(party), "doc_type_code": F.lit("EMIRATES_ID"), "doc_number": F.lit("784-1999-7654321-9")}))
    documents.write.mode("overwrite").parquet(f"{root}/source/dim_identification_document")
    late = case.fx.fx_app_event.filter("event_date = DATE'2024-01-03'").limit(1).withColumns({
        "event_id": F.lit(10**9).cast("long"), "device_key": F.lit("LATE"), "amplitude_user_id": F.lit("APP8")})
    late.write.mode("append").partitionBy("event_date").parquet(f"{root}/events")
    return cif


def test_three_days_crashes_and_a_rerun(spark, case, warehouse, monkeypatch):
    root, tokenizer = warehouse, native_tokenizer(TOKEN_KEY)
    before = read_table(spark, f"{root}/events").count()
    run = partial(run_day, spark, root, tokenizer=tokenizer, buckets=4)
    run(DAYS[0])
    one = published(spark, root)
    links = state(spark, root, one, "xref")
    assert links.filter("current_record_indicator").count() == links.count() > 0
    first = contents(spark, root, one)
    cif = change_sources(spark, case, root)
    first["events"] = rows_of(events(spark, root, one))

    # Whatever a run has written when it dies, the published state is as it was: looked at after every write.
    writes = []

    def watched(method):
        def write(self, name, *args, **kwargs):
            found = method(self, name, *args, **kwargs)
            writes.append(name)
            assert published(spark, root).tables == one.tables
            return found
        return write

    def dies(self):
        raise InterruptedError

    with monkeypatch.context() as patched:
        for name in ("scratch", "whole", "by_day", "versions"):
            patched.setattr(Attempt, name, watched(getattr(Attempt, name)))
        patched.setattr(Attempt, "publish", dies)
        with pytest.raises(InterruptedError):
            run(DAYS[1])
    assert set(writes) > {*HISTORY, *PLAIN} - {"lead_review"} and len(manifests(spark, root)) == 1
    left = unreferenced(spark, root)
    assert {f.split("/")[1] for f in left} == {*HISTORY, *PLAIN} - {"lead_review"}
    remove(spark, root, left)
    assert unreferenced(spark, root) == [] and contents(spark, root, published(spark, root)) == first

    run(DAYS[1])
    two = published(spark, root, DAYS[1])
    versions = state(spark, root, two, "xref").filter(F.col("source_id") == cif).orderBy("valid_from_ts").collect()
    assert [v["match_rule_code"] for v in versions] == ["R1_PASSPORT_EXACT", "R1_EID_EXACT"]
    assert len({v["customer_key"] for v in versions}) == 1
    assert versions[0]["valid_to_ts"] == versions[1]["valid_from_ts"] == dt.datetime(2024, 1, 5)
    assert state(spark, root, two, "bridge").filter("device_key = 'LATE'").count() == 1
    assert events(spark, root, two).count() == before + 1
    # Closed versions: the one link and its golden record, whatever the size of the tables.
    for table in HISTORY:
        assert sorted(two.tables[table]) == ["2024-01-05", CURRENT]
        assert history(spark, root, two, table).closed(None).count() == 1

    run(DAYS[2], settings=Settings(review_leads=True))
    three = published(spark, root)
    assert set(state(spark, root, three, "lead_review").columns) == set(LEAD_REVIEW.names)
    second, third = contents(spark, root, two), contents(spark, root, three)
    for table in (*HISTORY, "queue", "open_subjects"):
        assert third[table] == second[table]  # only logins were new on the third day
    for table in HISTORY:
        # The third day wrote no closed version and goes on with the folder of the second.
        assert three.tables[table]["2024-01-05"] == two.tables[table]["2024-01-05"]
        assert sorted(three.tables[table]) == ["2024-01-05", CURRENT] and three.tables[table][CURRENT] != two.tables[table][CURRENT]

    run(DAYS[2], settings=Settings(review_leads=True))
    again = published(spark, root)
    assert (again.run_date, again.sequence) == (DAYS[2], three.sequence + 1)
    assert contents(spark, root, again) == third and len(third["queue"]) > 0
    assert dq_unique(golden_view(spark, root, again), ["customer_key"]).isEmpty()
    stitched = events(spark, root, again).filter("is_stitched")
    assert stitched.count() > 0 and stitched.filter("customer_key IS NULL").isEmpty()
    delivered = read_table(spark, f"{root}/events")
    assert delivered.filter("is_stitched").isEmpty() or delivered.filter("is_stitched").count() < stitched.count()


def test_written_bytes_follow_the_changes(spark, case, warehouse):
    """What closing adds is a few rows, and what events cost is the customers found for them."""
    manifest = published(spark, warehouse)
    for table in HISTORY:
        closed = size_of(warehouse, manifest.folders(table, until=CURRENT))
        assert 0 < closed < 0.5 * size_of(warehouse, manifest.folders(table, CURRENT))
    stitched = events(spark, warehouse, manifest).filter("is_stitched").count()
    assert 0 < state(spark, warehouse, manifest, "stitches").count() <= stitched


def test_join_with_the_current_slice_needs_no_exchange(spark, case, warehouse):
    """Of the current side, which is bucketed; the day's links are dealt out to its buckets."""
    manifest = published(spark, warehouse)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slices = history(spark, warehouse, manifest, "xref")
        links = case.run.links_today.select(*LINK.names)
        plan = _plan(xref_scd2_merge(slices.current(), links, DAYS[2]))
        join = plan[plan.index("FullOuter"):]
        left, right = join.index("Bucketed: true"), join.index("Exchange hashpartitioning(source_system")
        assert left < right and plan.count("Bucketed: true") == 1
        assert "FileScan" not in _plan(slices.closed(dt.date(2030, 1, 1)))  # no folder, no reading
        unique = _plan(dq_unique(history(spark, warehouse, manifest, "xref").current(), XREF_KEYS))
        assert "Exchange" not in unique
        gold = history(spark, warehouse, manifest, "gold")
        plan = _plan(gold_merge(gold.current(), gold.closed(DAYS[0]), gold.closed(None)))
        assert "Bucketed: true" in plan[plan.index("FullOuter"):]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_runs_cannot_publish_the_same_number(spark, tmp_path, monkeypatch):
    root, day = str(tmp_path), DAYS[0]
    slow, fast = (Attempt(spark, root, day, None, 4) for _ in range(2))
    known = publication.manifests
    fast.publish()
    monkeypatch.setattr(publication, "manifests", lambda *a: [])
    with pytest.raises(RuntimeError, match="run 2024-01-04 again"):
        slow.publish()
    monkeypatch.setattr(publication, "manifests", known)
    assert manifests(spark, root) == [(day, 1)]
    assert [p.name for p in Path(root, "_manifests").glob("*.draft")] == []


def test_a_failed_check_publishes_nothing(spark, case, warehouse, monkeypatch):
    from kinweave.plans import warehouse as plans

    count = len(manifests(spark, warehouse))
    day = DAYS[2] + dt.timedelta(days=1)
    monkeypatch.setattr(plans, "R3", "NOBODY")
    with pytest.raises(QualityError, match="unknown match rule"):
        run_day(spark, warehouse, day, native_tokenizer(TOKEN_KEY))
    assert len(manifests(spark, warehouse)) == count


def test_resolved_exceptions_may_be_raised_again(spark, case, warehouse):
    day = DAYS[2] + dt.timedelta(days=1)
    before = published(spark, warehouse)
    keys = state(spark, warehouse, before, "open_subjects").orderBy("exception_key").limit(2)
    keys.select("exception_key").write.parquet(f"{warehouse}/source/exception_resolution")
    subjects = {r["subject"] for r in keys.collect()}
    after = run_day(spark, warehouse, day, native_tokenizer(TOKEN_KEY))
    # The open check knows them as open until the run that learns of it has ended; the next run raises them anew.
    assert state(spark, warehouse, after, "queue", day).isEmpty()
    left = {r["subject"] for r in state(spark, warehouse, after, "open_subjects").collect()}
    assert not left & subjects
    run_day(spark, warehouse, day + dt.timedelta(days=1), native_tokenizer(TOKEN_KEY))
    assert state(spark, warehouse, published(spark, warehouse), "queue", day + dt.timedelta(days=1)).count() == 2


def test_a_new_token_key_changes_no_customer(spark, case, warehouse):
    """A day under key version 2 after one under version 1: no link or record is closed, and every token is of version 2."""
    before = published(spark, warehouse)
    day = before.run_date + dt.timedelta(days=1)
    after = run_day(
        spark, warehouse, day, native_tokenizer(TOKEN_KEY_2, 2), previous_tokenizer=native_tokenizer(TOKEN_KEY))
    for table in HISTORY:
        assert day.isoformat() not in after.tables[table]
    keys = ("source_id", "customer_key", "is_quarantined", "valid_from_ts")
    links = [rows_of(state(spark, warehouse, m, "xref").select(*keys)) for m in (before, after)]
    assert links[0] == links[1]
    for table in ("dim_customer", "gold"):
        found = [history(spark, warehouse, m, table).current() for m in (before, after)]
        assert rows_of(found[0].drop("emirates_id_token")) == rows_of(found[1].drop("emirates_id_token"))
        tokens = found[1].filter("emirates_id_token IS NOT NULL")
        assert tokens.count() == found[0].filter("emirates_id_token LIKE 'EID_v1_%'").count() > 0
        assert tokens.filter("emirates_id_token NOT LIKE 'EID_v2_%'").isEmpty()


def test_failed_casts_are_told_and_may_be_too_many(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "1990-01-01", "1"), ("b", "1990-13-01", None), ("c", None, "x"), ("d", "2000-02-29", "2")], "k string, born string, n string")
    casts = Casts(df, "people", "k", {"born": (F.col("born"), "date"), "n": (F.col("n"), "int")})
    casts.rejects.write.parquet(f"{tmp_path}/t")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [
        ("people", "b", "born", "1990-13-01", "not a date"), ("people", "c", "n", "x", "not a int")]
    casts.require_share(2 / 6)
    with pytest.raises(QualityError, match="2 of 6 texts"):
        casts.require_share(0.3)


def test_a_run_fails_on_too_many_failed_casts(spark, case, warehouse):
    """A source that delivers birth dates as text, some of them wrong: told in the ledger up to the share, fatal beyond it."""
    before = published(spark, warehouse)
    day = before.run_date + dt.timedelta(days=1)
    wrong = case.fx.fx_party.withColumn("date_of_birth", F.when(
        F.col("cif_id").endswith("7"), "31/12/1990").otherwise(F.col("date_of_birth").cast("string")))
    wrong.write.mode("overwrite").parquet(f"{warehouse}/source/dim_party")
    try:
        with pytest.raises(QualityError, match="texts do not fit their type"):
            run_day(spark, warehouse, day, native_tokenizer(TOKEN_KEY_2, 2))
        assert published(spark, warehouse).run_date == before.run_date
    finally:
        case.fx.fx_party.write.mode("overwrite").parquet(f"{warehouse}/source/dim_party")


def test_checks_are_counted_while_writing(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.when(F.col("id") > 7, F.lit("x")))
    measured = Measured(df, {"no v": is_incomplete(["v"]), "odd": is_unknown("v", ["x"])})
    measured.table.write.parquet(f"{tmp_path}/t")
    with pytest.raises(QualityError, match="{'no v': 8}"):
        measured.require_clean()
    assert "CollectMetrics" in _plan(measured.table)


def test_shared_folder_comes_from_the_session(spark):
    from kinweave.session import shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_views_of_a_run(spark, case):
    views = register_views(case.run)
    assert "idr_xref" in views and spark.sql("SELECT count(*) AS n FROM idr_xref").first()["n"] == case.run.xref.count()
