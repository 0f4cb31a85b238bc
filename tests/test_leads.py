"""Blocking against brute force, scoring, and parameter estimation with a known answer."""

import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import leads
from kinweave.sources.tables import written

PERSON = "person_id string, first_name string, last_name string, date_of_birth date, email string, mobile string"


@pytest.fixture(scope="module")
def people(spark):
    """Small sides with blank keys, and one mobile that a third of both sides share."""
    import datetime as dt

    rng = random.Random(3)
    names = ["Rahman", "Raman", "Haddad", "", None, "Saleh"]

    def person(i, side):
        mobile = "hot" if i % 3 == 0 else rng.choice([None, "", " ", f"m{rng.randint(0, 20)}"])
        return (f"{side}{i}", rng.choice(["Amina", "Omar"]), rng.choice(names),
                rng.choice([None, dt.date(1990, 1, rng.randint(1, 4))]), rng.choice([None, "", f"e{rng.randint(0, 30)}"]),
                mobile)

    return tuple(spark.createDataFrame([person(i, s) for i in range(60)], PERSON) for s in "LP")


def brute_force(left, right):
    """Pairs by leg, straight from the definition."""
    def keyed(df):
        rows = df.withColumn("sound", F.soundex(F.trim("last_name"))).collect()
        return [(r["person_id"], {
            "mobile": (r["mobile"] or "").strip() or None, "email": (r["email"] or "").strip() or None,
            "birth_name": (r["date_of_birth"], r["sound"]) if r["date_of_birth"] and r["sound"] else None})
            for r in rows]

    return {leg: {(a, b) for a, ka in keyed(left) for b, kb in keyed(right) if ka[leg] and ka[leg] == kb[leg]}
            for leg in leads.LEGS}


def test_blocks_equal_brute_force(people):
    expected = brute_force(*people)
    found = [(r["lead_id"], r["person_id"]) for r in leads.lead_blocks(*people).collect()]
    assert len(found) == len(set(found))
    assert set(found) == set().union(*expected.values())


def test_members_say_the_same_as_the_pairs(people):
    expected = brute_force(*people)
    blocks = {}
    for r in leads.lead_block_members(*people).collect():
        blocks.setdefault((r["block"], r["block_key"]), {"lead": set(), "person": set()})[r["side"]].add(r["member_id"])
        assert r["pair_count"] == r["lead_count"] * r["person_count"] > 0
    for leg, pairs in expected.items():
        assert pairs == {
            (a, b) for (block, _), sides in blocks.items() if block == leg for a in sides["lead"] for b in sides["person"]}


def test_no_block_is_too_large(spark):
    shared = [spark.range(1001).selectExpr(
        f"concat('{side}', id) AS person_id", "'Amina' AS first_name", f"concat('N', id, '{side}') AS last_name",
        "CAST(NULL AS DATE) AS date_of_birth", "CAST(NULL AS STRING) AS email", "'+971501234567' AS mobile") for side in "LP"]
    pairs = leads.lead_blocks(*shared)
    assert pairs.count() == 1001 * 1001 == pairs.select("lead_id", "person_id").distinct().count()


def pair(spark, first=("Amina", "Amina"), last=("Rahman", "Rahman"), born=("1990-01-01",) * 2, mail=(None, None),
         mobile=("+971501234567",) * 2):
    person = "struct<first_name: string, last_name: string, date_of_birth: string, email: string, mobile: string>"
    return spark.createDataFrame(
        [("L", "P", *zip(first, last, born, mail, mobile))], f"lead_id string, person_id string, lead {person}, person {person}")


def test_levels(spark):
    row = leads.lead_compare(pair(
        spark, first=("martha", "marhta"), last=("abcd12345", "abcd98765678"), born=("1990-01-01", "1990-01-01"),
        mail=("dixon", "dicksonx"), mobile=(None, "1"))).first()
    assert [row[c] for c in leads.level_columns()] == [2, 0, 3, 1, -1]


def test_two_level_weights_reduce_to_agree_and_disagree(spark):
    import math

    weights = [leads.Weight("first_name", 3, 0.9, 0.1), leads.Weight("first_name", 0, 0.1, 0.9),
               leads.Weight("last_name", 3, 0.8, 0.05), leads.Weight("last_name", 0, 0.2, 0.95)]
    compared = leads.lead_compare(pair(spark, last=("Rahman", "Xu")))
    row = leads.lead_score(compared, weights, 0.5).first()
    expected = math.log2(0.9 / 0.1) + math.log2((1 - 0.8) / (1 - 0.05))
    assert row["match_weight"] == pytest.approx(expected)
    assert row["match_probability"] == pytest.approx(2 ** expected / (1 + 2 ** expected))


@pytest.mark.parametrize("p, expected", [(0.99, "SUGGESTED_LINK"), (0.9899, "STEWARD_REVIEW"), (0.80, "STEWARD_REVIEW"),
                                         (0.7999, "NO_LINK")])
def test_classes(spark, p, expected):
    df = spark.createDataFrame([(p,)], "match_probability double")
    assert leads.lead_classify(df).first()["link_class"] == expected


def test_random_pairs_repeat_and_have_about_the_asked_size(case):
    pairs = leads.random_pairs(case.fx.fx_person.withColumn("person_id", F.concat(F.lit("x"), "person_id")),
                               case.fx.fx_person, partners=10, seed=5)
    first = {(r["lead_id"], r["person_id"]) for r in pairs.collect()}
    assert first == {(r["lead_id"], r["person_id"]) for r in pairs.repartition(3).collect()}
    assert 0.5 * 10 * 150 < len(first) < 2 * 10 * 150


def test_u_is_a_distribution(case):
    rows = leads.lead_estimate_u(case.fx.fx_lead, case.fx.fx_person).groupBy("field").agg(F.sum("u").alias("u")).collect()
    assert len(rows) == len(leads.FIELDS) and all(r["u"] == pytest.approx(1.0) for r in rows)


def test_em_finds_the_shares_the_data_was_made_with(spark):
    """Patterns drawn from known m, u and prior, with independent fields."""
    import itertools

    m, u, prior = {3: 0.9, 0: 0.1}, {3: 0.1, 0: 0.9}, 0.2
    rows = []
    for levels in itertools.product((3, 0), repeat=5):
        match, other = prior, 1 - prior
        for level in levels:
            match, other = match * m[level], other * u[level]
        rows.append((*levels, round(1_000_000 * (match + other))))
    schema = ", ".join(f"{c} int" for c in leads.level_columns()) + ", pair_count long"
    table = [(f, level, u.get(level, 0.0)) for f in leads.FIELDS for level in range(4)]
    weights, found = leads.lead_estimate_m(
        spark.createDataFrame(rows, schema), spark.createDataFrame(table, "field string, level int, u double"), rounds=200)
    assert found == pytest.approx(prior, abs=0.01)
    agree = [w.m for w in weights if w.level == 3]
    assert agree == pytest.approx([0.9] * 5, abs=0.01)
    assert leads.weights_table(spark.createDataFrame(rows, schema), weights).count() == 20


def pair_form(compared, weights, prior):
    scored = leads.lead_classify(leads.lead_score(compared, weights, prior))
    return {(r["lead_id"], r["person_id"]): (round(r["match_weight"], 9), r["link_class"])
            for r in scored.collect() if r["link_class"] != leads.NO_LINK}


WEIGHTS = [leads.Weight(f, level, m, u) for f in leads.FIELDS
           for level, m, u in ((3, 0.80, 0.02), (2, 0.10, 0.02), (1, 0.05, 0.06), (0, 0.05, 0.90))]


def test_review_by_classes_equals_the_pair_form(people):
    """Each person three times under other ids, so that classes have several members; unknown and blank fields stay apart."""
    left, right = (side.crossJoin(side.sparkSession.range(3)).withColumn("person_id", F.concat_ws("-", "person_id", "id")).drop("id")
                   for side in people)
    sides = leads.lead_classes(left), leads.lead_classes(right)
    assert 0 < sides[0].classes.count() <= people[0].drop("person_id").distinct().count()
    keep = written(left.sparkSession)
    pairs = keep("class_pairs", leads.class_pairs(*sides, keep))
    compared = keep("compared", leads.lead_compare(keep("pairs", leads.lead_blocks(left, right)), keep))
    assert pairs.agg(F.sum("pair_count")).first()[0] == compared.count()
    for prior in (0.001, 0.05):
        review = leads.lead_review(*sides, leads.lead_score(pairs, WEIGHTS, prior)).collect()
        got = {(r["lead_id"], r["person_id"]): (round(r["match_weight"], 9), r["link_class"]) for r in review}
        assert len(got) == len(review) and got == pair_form(compared, WEIGHTS, prior)
    assert got
    patterns = {tuple(r[c] for c in leads.level_columns()): r["pair_count"] for r in leads.lead_patterns(pairs, "pair_count").collect()}
    plain = leads.lead_patterns(compared).collect()
    assert patterns == {tuple(r[c] for c in leads.level_columns()): r["pair_count"] for r in plain}


def test_one_mobile_of_100_000_people(spark):
    """A block of 2.5 thousand million pairs: classes are compared, and few pairs are likely enough to be expanded."""
    def people(side, count):
        return spark.range(count).selectExpr(
            f"concat('{side}', id) AS person_id", "concat('First', chr(CAST(65 + id % 20 AS INT)), id % 20) AS first_name",
            f"concat(chr(CAST(65 + id % 17 AS INT)), 'last{side}', id % 17) AS last_name",
            "CASE WHEN id < 10 THEN DATE'1990-01-01' END AS date_of_birth",
            "CASE WHEN id < 10 THEN concat('mail', id, '@example.com') END AS email", "'+971501234567' AS mobile")

    sides = leads.lead_classes(people("L", 50_000)), leads.lead_classes(people("P", 50_000))
    keep = written(spark)
    pairs = keep("class_pairs", leads.class_pairs(*sides, keep))
    assert pairs.count() <= 360 * 360 and pairs.agg(F.sum("pair_count")).first()[0] == 50_000 ** 2
    found = leads.lead_review(*sides, leads.lead_score(pairs, WEIGHTS, 1e-6))
    likely = {(r["lead_id"], r["person_id"]) for r in found.limit(1000).collect()}
    assert {(f"L{i}", f"P{i}") for i in range(10)} <= likely and len(likely) <= 100


def test_similarity_runs_once_for_each_two_values(spark, monkeypatch):
    """Rows that reach the UDF: the distinct unequal values of each field, not the pairs."""
    from kinweave.functions import similarity

    reached = spark.sparkContext.accumulator(0)
    build = similarity.jaro_winkler

    def counted(left, right):
        def count(values):
            reached.add(int(values.notna().sum()))
            return values
        return build(F.pandas_udf(count, "string")(left), right)

    monkeypatch.setattr(leads, "jaro_winkler", counted)
    fields = "first_name string, last_name string, date_of_birth string, email string, mobile string"
    data = [(f"L{i}", f"P{i}", (f"Anna{i % 3}", None, "1990-01-01", f"m{i % 2}", "5"), (f"Ana{i % 2}", "x", "1990-01-01", f"n{i % 5}", "6"))
            for i in range(600)]
    pairs = spark.createDataFrame(data, f"lead_id string, person_id string, lead struct<{fields}>, person struct<{fields}>").repartition(5)
    values = leads.value_levels(leads.value_pairs(pairs))
    values.write.format("noop").mode("overwrite").save()
    assert reached.value == 6 + 10 + 1  # first names, e-mails, mobiles; birth dates are equal, last names unknown
    assert values.agg(F.sum("pair_count")).first()[0] == 600 * 4
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_review_end_to_end(case):
    found = leads.review_leads(case.fx.fx_lead, case.fx.fx_person, case.keep)
    assert found.columns == ["lead_id", "person_id", "match_weight", "match_probability", "link_class"]
    assert found.filter("match_probability < 0.8 OR link_class = 'NO_LINK'").isEmpty()


def test_large_blocks_are_tiled(people, monkeypatch):
    """A grid of tiles for each block gives the same pairs, each of them once."""
    monkeypatch.setattr(leads, "TILE_PEOPLE", 3)
    found = [(r["lead_id"], r["person_id"]) for r in leads.lead_blocks(*people).collect()]
    assert len(found) == len(set(found)) and set(found) == set().union(*brute_force(*people).values())


def test_pairs_are_neither_shuffled_nor_written(spark):
    """People are shuffled; above the join of a block's sides nothing is, and no step is written before the result is asked for."""
    def plan_of(df):
        df.write.format("noop").mode("overwrite").save()
        return df._jdf.queryExecution().executedPlan().toString()

    def keep(name, df):
        raise AssertionError(f"{name} is written")

    sides = [spark.range(40).selectExpr(
        f"concat('{side}', id) AS person_id", "'Amina' AS first_name", f"concat('N', id, '{side}') AS last_name",
        "CAST(NULL AS DATE) AS date_of_birth", "CAST(NULL AS STRING) AS email", "'+971501234567' AS mobile") for side in "LP"]
    pairs = leads.lead_blocks(*[side.withColumn("repeats", F.lit(False)) for side in sides], ("repeats",))
    classes = [leads.lead_classes(side) for side in sides]
    for found in (leads.lead_compare(pairs, keep), leads.class_pairs(*classes, keep)):
        assert found.count() == 1600
        plan = plan_of(found)
        final = plan.split("Initial Plan")[0]
        assert "Exchange" not in final[:final.index("_columns")] and "BatchEvalPython" not in final and "ArrowEvalPython" in final


def test_rows_that_repeat_an_id_are_one_pair_of_ids(people):
    """The highest level of each field over all pairs of rows with the same two ids, whether or not rows are told to repeat."""
    left, right = (side.unionByName(side.filter("person_id LIKE '%1'").withColumn("email", F.lit("e1"))).unionByName(side.limit(3)).withColumn(
        "person_id", F.when(~F.col("person_id").endswith("7"), F.col("person_id"))) for side in people)
    plain = sorted(map(repr, leads.lead_compare(leads.lead_blocks(left, right)).collect()))
    told = leads.lead_compare(leads.lead_blocks(leads.told_repeats(left), leads.told_repeats(right), ("repeats",)))
    assert sorted(map(repr, told.collect())) == plain and len(plain) == told.select("lead_id", "person_id").distinct().count()


def odd_people(spark, people):
    """Both sides with texts of all lengths and kinds, ids that repeat or are unknown, and rows that are there twice."""
    rng = random.Random(8)
    texts = ["", "é", "ab𝒳", "x" * 64, "x" * 65, "y" * 70 + "z", "anna@example.com", "nana@example.com", "xanna@example.com", "dixon", "dicksonx"]
    out = []
    for side in people:
        drawn = F.get(F.array(*map(F.lit, texts)), F.pmod(F.xxhash64("person_id", F.lit(rng.random())), F.lit(len(texts))).cast("int"))
        odd = side.withColumn("first_name", drawn).unionByName(side.filter("person_id LIKE '%1'")).unionByName(side.limit(3))
        out.append(odd.withColumn("person_id", F.when(~F.col("person_id").endswith("7"), F.col("person_id"))))
    return out


@pytest.mark.parametrize("sizes", [(2_000, 128, 512), (5, 2, 3)])
def test_bundles_give_the_same_levels_as_pairs(spark, people, monkeypatch, sizes):
    """Whether pairs go to Python one by one or as tiles of texts, small ones in one go or tile by tile."""
    from kinweave.functions import agreement

    left, right = odd_people(spark, people)
    plain = sorted(map(repr, leads.lead_compare(leads.lead_blocks(left, right)).collect()))
    for name, size in zip(("TILE_PEOPLE", "BUNDLE_LEADS", "BUNDLE_PERSONS"), sizes):
        monkeypatch.setattr(leads, name, size)
    told = leads.told_repeats(left), leads.told_repeats(right)
    for few, all_pairs in ((agreement.FEW_PAIRS, agreement.ALL_PAIRS), (1, 0)):
        monkeypatch.setattr(agreement, "FEW_PAIRS", few)
        monkeypatch.setattr(agreement, "ALL_PAIRS", all_pairs)
        bundles = leads.lead_blocks(*told, ("repeats",), bundled=True, apart="repeats")
        assert sorted(map(repr, leads.lead_compare(bundles).collect())) == plain


def test_a_bundle_is_compared_once_and_its_pairs_are_not_moved(people):
    """Of the two parts, pairs that may repeat and the others, each has one exchange-free path from the join, and one comparison."""
    told = [leads.told_repeats(side) for side in people]
    found = leads.lead_compare(leads.lead_blocks(*told, ("repeats",), bundled=True, apart="repeats"))
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ArrowEvalPython [") <= 2 and "Exchange" not in plan[:plan.index("ArrowEvalPython [")]


@pytest.mark.parametrize("copies", [1, 2, 3])
def test_review_expands_classes_in_place_or_by_a_join(people, copies):
    """Members of a class: one and two are named by it, more are joined; ids may be unknown or repeat."""
    left, right = (side.crossJoin(side.sparkSession.range(copies)).withColumn("person_id", F.when(
        (F.col("id") != 1) | ~F.col("person_id").endswith("3"), F.col("person_id"))).drop("id") for side in people)
    sides = leads.lead_classes(left), leads.lead_classes(right)
    assert copies < 3 or sides[0].classes.filter("many").count() > 0
    scored = leads.lead_score(leads.class_pairs(*sides), WEIGHTS, 0.05)
    want = leads.lead_review(*sides, scored.drop("lead_many"))
    assert sorted(map(repr, leads.lead_review(*sides, scored).collect())) == sorted(map(repr, want.collect())) != []


def test_scores_are_looked_up_by_pattern(spark):
    """The sum over known levels as worked out pair by pair, unknown levels and none at all included, and rounded as asked."""
    import math

    rows = [(3, 2, 1, 0, -1), (3, 3, 3, 3, 3), (None, 3, None, 0, 2), (-1, -1, -1, -1, -1)]
    compared = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in leads.level_columns()))
    of = {(w.field, w.level): math.log2(w.m / w.u) for w in WEIGHTS}
    for digits in (None, (6, 9)):
        got = leads.lead_score(compared, WEIGHTS, 0.01, digits).collect()
        assert len(got) == len(rows)
        for r in got:
            weight = sum(of.get((f, r[f"{f}_level"]), 0.0) for f in leads.FIELDS)
            odds = 0.01 * 2 ** weight
            assert r["match_weight"] == pytest.approx(round(weight, 6) if digits else weight, rel=1e-12, abs=1e-12)
            assert r["match_probability"] == pytest.approx(round(odds / (0.99 + odds), 9) if digits else odds / (0.99 + odds), rel=1e-12)
