"""Likely existing customers among leads: blocking, comparison, and Fellegi-Sunter scoring for review.

A score suggests, it never merges. Candidate pairs come from an equi-join only, and all of them are compared where the join makes them:
people are shuffled, pairs are neither shuffled nor written. They go to Python in bundles, not pair by pair. For review, people who agree on
every field are one class (:func:`lead_review`): classes are compared, and only those that score high enough are expanded to people.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.functions import agreement, text
from kinweave.functions.similarity import jaro_winkler
from kinweave.operators import links, skew
from kinweave.schemas import SALESFORCE

FIELDS = ("first_name", "last_name", "date_of_birth", "email", "mobile")
LEGS = ("mobile", "email", "birth_name")

# Levels of agreement with their similarity limits, and the probability limits of the classes.
EXACT, CLOSE, NEAR, DIFFERENT, UNKNOWN = 3, 2, 1, 0, -1
CLOSE_LIMIT = 0.92
NEAR_LIMIT = 0.80
SUGGEST_LIMIT = 0.99
REVIEW_LIMIT = 0.80
SUGGESTED, REVIEW, NO_LINK = "SUGGESTED_LINK", "STEWARD_REVIEW", "NO_LINK"

LEVEL_PATTERNS = 5 ** len(FIELDS)
# People that each side of a tile holds on average: larger blocks are joined tile by tile, each of them anywhere.
TILE_PEOPLE = 2_000
# Leads and persons of a bundle at most: their pairs are compared together.
BUNDLE_LEADS, BUNDLE_PERSONS = 128, 512
# Members that a class of people names itself.
FEW_MEMBERS = 2


class Weight(NamedTuple):
    """Probability of a field's level among matches (m) and among non-matches (u)."""

    field: str
    level: int
    m: float
    u: float


def level_columns() -> list[str]:
    return [f"{f}_level" for f in FIELDS]


def lead_rows(account: DataFrame, contact_norm: DataFrame) -> DataFrame:
    """Rows to match for CRM accounts without a CIF, with the normal forms of their live contact points.

    Of several contact points of a kind the primary one counts, then the lowest value.
    """
    def best(kind: str) -> Column:
        order = F.struct((~F.col("is_primary")).alias("later"), "contact_value_norm")
        return F.min(F.when((F.col("contact_type_code") == kind) & F.col("contact_value_norm").isNotNull(), order)).getField(
            "contact_value_norm")

    live = contact_norm.filter((F.col("source_system") == SALESFORCE) & ~F.col("is_deleted"))
    contacts = live.groupBy(F.col("source_id").alias("person_id")).agg(
        best(text.EMAIL).alias("email"), best(text.MOBILE).alias("mobile"))
    named = links.route_leads(account).select(
        F.col("salesforce_account_id").alias("person_id"), "first_name", "last_name", F.col("birthdate").alias("date_of_birth"))
    return skew.lookup(named, contacts, "person_id").select("person_id", *FIELDS)


def person_rows(snapshot: DataFrame) -> DataFrame:
    """Rows to match for golden records without a conflict: the first word of the name, and the rest."""
    name = F.trim("full_name")
    return snapshot.filter(~F.col("idr_is_entity_conflict")).select(
        F.col("customer_key").alias("person_id"), F.substring_index(name, " ", 1).alias("first_name"),
        text.blank_to_null(F.regexp_replace(name, r"^\S+\s*", "")).alias("last_name"), "date_of_birth",
        F.col("primary_email").alias("email"), F.col("primary_mobile").alias("mobile"))


def _keyed(people: DataFrame, side: str, carried: Sequence[str] = ()) -> DataFrame:
    """One row per person: id, compared fields as a struct, and a key per leg; blank keys are NULL."""
    surname = text.blank_to_null(F.col("last_name"))
    return people.select(
        F.col("person_id").alias(f"{side}_id"),
        F.struct(*[F.col(f).cast("string").alias(f) for f in FIELDS]).alias(side),
        text.blank_to_null(F.col("mobile")).alias("mobile"),
        text.blank_to_null(F.col("email")).alias("email"),
        F.concat(F.col("date_of_birth").cast("string"), F.lit("|"), text.blank_to_null(F.soundex(surname)))
        .alias("birth_name"),
        *[F.col(c).alias(f"{side}_{c}") for c in carried],
    )


def _members(people: DataFrame, side: str, carried: Sequence[str]) -> DataFrame:
    """A row for each person and leg with a key: the place of the leg, the key, and all that the pairs need."""
    legs = ", ".join(f"struct({place} AS _place, `{leg}` AS _key)" for place, leg in enumerate(LEGS))
    earlier = [F.col(leg).alias(f"{side}_{leg}") for leg in LEGS[:-1]]
    return _keyed(people, side, carried).selectExpr("*", f"inline(array({legs}))").filter("_key IS NOT NULL").select(
        F.concat_ws("\u0001", "_place", "_key").alias(f"{side}_block"), f"{side}_id", side, *earlier, *[f"{side}_{c}" for c in carried])


def lead_blocks(
    leads: DataFrame, persons: DataFrame, carried: Sequence[str] = (), bundled: bool = False, apart: str | None = None,
) -> DataFrame:
    """Candidate pairs: same mobile, or same e-mail, or same birth date and surname sound.

    One equi-join of a row per person and leg. A block with many people on a side is a grid of tiles, so that no task holds it: a
    person goes to one row, or column, of tiles. A pair is emitted by the first leg it agrees on, so no duplicates need removing. All pairs
    are returned, whatever the size of a block; :func:`lead_block_members` says the same in linear space. ``carried`` names
    columns of both sides that a pair has as ``lead_...`` and ``person_...``.

    ``bundled`` gives the same pairs as rows of up to ``BUNDLE_LEADS`` leads and ``BUNDLE_PERSONS`` persons who all agree on a leg, for
    :func:`lead_compare` and :func:`class_pairs`: arrays of the values, of the ids, and of each carried column. Pairs that an earlier leg
    has are still among them. People who differ in ``apart``, a carried column, share no bundle, and its value is a column of the bundle.
    """
    sides = {side: _members(people, side, carried) for side, people in (("lead", leads), ("person", persons))}
    ends = [df.select(F.col(f"{side}_block").alias("_block"), (F.lit(side) == "lead").alias("_is_lead")) for side, df in sides.items()]
    counted = ends[0].unionByName(ends[1]).groupBy("_block").agg(
        F.count_if("_is_lead").alias("_leads"), F.count_if(~F.col("_is_lead")).alias("_persons"))
    large = counted.filter((F.least("_leads", "_persons") > 0) & (F.greatest("_leads", "_persons") > TILE_PEOPLE)).select(
        "_block", F.ceil(F.col("_leads") / TILE_PEOPLE).alias("_rows"), F.ceil(F.col("_persons") / TILE_PEOPLE).alias("_columns"))

    def tiled(side: str, own: str, other: str) -> DataFrame:
        block = f"{side}_block"
        found = skew.lookup(sides[side], large.withColumnRenamed("_block", block), block)
        drawn = F.pmod(F.xxhash64(f"{side}_id", side), F.coalesce(own, F.lit(1)))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(other, F.lit(1)) - 1))
        tile = {"_rows": drawn, "_columns": every} if own == "_rows" else {"_rows": every, "_columns": drawn}
        placed = found.select(*sides[side].columns, *[c.alias(f"{side}{name}") for name, c in tile.items()])
        return spread(placed, block, f"{side}_rows", f"{side}_columns")

    if bundled:
        sizes = {"lead": BUNDLE_LEADS, "person": BUNDLE_PERSONS}
        both = [_bundles(tiled(side, *order), side, [c for c in carried if c != apart], apart, sizes[side])
                for side, order in (("lead", ("_rows", "_columns")), ("person", ("_columns", "_rows")))]
        return both[0].join(both[1], [F.col(f"lead{c}") == F.col(f"person{c}") for c in ("_block", "_rows", "_columns")]).select(
            "lead", "person", F.substring("lead_block", 1, 1).cast("int").alias("leg"), "lead_id", "person_id",
            *[f"{side}_{c}" for side in sides for c in carried])

    agreed = " OR ".join(f"(substring(lead_block, 1, 1) > '{place}' AND coalesce(lead_{leg} = person_{leg}, false))"
                         for place, leg in enumerate(LEGS[:-1]))
    tiles = [F.col(f"lead{c}") == F.col(f"person{c}") for c in ("_block", "_rows", "_columns")]
    pairs = tiled("lead", "_rows", "_columns").join(tiled("person", "_columns", "_rows"), tiles).filter(f"NOT ({agreed})")
    leg = F.get(F.array(*map(F.lit, LEGS)), F.substring("lead_block", 1, 1).cast("int"))
    return pairs.select("lead_id", "person_id", "lead", "person", leg.alias("block"), *[
        f"{side}_{c}" for side in sides for c in carried])


def _bundles(placed: DataFrame, side: str, carried: Sequence[str], apart: str | None, size: int) -> DataFrame:
    """The members of each tile as arrays of at most ``size``, whatever their number. Rows of a tile are in one place already."""
    values = F.struct(*[F.col(f"{side}.{f}").alias(f) for f in FIELDS], *[F.col(f"{side}_{leg}").alias(f"_{leg}") for leg in LEGS[:-1]])
    member = F.struct(F.col(f"{side}_id").alias("id"), values.alias("values"), *[F.col(f"{side}_{c}").alias(c) for c in carried])
    tile = [f"{side}_block", f"{side}_rows", f"{side}_columns"] + ([f"{side}_{apart}"] if apart else [])
    every = placed.groupBy(*tile).agg(F.collect_list(member).alias("_members"))
    part = F.explode(F.sequence(F.lit(1), F.size("_members"), F.lit(size))).alias("_first")
    parts = every.select(*tile, "_members", part).select(*tile, F.slice("_members", F.col("_first"), size).alias("_members"))
    # An array for each column, so that those not asked for are not taken along.
    return parts.select(*tile, F.col("_members.values").alias(side), *[F.col(f"_members.{c}").alias(f"{side}_{c}") for c in ("id", *carried)])


def _unbundled(bundles: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of every pair of the bundles, in which ``_l`` and ``_p`` are the places of its people, and its levels."""
    codes = agreement.patterns(F.col("lead"), F.col("person"), F.col("leg"), len(FIELDS), CLOSE_LIMIT, NEAR_LIMIT)
    # The outer form: for the other, Catalyst would test the size of the array beforehand, and for that compare everything once more.
    pairs = bundles.select("*", codes.alias("_codes"), F.size("person").alias("_width")).drop("lead", "person").select(
        "*", F.posexplode_outer("_codes").alias("_at", "_code")).filter("_code >= 0")
    placed = pairs.selectExpr("*", "CAST(_at div _width AS INT) AS _l", "_at % _width AS _p")
    return placed.selectExpr(*columns, *[
        f"{agreement.pattern_level('_code', k, len(FIELDS))} AS {c}" for k, c in enumerate(level_columns())])


def told_repeats(people: DataFrame) -> DataFrame:
    """``people`` with ``repeats``: whether another row may have the same id."""
    twice = people.groupBy("person_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("person_id", F.lit(True).alias("repeats"))
    return skew.lookup(people, twice, "person_id").withColumn("repeats", F.coalesce("repeats", F.col("person_id").isNull()))


def lead_block_members(leads: DataFrame, persons: DataFrame) -> DataFrame:
    """Every block with leads and persons, as (block, member) rows: each lead of it is a candidate for each person of it."""
    legs = ", ".join(f"struct('{leg}' AS block, `{leg}` AS block_key)" for leg in LEGS)

    def rows(side: DataFrame, name: str) -> DataFrame:
        return _keyed(side, name).selectExpr(f"{name}_id AS member_id", f"'{name}' AS side", f"inline(array({legs}))")

    members = rows(leads, "lead").unionByName(rows(persons, "person")).filter("block_key IS NOT NULL")
    members = members.withColumn("_block", F.concat_ws("\u0001", "block", "block_key"))
    counted = members.groupBy("_block").agg(
        F.count_if(F.col("side") == "lead").alias("lead_count"), F.count_if(F.col("side") == "person").alias("person_count"))
    both = counted.withColumn("pair_count", F.col("lead_count") * F.col("person_count")).filter("pair_count > 0")
    return skew.lookup(members, both, "_block", "inner").drop("_block")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt out to as many tasks as a shuffle has. Adaptive execution goes by bytes and would leave a few MB, and with them
    a million similarities, to one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def value_pairs(pairs: DataFrame) -> DataFrame:
    """``field, a, b``: the values that meet in some pair, known on both sides, and ``pair_count``, in how many pairs they do."""
    long = pairs.selectExpr("inline(array(" + ", ".join(f"struct('{f}' AS field, lead.{f} AS a, person.{f} AS b)" for f in FIELDS) + "))")
    return long.filter("a IS NOT NULL AND b IS NOT NULL").groupBy("field", "a", "b").agg(F.count(F.lit(1)).alias("pair_count"))


def value_levels(values: DataFrame) -> DataFrame:
    """``values`` with the level of agreement of each two: one similarity for each row whose values differ."""
    same = values.filter("a = b").withColumn("level", F.lit(EXACT))
    scored = spread(values.filter("a <> b"), "field", "a", "b").withColumn("_jw", jaro_winkler(F.col("a"), F.col("b")))
    level = F.when(F.col("_jw") >= CLOSE_LIMIT, CLOSE).when(F.col("_jw") >= NEAR_LIMIT, NEAR).otherwise(DIFFERENT)
    return same.unionByName(scored.withColumn("level", level).drop("_jw"))


def _levels(pairs: DataFrame) -> list[Column]:
    """The level of agreement per field. Equal and unknown values are told at once, the UDF gets the others."""
    columns = []
    for f in FIELDS:
        a, b = F.col(f"lead.{f}"), F.col(f"person.{f}")
        similar = jaro_winkler(F.when(a != b, a), F.when(a != b, b))
        level = F.when(a.isNull() | b.isNull(), UNKNOWN).when(a == b, EXACT).when(similar >= CLOSE_LIMIT, CLOSE)
        columns.append(level.when(similar >= NEAR_LIMIT, NEAR).otherwise(DIFFERENT).alias(f"{f}_level"))
    return columns


def lead_compare(pairs: DataFrame, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """``lead_id, person_id`` and the level of agreement per field, one row for each two ids with the highest levels of their pairs.

    Levels are found beside the pairs, task by task; bundles of :func:`lead_blocks` are compared bundle by bundle, which is many times
    faster. Only pairs that may be there again are aggregated: those whose ``lead_repeats`` or ``person_repeats`` is true (see
    :func:`told_repeats`), or all if the pairs do not carry these. ``keep`` is of no use, as nothing is written.
    """
    def best(rows: DataFrame) -> DataFrame:
        return rows.groupBy("lead_id", "person_id").agg(*[F.max(c).alias(c) for c in level_columns()])

    def compared(rows: DataFrame) -> DataFrame:
        if "leg" in rows.columns:
            return _unbundled(rows, "lead_id[_l] AS lead_id", "person_id[_p] AS person_id")
        return rows.select("lead_id", "person_id", *_levels(rows))

    if "lead_repeats" not in pairs.columns:
        return best(compared(pairs))
    repeats = F.col("lead_repeats") | F.col("person_repeats")
    return compared(pairs.filter(~repeats)).unionByName(best(compared(pairs.filter(repeats))))


def lead_patterns(compared: DataFrame, count: str | None = None) -> DataFrame:
    """Pairs collapsed to level patterns with their count: at most ``LEVEL_PATTERNS`` rows whatever the input. ``count`` names the
    column that says for how many pairs a row stands."""
    pairs = F.sum(count) if count else F.count(F.lit(1))
    return compared.groupBy(*level_columns()).agg(pairs.alias("pair_count"))


def random_pairs(leads: DataFrame, persons: DataFrame, partners: int = 20, seed: int = 1) -> DataFrame:
    """About ``partners`` random persons for each lead.

    Both sides fall into as many hashed buckets as leave ``partners`` persons in each; equal buckets pair up. The
    draw depends on ids and seed alone, by digits of a SHA-256 that any engine can repeat.
    """
    buckets = persons.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / partners))).scalar()

    def drawn(people: DataFrame, side: str) -> DataFrame:
        key = F.col(f"{side}_id")
        digits = F.substring(F.sha2(F.concat_ws("|", F.lit(seed), F.lit(side), key), 256), 1, 12)
        rows = _keyed(people, side).select(key, side, F.pmod(F.conv(digits, 16, 10).cast("long"), buckets).alias("bucket"))
        return spread(rows, "bucket")

    return drawn(leads, "lead").join(drawn(persons, "person"), "bucket").drop("bucket")


def lead_estimate_u(leads: DataFrame, persons: DataFrame, partners: int = 20, seed: int = 1) -> DataFrame:
    """Share of each level among random pairs, which are almost all non-matches. Unknown levels do not count."""
    levels = value_levels(value_pairs(random_pairs(leads, persons, partners, seed)))
    counts = levels.groupBy("field").pivot("level", [EXACT, CLOSE, NEAR, DIFFERENT]).agg(F.sum("pair_count")).fillna(0)
    total = F.col("3") + F.col("2") + F.col("1") + F.col("0")
    return counts.select("field", F.inline(F.array(*[
        F.struct(F.lit(v).alias("level"), (F.col(str(v)) / total).alias("u"))
        for v in (EXACT, CLOSE, NEAR, DIFFERENT)])))


def lead_estimate_m(
    patterns: DataFrame, u: DataFrame, prior: float = 0.01, rounds: int = 50, floor: float = 1e-6,
) -> tuple[list[Weight], float]:
    """Share of each level among matches, and the share of matches, by expectation maximisation with ``u`` held.

    Spark has collapsed the pairs to level patterns, so the loop runs over a table of bounded size.
    """
    import numpy as np

    rows = patterns.take(LEVEL_PATTERNS + 1)
    if len(rows) > LEVEL_PATTERNS:
        raise ValueError("patterns must be grouped by level, see lead_patterns")
    levels = np.array([[r[c] for c in level_columns()] for r in rows])
    counts = np.array([r["pair_count"] for r in rows], dtype=float)
    u_of = np.full((len(FIELDS), 4), floor)
    for row in u.take(4 * len(FIELDS)):
        u_of[FIELDS.index(row["field"]), row["level"]] = max(row["u"], floor)
    m_of = np.tile([0.05, 0.05, 0.10, 0.80], (len(FIELDS), 1))

    def likelihood(table: "np.ndarray") -> "np.ndarray":
        total = np.ones(len(levels))
        for i in range(len(FIELDS)):
            total *= np.where(levels[:, i] == UNKNOWN, 1.0, table[i, levels[:, i].clip(0)])
        return total

    for _ in range(rounds):
        matched, unmatched = prior * likelihood(m_of), (1 - prior) * likelihood(u_of)
        share = counts * matched / np.maximum(matched + unmatched, 1e-300)
        prior = float(min(max(share.sum() / counts.sum(), floor), 1 - floor))
        for i in range(len(FIELDS)):
            at = np.array([share[levels[:, i] == v].sum() for v in range(4)])
            m_of[i] = np.maximum(at / at.sum(), floor) if at.sum() > 0 else m_of[i]
    weights = [
        Weight(f, v, float(m_of[i, v]), float(u_of[i, v])) for i, f in enumerate(FIELDS) for v in range(4)]
    return weights, prior


def weights_table(patterns: DataFrame, weights: Iterable[Weight]) -> DataFrame:
    schema = T.StructType([
        T.StructField("field", T.StringType()), T.StructField("level", T.IntegerType()),
        T.StructField("m", T.DoubleType()), T.StructField("u", T.DoubleType())])
    return patterns.sparkSession.createDataFrame([tuple(w) for w in weights], schema)


def lead_score(
    compared: DataFrame, weights: Sequence[Weight], prior: float, digits: tuple[int, int] | None = None,
) -> DataFrame:
    """Match weight, the sum of log2(m/u) over known levels, and the match probability it implies; rounded to ``digits`` if given.

    Both depend on the levels alone, so they are worked out once for each pattern of levels and looked up for each pair.
    """
    parts = []
    for field in FIELDS:
        arms = " ".join(f"WHEN {w.level} THEN log2({w.m / w.u!r}D)" for w in weights if w.field == field)
        parts.append(f"coalesce(CASE {field}_level {arms} END, 0D)" if arms else "0D")
    odds = f"({prior!r}D * pow(2D, match_weight))"
    # A digit for each field: 0 to 4 for the levels from UNKNOWN to EXACT, 5 for anything else, which scores as no level.
    of = {c: 6 ** k for k, c in enumerate(level_columns())}
    known = compared.sparkSession.range(6 ** len(FIELDS)).selectExpr(
        "id AS _pattern", *[f"CAST(nullif(id div {n} % 6, 5) - 1 AS INT) AS {c}" for c, n in of.items()])
    known = known.selectExpr("_pattern", f"{' + '.join(parts)} AS match_weight").selectExpr(
        "*", f"{odds} / ({1.0 - prior!r}D + {odds}) AS match_probability")
    if digits:
        known = known.withColumns({c: F.round(c, n) for c, n in zip(("match_weight", "match_probability"), digits, strict=True)})
    # Grouped, so that a filter on a score is not carried over to the pairs as one on all that it is worked out from.
    known = known.groupBy("_pattern").agg(*[F.max(c).alias(c) for c in ("match_weight", "match_probability")])
    own = " + ".join(f"CASE WHEN {c} BETWEEN {UNKNOWN} AND {EXACT} THEN {c} + 1 ELSE 5 END * {n}L" for c, n in of.items())
    asked = compared.withColumn("_asked", F.expr(own))
    return asked.join(F.broadcast(known), F.col("_asked") == F.col("_pattern")).drop("_asked", "_pattern")


def lead_classify(scored: DataFrame) -> DataFrame:
    probability = F.col("match_probability")
    return scored.withColumn(
        "link_class",
        F.when(probability >= SUGGEST_LIMIT, SUGGESTED).when(probability >= REVIEW_LIMIT, REVIEW).otherwise(NO_LINK))


class People(NamedTuple):
    """One side of the matching by classes: ``classes`` has a row for all people who agree on every field, with the class as
    ``person_id``, its ``size``, and ``few``, its members, unless ``many`` says that these are over ``FEW_MEMBERS``; ``members`` says who is
    in which class."""

    classes: DataFrame
    members: DataFrame


def lead_classes(people: DataFrame) -> People:
    fields = [F.col(f).cast("string").alias(f) for f in FIELDS]
    keyed = people.select("person_id", F.sha2(F.to_json(F.struct(*fields)), 256).alias("class_key"), *FIELDS)
    ends = (F.min(F.struct("person_id")), F.max(F.struct("person_id")))
    classes = keyed.groupBy("class_key", *FIELDS).agg(
        F.count(F.lit(1)).alias("size"), F.array(*[end.getField("person_id") for end in ends]).alias("_ends"))
    few = F.when(F.col("size") <= FEW_MEMBERS, F.slice("_ends", 1, F.col("size").cast("int")))
    return People(
        classes.select(F.col("class_key").alias("person_id"), *FIELDS, "size", few.alias("few"), (F.col("size") > FEW_MEMBERS).alias("many")),
        keyed.select("class_key", "person_id"))


def class_pairs(leads: People, persons: People, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pairs of classes worth comparing with their levels, and ``pair_count``, the pairs of people each stands for.

    Members of a class share every blocking key, so their pairs are exactly those of :func:`lead_blocks`. A class is there once, so nothing
    is aggregated; ``keep`` is of no use, as nothing is written. Pairs carry ``few`` and ``many`` of both classes for :func:`lead_review`.
    """
    bundles = lead_blocks(leads.classes, persons.classes, ("size", "few", "many"), bundled=True, apart="many")
    pairs = _unbundled(
        bundles, "lead_id[_l] AS lead_id", "person_id[_p] AS person_id", "lead_size[_l] * person_size[_p] AS pair_count",
        "lead_few[_l] AS lead_few", "person_few[_p] AS person_few", "lead_many", "person_many")
    told = ["lead_id", "person_id", *level_columns(), "pair_count"]
    return pairs.select(*told, *[c for c in pairs.columns if c not in told])


def lead_review(leads: People, persons: People, scored: DataFrame) -> DataFrame:
    """``scored`` pairs of classes as pairs of people: only those that a steward should see are ever expanded.

    Pairs of classes that name their members are expanded in place; only those with a larger class meet the members in a join.
    """
    found = ["match_weight", "match_probability", "link_class"]
    seen = lead_classify(scored).filter(F.col("link_class") != NO_LINK)

    def joined(pairs: DataFrame) -> DataFrame:
        who = leads.members.select(F.col("class_key").alias("_l"), F.col("person_id").alias("lead_id"))
        whom = persons.members.select(F.col("class_key").alias("_p"), "person_id")
        asked = pairs.select(F.col("lead_id").alias("_lead"), F.col("person_id").alias("_person"), *found)
        return asked.join(who, F.col("_lead") == F.col("_l")).join(whom, F.col("_person") == F.col("_p")).select(
            "lead_id", "person_id", *found)

    if "lead_many" not in scored.columns:
        return joined(seen)
    many = F.col("lead_many") | F.col("person_many")
    few = seen.filter(~many).select(F.explode("lead_few").alias("lead_id"), "person_few", *found)
    return few.select("lead_id", F.explode("person_few").alias("person_id"), *found).unionByName(joined(seen.filter(many)))


def review_leads(
    leads: DataFrame, persons: DataFrame, keep: Callable[[str, DataFrame], DataFrame] | None = None, partners: int = 20, rounds: int = 50,
) -> DataFrame:
    """From people to suggested links, end to end: parameters are estimated from the data itself."""
    sides = lead_classes(leads), lead_classes(persons)
    compared = class_pairs(*sides, keep)
    compared = keep("lead_levels", compared) if keep else compared
    u = lead_estimate_u(leads, persons, partners)
    weights, prior = lead_estimate_m(lead_patterns(compared, "pair_count"), u, rounds=rounds)
    return lead_review(*sides, lead_score(compared, weights, prior))
