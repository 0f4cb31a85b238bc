"""Near duplicates by min-max hashing: under each permutation of the shingles both the least and the greatest are kept.

Half the permutations give a signature of full length. Documents with equal sets are one class first. Classes that
agree in a band meet in a bucket; a bucket is not expanded into pairs, but compared with its first class, the pivot.
Classes that resemble the same pivot are then compared by their differences from it, in which the common part of a large
family of variants cancels out. The rest meets more pivots, until every pair of a bucket is linked, reached through links,
or refuted on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm import wordhash
from kinweave.llm.components import components
from kinweave.llm.scratch import stored
from kinweave.llm.wordhash import NOT_SPACE, Words
from kinweave.operators.skew import lookup

SHINGLE_WORDS = 5
#: Sets that share at least this part of their union are linked, unless the caller names another.
SIMILAR_PERCENT = 85
#: Permutations, each with a least and a greatest value; a band has at most so many of these values.
PERMUTATIONS = 90
BAND_VALUES = 6
#: A pair at the threshold may miss all bands with a probability below this.
MISSED = 1e-6
#: A class is described by its difference from a pivot if that is at most one in so many of their elements together.
HOME_PART = 3
#: Pivots of a bucket in a later round, as a power of the round.
PIVOT_GROWTH = 64

_draw = np.random.default_rng(23)
_FACTORS = _draw.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
_IN_BAND = _draw.integers(0, 2**63, BAND_VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_max_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row for each non-empty set: least and greatest value under each permutation, side by side."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), PERMUTATIONS, 2), np.uint64)
    for i in range(PERMUTATIONS):
        permuted = values * _FACTORS[i] + _SHIFTS[i]
        out[:, i, 0] = np.minimum.reduceat(permuted, starts)
        out[:, i, 1] = np.maximum.reduceat(permuted, starts)
    return out.reshape(len(sets), 2 * PERMUTATIONS)


def band_values(percent: int) -> int:
    """Values in a band: as many as find all but a part of ``MISSED`` of the pairs at the threshold, else one."""
    signed = 2 * PERMUTATIONS
    fits = (v for v in range(BAND_VALUES, 1, -1) if signed % v == 0 and (1 - (percent / 100) ** v) ** (signed // v) < MISSED)
    return next(fits, 1)


def band_keys(signatures: np.ndarray, values: int = BAND_VALUES) -> np.ndarray:
    """A key for each band of so many values, unlike those of other bands."""
    banded = signatures.reshape(len(signatures), -1, values)
    bands = np.arange(banded.shape[1], dtype=np.uint64)
    return wordhash.mixed((banded * _IN_BAND[:values]).sum(axis=2, dtype=np.uint64) + bands)


def _sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    data, bounds = wordhash.text_bytes(column)
    for i, j in wordhash.chunks(bounds):
        words = Words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], NOT_SPACE)
        yield wordhash.shingle_sets(words.hashes(), words.of_text, SHINGLE_WORDS)


def _sign(batches: Iterator[pa.RecordBatch], schema: pa.Schema, values: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for sets in _sets(batch.column(1)):
            full = [s for s in sets if len(s)]
            signed = iter(band_keys(min_max_signatures(full), values).view(np.int64) if full else ())
            for s in sets:
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                bands.append(next(signed) if len(s) else None)
        columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(c.cast(f.type) for c, f in zip(
            columns, list(schema)[1:], strict=True))], schema=schema)


def signatures(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """``_id, n_shingles, set_key, bands`` for each row; a text without words has 0 shingles and nulls."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([
        T.StructField("_id", docs.schema[id_column].dataType), T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.StringType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    arrow, values = to_arrow_schema(schema), band_values(percent)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return rows.mapInArrow(lambda batches: _sign(batches, arrow, values), schema)


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.view(np.int64) for part in _sets(batch.column(1)) for s in part]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["class_id", "shingles"])


def _may_link(n: Column, m: Column, percent: int) -> Column:
    """Sets whose sizes alone rule a link out are not compared."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` with the sizes ``n``, ``m`` of their sets and the elements ``only_a``, ``only_b`` of one."""
    own = sets.select(F.col("class_id").cast("string").alias("_node"), "shingles")
    with_a = lookup(pairs.withColumn("_node", F.col("a").cast("string")), own, "_node", "inner")
    with_a = with_a.select("a", "b", F.col("shingles").alias("_of_a"), F.col("b").cast("string").alias("_node"))
    both = lookup(with_a, own, "_node", "inner")
    return both.select(
        "a", "b", F.size("_of_a").alias("n"), F.size("shingles").alias("m"),
        F.array_sort(F.array_except("_of_a", "shingles")).alias("only_a"),
        F.array_sort(F.array_except("shingles", "_of_a")).alias("only_b"))


def _similar(n: Column, m: Column, differing: Column, percent: int) -> Column:
    """Sets of n and m elements of which so many are in one only: the common ones are enough of the union."""
    return (100 - percent) * (n + m) >= (100 + percent) * differing


def _pairs(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Members of a bucket beside its pivots, unless connected or of the same home; each pair once."""
    left = members.withColumn("_bucket", F.col("bucket").cast("string"))
    right = pivots.select(
        F.col("bucket").cast("string").alias("_bucket"), F.col("_p.class_id").alias("pivot"), F.col("_p.n").alias("_m"),
        F.col("_p.label").alias("_label"), F.col("_p.home").alias("_home"))
    beside = lookup(left, right, "_bucket", "inner").filter(
        (F.col("class_id") != F.col("pivot")) & (F.col("label") != F.col("_label")) & (F.col("home") != F.col("_home"))
        & _may_link(F.col("n"), F.col("_m"), percent))
    return beside.select(F.greatest("class_id", "pivot").alias("a"), F.least("class_id", "pivot").alias("b")).distinct()


def _homes(met: DataFrame, percent: int) -> DataFrame:
    """``home, class_id, n, excess, differing``: each class by its difference from the first pivot it resembles.

    ``differing`` has the elements that only one of class and home has, those of the class first. ``excess`` is such that
    two classes of a home that share no such element are linked if theirs add up to no more than zero.
    """
    differing = F.concat("only_a", "only_b")
    near = met.filter(HOME_PART * F.size(differing) <= F.col("n") + F.col("m")).groupBy("a").agg(
        F.min(F.struct("b", "n", "m", differing.alias("differing"))).alias("_h"))
    own = near.select(
        F.col("_h.b").alias("home"), F.col("a").alias("class_id"), F.col("_h.n").alias("n"),
        F.col("_h.differing").alias("differing"))
    pivots = near.groupBy(F.col("_h.b").alias("home")).agg(F.max("_h.m").alias("n")).select(
        "home", F.col("home").alias("class_id"), "n", F.array().cast("array<long>").alias("differing"))
    excess = (100 + percent) * F.size("differing") - (100 - percent) * F.col("n")
    return own.unionByName(pivots).withColumn("excess", excess)


def _with_stars(homes: DataFrame) -> DataFrame:
    """``homes`` with ``label``: the class of least excess if linked with it, as all are that are linked without sharing
    a difference; else the class itself."""
    least = homes.groupBy("home").agg(F.min(F.struct("excess", "class_id")).alias("_l")).select(
        F.col("home").cast("string").alias("_home"), F.col("_l.excess").alias("_least"), F.col("_l.class_id").alias("_star"))
    found = lookup(homes.withColumn("_home", F.col("home").cast("string")), least, "_home", "inner")
    label = F.when(F.col("excess") + F.col("_least") <= 0, F.col("_star")).otherwise(F.col("class_id"))
    return found.withColumn("label", label).drop("_home", "_least", "_star")


def _difference_links(named: DataFrame, percent: int) -> DataFrame:
    """Links of classes of one home that share differences from it, found and confirmed on the differences alone.

    The common part of a family cancels out, so its variants meet only where they depart from it alike.
    """
    rows = named.select(
        "home", "class_id", "n", "excess", "label", F.size("differing").alias("size"),
        F.posexplode("differing").alias("place", "element"))
    a, b = (rows.toDF(*[f"{side}_{c}" for c in rows.columns]) for side in ("a", "b"))
    room = 1 + F.least(F.col("a_size") - 1 - F.col("a_place"), F.col("b_size") - 1 - F.col("b_place"))
    needed = F.col("a_excess") + F.col("b_excess")
    met = a.join(b, (F.col("a_home") == F.col("b_home")) & (F.col("a_element") == F.col("b_element")) & (
        F.col("a_class_id") > F.col("b_class_id")) & (F.col("a_label") != F.col("b_label")) & _may_link(
        F.col("a_n"), F.col("b_n"), percent) & (2 * (100 + percent) * room >= needed))
    pairs = stored(met.select(
        F.col("a_home").alias("home"), F.col("a_class_id").alias("a"), F.col("b_class_id").alias("b"), needed.alias("needed"))
        .distinct(), "minhash-pairs")
    own = named.select("home", "class_id", "differing")
    x, y = (own.toDF(f"_{side}h", f"_{side}", f"_{side}d") for side in ("x", "y"))
    both = pairs.join(x, (F.col("home") == F.col("_xh")) & (F.col("a") == F.col("_x"))).join(
        y, (F.col("home") == F.col("_yh")) & (F.col("b") == F.col("_y")))
    shared = F.size(F.array_intersect("_xd", "_yd"))
    return both.filter(2 * (100 + percent) * shared >= F.col("needed")).select("a", "b")


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``classes`` with the label of their component, their own id if they have no link to a smaller one."""
    found = lookup(
        classes.withColumn("_class", F.col("class_id").cast("string")),
        labels.select(F.col("node").cast("string").alias("_class"), "label"), "_class")
    return found.withColumn("label", F.coalesce("label", "class_id")).drop("_class")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = SIMILAR_PERCENT,
) -> DataFrame:
    """``id_column, n_shingles, component_id, kept`` for each row of ``docs``.

    A document's set holds its distinct five-word shingles, of a shorter one the whole as one; words are runs without
    ASCII white space, A-Z in lower case. Documents are linked if their sets share ``percent`` of their union;
    ``component_id`` is the smallest id reachable, and that document is kept. Texts without words, null included, are
    linked with nothing. Rows with a null id are no documents: they are kept without a component. Rows that repeat an id
    are one document; if their texts differ, a link of any of them counts for it. An empty table gives an empty result.
    """
    signed = stored(signatures(docs, id_column, text_column, percent), "minhash-signatures")
    classes = stored(
        signed.filter(F.col("set_key").isNotNull() & F.col("_id").isNotNull())
        .groupBy("set_key").agg(
            F.min("_id").alias("class_id"), F.max("_id").alias("last_id"), F.max("n_shingles").alias("n"),
            F.min(F.struct("_id", "bands")).getField("bands").alias("bands")),
        "minhash-classes")
    rows = classes.select(F.explode("bands").alias("bucket"), "class_id", "n")
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > 1)
    found = lookup(
        rows.withColumn("_bucket", F.col("bucket").cast("string")),
        shared.select(F.col("bucket").cast("string").alias("_bucket")), "_bucket", "left_semi")
    members = stored(found.select("bucket", "class_id", "n", F.col("class_id").alias("label"), F.col("class_id").alias("home")), "minhash-members")

    asked = members.select(F.col("class_id").alias("_class")).distinct()
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    texts = texts.join(asked, F.col("_id") == F.col("_class"), "left_semi")
    sets = stored(
        texts.mapInArrow(_shingles, "class_id long, shingles array<long>")
        .groupBy("class_id", F.xxhash64("shingles").alias("_same")).agg(F.min("shingles").alias("shingles"))
        .select("class_id", "shingles"), "minhash-sets")
    labels = _connect(members, sets, percent)

    copies = classes.filter(F.col("last_id") > F.col("class_id")).select("set_key", "class_id")
    named = lookup(signed.select("_id", "n_shingles", "set_key"), copies, "set_key")
    named = named.withColumn("_class", F.coalesce("class_id", "_id").cast("string"))
    reached = lookup(named, labels.select(F.col("node").cast("string").alias("_class"), "label"), "_class")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("label", "class_id", "_id"))
    return reached.select(
        F.col("_id").alias(id_column), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


def _connect(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, label`` of the components of all links between members of the same bucket."""
    pivots = members.groupBy("bucket").agg(F.min(F.struct("class_id", "n", "label", "home")).alias("_p"))
    pairs = stored(_pairs(members, pivots, percent), "minhash-pairs")
    met = stored(compared(pairs, sets), "minhash-compared")
    differing = F.size("only_a") + F.size("only_b")
    links = met.filter(_similar(F.col("n"), F.col("m"), differing, percent)).select("a", "b")
    homes = stored(_with_stars(_homes(met, percent)), "minhash-homes")
    stars = homes.filter(F.col("class_id") != F.col("label")).select(F.col("class_id").alias("a"), F.col("label").alias("b"))
    links = stored(links.union(stars).union(_difference_links(homes, percent)), "minhash-links")
    labels = components(links)

    # What is left are pairs of different homes, met by more and more pivots of their buckets.
    tested, turn = pairs, 1
    home = homes.filter(F.col("class_id") != F.col("home")).select(F.col("class_id").cast("string").alias("_class"), "home")
    pivot_home = homes.filter(F.col("class_id") == F.col("home")).select(
        F.col("home").cast("string").alias("_class"), F.col("home").alias("_own"))
    members = members.drop("home").withColumn("_class", F.col("class_id").cast("string"))
    members = lookup(lookup(members, home, "_class"), pivot_home, "_class")
    members = members.withColumn("home", F.coalesce("home", "_own", "class_id")).drop("_class", "_own")
    while True:
        named = _labelled(members.drop("label"), labels)
        split = named.groupBy("bucket").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("label", "home")])
        split = split.filter((F.col("min_label") < F.col("max_label")) & (F.col("min_home") < F.col("max_home"))).select(
            F.col("bucket").cast("string").alias("_bucket"))
        members = lookup(named.withColumn("_bucket", F.col("bucket").cast("string")), split, "_bucket", "left_semi")
        members = stored(members.select("bucket", "class_id", "n", "label", "home"), "minhash-members")
        if members.isEmpty():
            return labels
        slot = F.pmod(F.xxhash64("class_id", F.lit(turn)), F.lit(PIVOT_GROWTH**turn))
        pivots = stored(
            members.groupBy("bucket", slot.alias("_slot")).agg(F.min(F.struct("class_id", "n", "label", "home")).alias("_p")),
            "minhash-pivots")
        pairs = stored(_pairs(members, pivots, percent).join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        tested = tested.unionByName(pairs)
        met = compared(pairs, sets)
        new = met.filter(_similar(F.col("n"), F.col("m"), differing, percent)).select("a", "b")
        new = stored(new, "minhash-links")
        if not new.isEmpty():
            links = links.union(new)
            labels = components(links)
        # A pivot has met all of its bucket and leaves it.
        seen = pivots.select(F.col("bucket").alias("_b"), F.col("_p.class_id").alias("_c"))
        members = members.join(seen, (F.col("bucket") == F.col("_b")) & (F.col("class_id") == F.col("_c")), "left_anti")
        turn += 1
