"""Quality rules whose thresholds come from the corpus itself, per language and source.

Counts of a text become integer measures. A sketch of a measure counts values by their leading bits, so a quantile is
known to about 3 %, sketches merge by adding counts, and the result does not depend on the order of the rows. Outliers
by the quartiles of the own group are rejected; a small group takes the merged sketch of its language, or of all.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.skew import lookup

WINDOW_WORDS = 5
LEAST_WORDS = 10
#: Base rule: at most so many of 100 words lie in repeated windows.
REPEATED_PERCENT = 20
#: A group with fewer documents than this takes the sketch of the next larger one.
LEAST_DOCUMENTS = 200
#: Leading bits of a value that a sketch keeps.
SKETCH_BITS = 6

_SPACE = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Measure:
    """A measure, the least spread its fences assume, and whether low values are outliers too. Per thousand."""

    name: str
    value: Column
    least_spread: int
    low: bool = False


def _per_thousand(part: str, whole: str) -> Column:
    return F.expr(f"CASE WHEN {whole} > 0 THEN (1000 * {part}) DIV {whole} ELSE 0L END")


def measures() -> Sequence[Measure]:
    return (
        Measure("word_length", _per_thousand("word_chars", "n_words"), 1000, low=True),
        Measure("symbols", _per_thousand("n_symbols", "n_words"), 30),
        Measure("dup_lines", _per_thousand("n_dup_lines", "n_lines"), 150),
        Measure("repeat_words", _per_thousand("n_repeat_words", "n_words"), 60),
    )


def text_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``.

    Words are runs without ASCII white space; lines are split at line feeds and count if they hold a word; a repeated
    word lies in a window of five words that occurs twice or more in the text, the first time included. Null and empty
    texts count nothing. A column of ``docs`` called like one of the counts gives way.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    others = [c for c in docs.columns if c != text_column and c.lower() not in counts]
    text = F.coalesce(F.col(text_column), F.lit(""))
    bare = F.btrim(text, F.lit(_SPACES))
    split = docs.select(
        F.struct(*others).alias("_row"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{_SPACE}+")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_SPACES)) != "").alias("_lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    # A hash for each window. Only where two are equal are the windows sorted to find which.
    n = F.size("_words")
    window = F.transform(
        F.sequence(F.lit(1), n - (WINDOW_WORDS - 1)), lambda i: F.xxhash64(F.slice(F.col("_words"), i, WINDOW_WORDS)))
    hashed = split.select(
        "*", F.when(n >= WINDOW_WORDS, window).otherwise(F.array().cast("array<long>")).alias("_windows"))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = hashed.select("*", F.when(repeats, F.sort_array(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))).alias("_ordered"))
    twice = F.filter("_ordered", lambda w, i: (
        F.coalesce(w["h"] == F.get(F.col("_ordered"), i - 1)["h"], F.lit(False))
        | F.coalesce(w["h"] == F.get(F.col("_ordered"), i + 1)["h"], F.lit(False))))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda w: w["at"])), F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, at: F.struct(
            (a["n"] + at + WINDOW_WORDS - F.greatest(at, a["upto"])).alias("n"), (at + WINDOW_WORDS).alias("upto")),
        lambda a: a["n"])
    return ordered.select(
        *[F.col("_row").getField(c).alias(c) for c in others], F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def _sketch_bin(value: Column) -> Column:
    """The value with all but its leading bits set to zero."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame, group: Sequence[str]) -> DataFrame:
    """``level, key, measure, bin, n``: mergeable sketches of documents that pass the base rules.

    Level 0 has the columns of ``group`` as its key, the next the columns without the last, the last level all rows.
    """
    values = F.array(*[F.struct(F.lit(m.name).alias("measure"), _sketch_bin(m.value).alias("bin")) for m in measures()])
    rows = counted.filter(~base_failed()).select(*group, F.explode(values).alias("_v")).select(*group, "_v.*")
    own = rows.groupBy(*group, "measure", "bin").agg(F.count(F.lit(1)).alias("n"))
    return (
        own.select(F.explode(_levels(group)).alias("_l"), "measure", "bin", "n")
        .groupBy("_l.level", "_l.key", "measure", "bin").agg(F.sum("n").alias("n")))


def _levels(group: Sequence[str]) -> Column:
    return F.array(*[
        F.struct(F.lit(level).alias("level"), _key(group[:len(group) - level]).alias("key"))
        for level in range(len(group) + 1)])


def _key(columns: Sequence[str]) -> Column:
    """A text for the values, null unlike empty."""
    return F.to_json(F.struct(F.lit(len(columns)).alias("level"), *columns))


def fences(sketch: DataFrame) -> DataFrame:
    """``level, key, documents`` and for each measure the lowest and highest value that is no outlier."""
    whole = Window.partitionBy("level", "key", "measure")
    ranked = sketch.withColumns({
        "_upto": F.sum("n").over(whole.orderBy("bin")), "_all": F.sum("n").over(whole)})
    quartiles = ranked.groupBy("level", "key", "measure").agg(
        F.max("_all").alias("documents"), F.min(F.when(4 * F.col("_upto") >= F.col("_all"), F.col("bin"))).alias("q1"),
        F.min(F.when(4 * F.col("_upto") >= 3 * F.col("_all"), F.col("bin"))).alias("q3"))
    columns = [F.max("documents").alias("documents")]
    for m in measures():
        own = F.col("measure") == m.name
        reach = 3 * F.greatest(F.col("q3") - F.col("q1"), F.lit(m.least_spread))
        columns.append(F.max(F.when(own, F.col("q3") + reach)).alias(f"{m.name}_high"))
        if m.low:
            columns.append(F.max(F.when(own, F.col("q1") - reach)).alias(f"{m.name}_low"))
    return quartiles.groupBy("level", "key").agg(*columns)


def group_fences(counted: DataFrame, sketch: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group_key`` of each group and its fences: its own, or those of the first larger group with enough documents."""
    groups = counted.select(*group).distinct()
    asked = groups.select(_key(group).alias("group_key"), F.explode(_levels(group)).alias("_l"))
    asked = asked.select("group_key", F.col("_l.level").alias("_level"), F.col("_l.key").alias("_asked"))
    found = fences(sketch)
    limits = [c for c in found.columns if c not in ("level", "key", "documents")]
    enough = (F.col("documents") >= LEAST_DOCUMENTS) | (F.col("level") == len(group))
    return (
        asked.join(found, (F.col("_asked") == F.col("key")) & (F.col("_level") == F.col("level"))).filter(enough)
        .groupBy("group_key").agg(F.min(F.struct("level", *limits)).alias("_f")).select("group_key", "_f.*"))


def judge(counted: DataFrame, limits: DataFrame, group: Sequence[str]) -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``: base rules passed, and no measure beyond its fences."""
    keyed = counted.withColumn("group_key", _key(group))
    known = lookup(keyed, limits, "group_key")
    inside = F.lit(True)
    for m in measures():
        inside &= m.value <= F.col(f"{m.name}_high")
        if m.low:
            inside &= m.value >= F.col(f"{m.name}_low")
    return known.withColumn("base_failed", base_failed()).select(
        *counted.columns, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
