"""Removal of lines that an earlier line nearly equals, by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity in the whole corpus, and two similar sets share one of their
rarest words: only lines that meet on a word of their prefixes are compared, if their lengths, the places of the word
and a parity signature of the sets allow the similarity, and then on the full sets. Lines with equal sets are one first;
of short lines that is all, as no others are similar enough. Candidates pass a wider signature before their words are moved.
Before the join each line is compared with the first of those that share its least or greatest hash, which settles
large families of variants without pairing them. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.names import free
from kinweave.llm.scratch import drop_folder, new_path, stored

#: Lines with at least this part of their united words in common are near equal.
SIMILAR_PERCENT = 85
#: Lines with fewer distinct words nearly equal none but those of equal sets: one word more or less is too much.
LEAST_NEAR_WORDS = -(-SIMILAR_PERCENT // (100 - SIMILAR_PERCENT))
#: Classes of words by hash, of which a table says how frequent the most frequent word is: of fixed size, whatever the vocabulary.
RARITY_CLASSES = 1 << 16
#: Lists of line numbers are sent to every task if they measure at most so many bytes; beyond, texts are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Longs of the signature that candidates are tested by.
SIGNATURE = 4

_SPACES, _OTHER_SPACE, _WORD = r"[\x20\x09-\x0D]+", r"[\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _words(line: Column) -> Column:
    """Words of a line in lower case, and empty texts where spaces meet. A pattern is needed only for other white space."""
    line = F.lower(line)
    return F.when(line.rlike(_OTHER_SPACE), F.split(line, _SPACES)).otherwise(F.split(line, " "))


def _tokens(line: Column) -> Column:
    """Distinct hashes of the words of a line."""
    return F.array_distinct(F.transform(F.array_remove(_words(line), ""), lambda w: F.xxhash64(w)))


def rarity(docs: DataFrame) -> Column:
    """An array literal: for each class of words a number below 128 that grows with the logarithm of how often the most
    frequent word of the class occurs in all texts. Each word is counted, so rare words of a large vocabulary do not add up."""
    lines = docs.select(F.explode(F.split("_text", "\n")).alias("_line"))
    words = lines.select(F.explode(_words(F.col("_line"))).alias("_w")).filter("_w <> ''").select(F.xxhash64("_w").alias("_h"))
    counted = words.groupBy("_h").agg(F.count(F.lit(1)).alias("n"))
    classes = counted.groupBy(F.col("_h").bitwiseAND(F.lit(RARITY_CLASSES - 1)).alias("class")).agg(F.max("n").alias("n"))
    table = [0] * RARITY_CLASSES
    for row in classes.collect():
        table[row["class"]] = min(127, round(3 * math.log2(row["n"] + 1)))
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _parity(tokens: Column | str, bit: Callable[[Column], Column]) -> Column:
    """A long in which for each token the bit of the number that ``bit`` gives (0 to 63) is flipped."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda seen, t: seen.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), bit(t).cast("int"))))


def line_sets(docs: DataFrame, table: Column) -> DataFrame:
    """For each line its set key, size, parity signature, least and greatest token, and prefix of rarest tokens."""
    lines = docs.select("_id", F.posexplode(F.split("_text", "\n")).alias("line_no", "_line"))
    # A test of the text, not of the tokens: Catalyst moves it below them, and with it what it would have to compute twice.
    lines = lines.filter(F.col("_line").rlike(_WORD)).select("_id", "line_no", _tokens(F.col("_line")).alias("tokens"))
    # Rarity above, hash below in one number: sorted, these are the words from the rarest on, and name the set.
    ranks = F.sort_array(F.transform("tokens", lambda t: F.shiftleft(
        F.get(table, t.bitwiseAND(F.lit(RARITY_CLASSES - 1)).cast("int")), 56).bitwiseOR(F.shiftrightunsigned(t, 8))))
    ranked = lines.select(
        "_id", "line_no", F.size("tokens").alias("n"), _parity("tokens", lambda t: t.bitwiseAND(F.lit(63))).alias("bits"),
        F.array_min("tokens").alias("least"), F.array_max("tokens").alias("greatest"), ranks.alias("ranks"))
    n = F.col("n")
    prefix = F.slice("ranks", F.lit(1), F.when(
        n >= LEAST_NEAR_WORDS, n - F.ceil(n * SIMILAR_PERCENT / 100).cast("int") + 1).otherwise(0))
    return ranked.select(
        "_id", "line_no", F.xxhash64("ranks").alias("key1"), F.xxhash64(F.lit(1), F.col("ranks")).alias("key2"), "n", "bits",
        "least", "greatest", F.transform(prefix, lambda r: r.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("prefix"))


def _may_match(n: Column, m: Column, bits: Column, other_bits: Column) -> Column:
    """Length filter, and signature filter: words that only one of the lines has show as odd bits."""
    lengths = 100 * F.least(n, m) >= SIMILAR_PERCENT * F.greatest(n, m)
    differing = (100 + SIMILAR_PERCENT) * F.bit_count(bits.bitwiseXOR(other_bits)) <= (100 - SIMILAR_PERCENT) * (n + m)
    return lengths & differing


def _earlier(a_id: Column, a_line: Column, b_id: Column, b_line: Column) -> Column:
    return (a_id < b_id) | ((a_id == b_id) & (a_line < b_line))


def _first_pairs(sets: DataFrame, key: str) -> DataFrame:
    """Each line beside the first of those with the same ``key``."""
    first = sets.groupBy(key).agg(
        F.min(F.struct("_id", "line_no", "n", "bits")).alias("_f"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    first = first.select(F.col(key).cast("string").alias("_key"), "_f.*").toDF("_key", "b_id", "b_line", "m", "other_bits")
    own = sets.select(F.col(key).cast("string").alias("_own"), "_id", "line_no", "n", "bits")
    matched = own.join(first, (F.col("_own") == F.col("_key")) & _may_match(
        F.col("n"), F.col("m"), F.col("bits"), F.col("other_bits")) & _earlier(
        F.col("b_id"), F.col("b_line"), F.col("_id"), F.col("line_no")))
    return matched.select(F.col("_id").alias("a_id"), F.col("line_no").alias("a_line"), "b_id", "b_line")


def _prefix_pairs(sets: DataFrame) -> DataFrame:
    """Open lines beside all earlier lines that meet them on a word of both prefixes, after the filters."""
    # Both sides are the same rows, and all that tells them apart is one expression on the two, which no side takes for a
    # filter of its own: so the words are shuffled once.
    rows = sets.select("_id", "line_no", "n", "bits", "open", F.posexplode("prefix").alias("place", "token"))
    half = F.lit(1 << 32)
    columns = ("id", "line", "token", "bits", "sizes")
    rows = rows.select("_id", "line_no", "token", "bits", F.when(F.col("open"), 1).otherwise(-1) * (
        F.col("n").cast("long") * half + F.col("place")))
    a, b = (rows.toDF(*[f"{side}_{c}" for c in columns]) for side in ("a", "b"))
    n, m = (F.shiftright(F.abs(f"{side}_sizes"), 32) for side in ("a", "b"))
    i, j = (F.abs(f"{side}_sizes").bitwiseAND(half - 1) for side in ("a", "b"))
    room = 1 + F.least(n - 1 - i, m - 1 - j)
    wanted = (F.col("a_sizes") > 0) & F.col("b_sizes").isNotNull() & _earlier(
        F.col("b_id"), F.col("b_line"), F.col("a_id"), F.col("a_line")) & _may_match(
        n, m, F.col("a_bits"), F.col("b_bits")) & ((100 + SIMILAR_PERCENT) * room >= SIMILAR_PERCENT * (n + m))
    matched = a.join(b, (F.col("a_token") == F.col("b_token")) & F.when(F.col("b_line") >= 0, wanted))
    return matched.select("a_id", "a_line", "b_id", "b_line")


def _measured(lists: DataFrame, numbers: str) -> DataFrame:
    """``lists``, a stored table of ids and lists of ``numbers``, to be broadcast if its bytes are few enough."""
    held = lists.agg(F.sum(64 + 4 * F.size(numbers).cast("long"))).first()[0] or 0
    return F.broadcast(lists) if held <= BROADCAST_BYTES else lists


def _verified(pairs: DataFrame, docs: DataFrame, folder: str, name: str) -> DataFrame:
    """``_id, line_no`` of the lines in ``pairs`` whose full set is similar enough to that of their partner."""
    wanted = pairs.select(F.col("a_id").alias("_w"), F.col("a_line").alias("_l")).union(pairs.select("b_id", "b_line"))
    wanted = stored(wanted.groupBy("_w").agg(F.collect_set("_l").alias("_ls")), f"{name}-wanted", folder)
    lines = F.split("_text", "\n")
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("line_no"), line.alias("line")))
    named = F.transform(
        F.filter(numbered, lambda x: F.array_contains("_ls", x["line_no"])),
        lambda x: F.struct(x["line_no"].alias("line_no"), _tokens(x["line"]).alias("tokens")))
    found = docs.join(_measured(wanted, "_ls"), F.col("_id") == F.col("_w")).select("_id", F.inline(named))
    tokens = stored(found.dropDuplicates(["_id", "line_no"]), f"{name}-tokens", folder)

    # Each long of the signature is the parity of its own part of the words, so odd bits of all add up to at most the words
    # that one of the lines has alone. Only candidates that pass have their words moved.
    parts = [
        _parity(F.filter("tokens", lambda t: F.shiftright(t, 8).bitwiseAND(F.lit(SIGNATURE - 1)) == part),
                lambda t: F.shiftright(t, 16).bitwiseAND(F.lit(63))) for part in range(SIGNATURE)]
    signed = tokens.select("_id", "line_no", F.size("tokens").alias("n"), *[p.alias(f"s{i}") for i, p in enumerate(parts)])
    a, b = (signed.toDF(*[f"{side}_{c}" for c in ("of", "at", "n", *[f"s{i}" for i in range(SIGNATURE)])]) for side in ("x", "y"))
    odd = sum((F.bit_count(F.col(f"x_s{i}").bitwiseXOR(F.col(f"y_s{i}"))) for i in range(SIGNATURE)), F.lit(0))
    near = pairs.join(a, (F.col("a_id") == F.col("x_of")) & (F.col("a_line") == F.col("x_at"))).join(
        b, (F.col("b_id") == F.col("y_of")) & (F.col("b_line") == F.col("y_at"))).filter(
        (100 + SIMILAR_PERCENT) * odd <= (100 - SIMILAR_PERCENT) * (F.col("x_n") + F.col("y_n")))
    near = stored(near.select("a_id", "a_line", "b_id", "b_line"), f"{name}-near", folder)

    a, b = (tokens.toDF(f"_{s}", f"_{s}l", f"{s}_tokens") for s in ("a", "b"))
    both = near.join(a, (F.col("a_id") == F.col("_a")) & (F.col("a_line") == F.col("_al"))).join(
        b, (F.col("b_id") == F.col("_b")) & (F.col("b_line") == F.col("_bl")))
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    united = F.size("a_tokens") + F.size("b_tokens") - shared
    return stored(both.filter(100 * shared >= SIMILAR_PERCENT * united).select(
        F.col("a_id").alias("_id"), F.col("a_line").alias("line_no")).distinct(), f"{name}-verified", folder)


def repeated_lines(docs: DataFrame, folder: str) -> DataFrame:
    """``_id, line_no`` of lines of (``_id``, ``_text``) that nearly equal an earlier one, by id and place in the text.

    Steps are written to ``folder``, from which the result is read.
    """
    every = stored(line_sets(docs, rarity(docs)), "sets", folder)
    sets = stored(
        every.groupBy("key1", "key2").agg(
            F.min(F.struct("_id", "line_no", "n", "bits", "least", "greatest", "prefix")).alias("_s"),
            F.count(F.lit(1)).alias("copies")).select("key1", "key2", "copies", "_s.*"), "distinct", folder)
    firsts = sets.filter(F.col("copies") > 1).select(
        F.col("key1").alias("_k1"), F.col("key2").alias("_k2"), F.col("_id").alias("_fid"), F.col("line_no").alias("_fl"))
    copies = every.select("_id", "line_no", "key1", "key2").join(
        firsts, (F.col("key1") == F.col("_k1")) & (F.col("key2") == F.col("_k2")) & _earlier(
            F.col("_fid"), F.col("_fl"), F.col("_id"), F.col("line_no"))).select("_id", "line_no")

    larger = sets.filter(F.col("n") >= LEAST_NEAR_WORDS)
    near = stored(_first_pairs(larger, "least").union(_first_pairs(larger, "greatest")).distinct(), "first-pairs", folder)
    settled = _verified(near, docs, folder, "first")
    known = settled.select(F.col("_id").alias("_sid"), F.col("line_no").alias("_sl"), F.lit(True).alias("_settled"))
    opened = larger.join(known, (F.col("_id") == F.col("_sid")) & (F.col("line_no") == F.col("_sl")), "left").select(
        "_id", "line_no", "n", "bits", F.col("_settled").isNull().alias("open"), "prefix")
    pairs = stored(_prefix_pairs(opened).distinct(), "pairs", folder)
    return copies.union(settled).union(_verified(pairs, docs, folder, "prefix"))


def without_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_lines`` and ``n_removed``, its texts without lines that nearly equal an earlier line.

    Lines are split at line feeds and come in order of id and place, in all documents together. A line goes if its words,
    in lower case, share ``SIMILAR_PERCENT`` of the union with those of an earlier line, whether that one stays or not;
    lines without any word stay. A null text stays null and has no lines; an empty one has one.
    Rows with a null id lose nothing and cause no loss; rows that repeat an id are one document, equal in text. The other
    columns are passed on, but one called ``n_lines`` or ``n_removed`` gives way.
    """
    docs = docs.drop("n_lines", "n_removed")
    rows = docs.filter(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    folder = new_path(docs.sparkSession, "line-dedup")
    gone = stored(
        repeated_lines(rows, folder).groupBy("_id").agg(F.collect_set("line_no").alias("_gone")), "line-removed")
    drop_folder(docs.sparkSession, folder)
    of, places = free("_gone_id", docs), free("_gone", docs)
    gone = _measured(gone.select(F.col("_id").alias(of), F.col("_gone").alias(places)), places)
    lines = F.split(text_column, "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(places, i)), "\n")
    return docs.join(gone, F.col(id_column) == F.col(of), "left").select(
        *[F.when(F.col(places).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_column else F.col(c)
          for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col(places).isNull(), 0).otherwise(F.size(places)).cast("long").alias("n_removed"))
