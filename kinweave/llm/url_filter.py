"""Verdicts on URLs: host and path rules first, a weighted vocabulary for the rest.

Rules are DataFrame expressions. The vocabulary is one Aho-Corasick automaton, run over each URL in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules become expressions of the plan; a longer list belongs into a table.
MAX_RULES = 1_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Vocabulary:
    """Lower-case terms. One strict term, or ``soft_limit`` distinct soft terms, reject a URL."""

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    soft_limit: int = 2


#: Fixed values.
VOCABULARY = Vocabulary(
    strict=("casino", "cialis", "escort", "porn", "viagra", "xxx"),
    soft=(
        "adult", "bet", "bonus", "cheap", "dating", "discount", "farm", "free", "loan", "pills", "poker", "replica",
        "sex", "spam", "win"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def _matched_rule(rules: Sequence[Rule], host: Column, path: Column, value: str) -> Column:
    """``value`` of the longest rule that fits; of equally long ones the last in order of text."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        own_host = (host == rule.host) | host.endswith(f".{rule.host}")
        found = F.when(own_host & path.startswith(rule.path), F.lit(getattr(rule, value))).otherwise(found)
    return found


def term_hits(urls: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``n_strict`` and ``n_soft``, distinct terms found in column ``_url`` of (``_id``, ``_url``, ...), appended.

    A term counts where the characters beside it are neither ASCII letters or digits nor beyond ASCII.
    """
    names = urls.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for kind, terms in ((1, vocabulary.soft), (0, vocabulary.strict)):
            for term in terms:
                automaton.add_word(term, (kind, term))
        if len(automaton):
            automaton.make_automaton()

        def inside(text: str, at: int) -> bool:
            return 0 <= at < len(text) and (text[at].isalnum() or text[at] > "\x7f")

        for batch in batches:
            counts = ([], [])
            for url in batch.column(names.index("_url")).to_pylist():
                found = (set(), set())
                text = (url or "").translate(_FOLD)
                for last, (kind, term) in automaton.iter(text) if len(automaton) and text else ():
                    if not inside(text, last - len(term)) and not inside(text, last + 1):
                        found[kind].add(term)
                for kind in (0, 1):
                    counts[kind].append(len(found[kind]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int32()) for c in counts)], [*names, "n_strict", "n_soft"])

    schema = T.StructType([
        *urls.schema.fields, T.StructField("n_strict", T.IntegerType()), T.StructField("n_soft", T.IntegerType())])
    return urls.mapInArrow(scan, schema)


_FOLD = str.maketrans(_UPPER, _LOWER)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], vocabulary: Vocabulary, id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """``id_column, host, path, rule, verdict, n_strict, n_soft`` for each row of ``pages``; verdicts allow or block.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in ASCII lower case; the path goes
    on up to ``?``, ``#`` or the end. A null URL and one without ``://`` have neither, fit no rule, and the vocabulary
    decides; a null or empty URL is allowed. Repeated rows are judged each; other columns are not read.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES}")
    urls = pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url"))
    url = F.coalesce("_url", F.lit(""))
    parted = term_hits(urls, vocabulary).select(
        "*",
        ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).alias("_host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("_path"))
    ruled = parted.select(
        "*", _matched_rule(rules, F.col("_host"), F.col("_path"), "text").alias("_rule"),
        _matched_rule(rules, F.col("_host"), F.col("_path"), "verdict").alias("_ruled"))
    rejected = (F.col("n_strict") > 0) | (F.col("n_soft") >= vocabulary.soft_limit)
    return ruled.select(
        F.col("_id").alias(id_column), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_ruled", F.when(rejected, "block").otherwise("allow")).alias("verdict"), "n_strict", "n_soft")
