"""Toxicity by multiple-instance learning: labels are known for documents, scores are made for sentences.

A sentence is toxic with probability ``sigmoid(bias + sum of the weights of its distinct features)``, features being
words, their stems and their endings; a document is, if any of its sentences is (noisy-or). Weights and bias are fitted to
labels of documents; afterwards the sentence scores say where the offence stands. Training takes a bounded sample of
labelled documents, scoring all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm import wordhash
from kinweave.llm.wordhash import ALPHANUMERIC, Words

#: The bounds of the training sample: documents, and bytes of one document.
TRAIN_DOCUMENTS = 4_000
TRAIN_BYTES = 65_536
#: Stems and endings of so many bytes are features beside the words, for languages that inflect.
PART_BYTES = (3, 4, 5, 6)
#: From this probability on a sentence is reported.
OFFENDING = 0.5

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass(frozen=True)
class Model:
    """Sorted hashes of features, their weights, and the bias of a sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


@dataclass
class _Sentences:
    """Sentences of some texts: the text of each sentence, and the sentence of each word."""

    text: np.ndarray
    of_word: np.ndarray
    words: Words

    @staticmethod
    def of(data: np.ndarray, bounds: np.ndarray) -> _Sentences:
        words = Words(data, bounds, ALPHANUMERIC)
        text_of_word = np.repeat(np.arange(len(bounds) - 1), np.diff(words.of_text))
        breaks = np.concatenate([[0], np.cumsum(_ENDS[words.data])])[words.starts]
        new = np.ones(len(breaks), bool)
        new[1:] = (breaks[1:] != breaks[:-1]) | (text_of_word[1:] != text_of_word[:-1])
        return _Sentences(text_of_word[new], np.cumsum(new) - 1, words)


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, _Sentences]]:
    """The texts in runs of bounded size, each with the indices of its first text and of the one after its last."""
    data, bounds = wordhash.text_bytes(texts)
    for i, j in wordhash.chunks(bounds):
        yield i, j, _Sentences.of(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])


def _features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and hashes: of all words, then of the stems and endings of the longer ones."""
    yield np.arange(len(words.starts)), words.hashes()
    sizes = words.ends - words.starts
    for n in PART_BYTES:
        at = np.flatnonzero(sizes > n)
        yield at, wordhash.mixed(words.hashes_of(words.starts[at], words.starts[at] + n) + np.uint64(n))
        yield at, wordhash.mixed(words.hashes_of(words.ends[at] - n, words.ends[at]) + np.uint64(n + 64))


def _bits(features: np.ndarray) -> np.ndarray:
    """A table by the leading bits of a hash that rules out nearly all features the model does not know."""
    bits = np.zeros(1 << 20, bool)
    bits[(features >> np.uint64(44)).astype(np.int64)] = True
    return bits


def _matches(part: _Sentences, known: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a sentence and a known feature that occurs in it."""
    pairs = [np.empty(0, np.int64)]
    for at, hashes in _features(part.words) if len(known) else ():
        maybe = np.flatnonzero(bits[(hashes >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        hit = known[place] == hashes[maybe]
        pairs.append((part.of_word[at[maybe[hit]]] << 32) | place[hit])
    distinct = np.unique(np.concatenate(pairs))
    return distinct >> 32, distinct & 0xFFFFFFFF


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _evidence(of_toxic: np.ndarray, in_docs: np.ndarray, share: float) -> np.ndarray:
    """Likelihood ratio of a feature's own share of toxic documents against the share of all; 0 unless it is larger."""
    own = of_toxic / in_docs
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = of_toxic * np.log(own / share) + np.nan_to_num((in_docs - of_toxic) * np.log((1 - own) / (1 - share)))
    return np.where(own > share, 2 * gain, 0)


def _in_documents(texts: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, and in how many documents and toxic documents each occurs."""
    found, toxic = [], []
    for first, _, part in _parts(texts):
        text = part.text[part.of_word]
        for at, hashes in _features(part.words):
            order = np.lexsort((hashes, text[at]))
            doc, feature = text[at][order], hashes[order]
            new = np.ones(len(order), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
            found.append(feature[new])
            toxic.append(y[first + doc[new]])
    features, which, in_docs = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    return features, in_docs, np.bincount(which, weights=np.concatenate(toxic), minlength=len(features))


def fit(texts: pa.Array, toxic: np.ndarray, steps: int = 400, rate: float = 0.1, shrink: float = 1e-6) -> Model:
    """Weights by gradient descent on the likelihood of the document labels. The same input gives the same model.

    Takes part what occurs in more toxic documents than chance explains, at a level at which about one feature of all
    would by chance.
    """
    y = toxic.astype(float)
    features, in_docs, of_toxic = _in_documents(texts, y)
    used = _evidence(of_toxic, in_docs, y.mean()) > 2 * np.log(max(len(features), 2))
    features, of_toxic, of_clean = features[used], of_toxic[used], (in_docs - of_toxic)[used]

    n, bits, owners, sentences, words = 0, _bits(features), [], [], []
    for first, _, part in _parts(texts):
        sentence, word = _matches(part, features, bits)
        sentences.append(sentence + n)
        words.append(word)
        owners.append(part.text + first)
        n += len(part.text)
    owner, sentence, word = (np.concatenate(x) for x in (owners, sentences, words))

    weights = np.log((of_toxic + 0.5) / (y.sum() + 1)) - np.log((of_clean + 0.5) / (len(y) - y.sum() + 1))
    bias, moments = -5.0, [np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)]
    for step in range(1, steps + 1):
        p = _sigmoid(bias + np.bincount(sentence, weights=weights[word], minlength=n))
        none = np.exp(np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)))
        pull = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0)[owner] * p / len(y)
        slope = np.append(np.bincount(word, weights=pull[sentence], minlength=len(weights)) + shrink * weights, pull.sum())
        moments = [0.9 * moments[0] + 0.1 * slope, 0.99 * moments[1] + 0.01 * slope**2]
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(features, weights, float(bias))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> Model:
    """A model from at most ``TRAIN_DOCUMENTS`` labelled documents of at most ``TRAIN_BYTES``, drawn by a hash of the id.

    Rows of ``labels`` without id or label are ignored; an id labelled both ways counts as toxic; of repeated documents
    one text is taken. Without labelled documents, or with one class only, nothing is ever toxic.
    """
    drawn = (
        labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_DOCUMENTS))
    short = docs.filter(F.octet_length(text_column) <= TRAIN_BYTES)
    rows = (
        short.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
        .join(F.broadcast(drawn), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_label").alias("_label"))
        .orderBy("_id").toArrow())
    toxic = np.asarray(rows["_label"].to_numpy(zero_copy_only=False)) > 0
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model(np.empty(0, np.uint64), np.empty(0), -20.0)
    return fit(rows["_text"].combine_chunks(), toxic)


def _scored(texts: pa.Array, model: Model, bits: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
    """The score of each text and its offending sentences."""
    scores, places = [np.empty(0)], []
    for first, end, part in _parts(texts):
        sentence, word = _matches(part, model.features, bits)
        n = len(part.text)
        p = _sigmoid(model.bias + np.bincount(sentence, weights=model.weights[word], minlength=n)[:n])
        none = np.bincount(part.text, weights=np.log1p(-np.minimum(p, 1 - 1e-15)), minlength=end - first)
        scores.append(-np.expm1(none))
        own: dict[int, list[dict]] = {}
        words, firsts = part.words, np.searchsorted(part.of_word, np.arange(n + 1))
        for s in np.flatnonzero(p >= OFFENDING).tolist():
            start = int(words.bounds[part.text[s]])
            own.setdefault(int(part.text[s]), []).append({
                "first_byte": int(words.starts[firsts[s]]) - start,
                "end_byte": int(words.ends[firsts[s + 1] - 1]) - start, "score": float(p[s])})
        places += [own.get(k, []) for k in range(end - first)]
    return np.clip(np.concatenate(scores), 0, 1), places


def _score(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    bits = _bits(model.features)
    for batch in batches:
        scores, places = _scored(batch.column(1), model, bits)
        columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(places, schema.field(2).type)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column, score, offending`` for each row of ``docs``, repeated ones included.

    ``offending`` lists the sentences with a probability of at least ``OFFENDING``, by their places in UTF-8 bytes. A
    text without words, null included, scores 0. Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    place = T.StructType([
        T.StructField("first_byte", T.LongType()), T.StructField("end_byte", T.LongType()),
        T.StructField("score", T.DoubleType())])
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_column].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("offending", T.ArrayType(place))])
    arrow = to_arrow_schema(schema)
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return rows.mapInArrow(lambda batches: _score(batches, held.value, arrow), schema).withColumnRenamed("_id", id_column)


def without_toxic(docs: DataFrame, model: Model, threshold: float, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, in all their columns, that score below ``threshold``. No row is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _bits(held.value.features)
        for batch in batches:
            yield batch.filter(pa.array(_scored(batch.column(at), held.value, bits)[0] < threshold))

    return docs.mapInArrow(keep, docs.schema)
