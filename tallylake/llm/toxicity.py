"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

Only whole documents are labelled. Each sentence has the chance
``p = sigmoid(bias + sum of its word weights)`` of being toxic, and a document is
toxic unless all its sentences are clean: ``1 - prod(1 - p)``. The weights are
fitted to the document labels; afterwards the sentence scores show where a text offends.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.tables import map_batches, written

MAX_TRAINING_ROWS = 20_000  # bound of the labelled sample, the rows of smallest hash
MAX_FEATURES = 2_000  # bound of the vocabulary, the words that tell most
MIN_DOCUMENTS = 5  # a feature occurs in at least so many sampled documents
CUT = 0.7  # predicted toxic from this score on

WORDS_REMEMBERED = 1 << 18

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"[^\W\d_]+")


STEMS = (4, 5, 6, 7)  # lengths of word beginnings that are features, for inflected words


def features(word: str) -> list[str]:
    """The word and its beginnings, each marked by a star."""
    return [word] + [f"{word[:n]}*" for n in STEMS if len(word) >= n]


class Model:
    """Feature weights and bias; at most ``MAX_FEATURES`` entries, so it travels with the tasks."""

    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias = bias
        self.weights = weights
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) >= WORDS_REMEMBERED:
                self.known.clear()
            value = math.fsum(self.weights.get(f, 0.0) for f in features(word))
            self.known[word] = value
        return value

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, logit) of every sentence with a word, in code points."""
        for found in SENTENCE.finditer(text):
            words = set(WORD.findall(found.group().lower()))
            if words:
                yield found.start(), found.end(), self.bias + math.fsum(map(self.weight, words))

    def score(self, text: str) -> tuple[float, int, list[tuple[int, int]]]:
        """(score, sentences more likely toxic than not, their spans); no sentence scores 0."""
        doubts, spans = [], []
        for start, end, logit in self.sentences(text):
            doubts.append(max(logit, 0.0) + math.log1p(math.exp(-abs(logit))))
            if logit >= 0:
                spans.append((start, end))
        return -math.expm1(-math.fsum(doubts)), len(spans), spans


def learnable(doc_id: Column, modulus: int = 3, held_out: int = 1) -> Column:
    """Rows whose label may be learned from; a NULL id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus != held_out


def training_rows(labels: DataFrame, doc_id: str, label: str, bound: int) -> DataFrame:
    """At most ``bound`` (doc_id, y) with known labels; an id with several labels is toxic if any says so."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    known = known.filter(learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def _vocabulary(sample: DataFrame, size: int) -> dict[str, int]:
    """The words whose presence differs most between the classes, by a z-score of their log odds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = set(WORD.findall((text or "").lower()))
                seen[y].update({f for word in words for f in features(word)})
        for y in (0, 1):
            words = list(seen[y])
            counts = pa.array([seen[y][w] for w in words], pa.int64())
            zero = pa.array(np.zeros(len(words), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), counts if y else zero, zero if y else counts],
                names=["word", "toxic", "clean"],
            )

    total = sample.groupBy("y").count().collect()
    n = {row["y"]: row["count"] for row in total}
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (n.get(1, 0) + 1 - toxic)) - F.log(clean / (n.get(0, 0) + 1 - clean))
    z = F.abs(odds) / F.sqrt(1 / toxic + 1 / clean)
    words = map_batches(sample, count, "word string, toxic long, clean long")
    words = words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = words.filter(F.col("toxic") + F.col("clean") >= MIN_DOCUMENTS).withColumn("z", z)
    top = words.orderBy(F.desc("z"), "word").limit(size).collect()
    return {row["word"]: k for k, row in enumerate(top)}


def _bags(sample: DataFrame, vocabulary: dict[str, int]) -> list:
    """Per sampled document its label, its sentences without features, and the others' features."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            plain, ends, ids = [], [], []
            for text in batch.column(1).to_pylist():
                rest, stops, found = 0, [], []
                for sentence in SENTENCE.findall(text or ""):
                    words = set(WORD.findall(sentence.lower()))
                    names = (f for word in words for f in features(word))
                    known = sorted(k for k in map(get, names) if k is not None)
                    if known:
                        found += known
                        stops.append(len(found))
                    elif words:
                        rest += 1
                plain.append(rest)
                ends.append(stops)
                ids.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(plain, pa.int64()),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(ids, pa.list_(pa.int32())),
                ],
                names=["doc_id", "y", "plain", "ends", "ids"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, y int, plain long, ends array<int>, ids array<int>"
    rows = map_batches(sample, bags, schema).collect()
    return sorted(rows, key=lambda r: (str(r["doc_id"]), r["plain"], r["ids"]))


def _ascend(rows: list, size: int, steps: int = 400, decay: float = 1e-3) -> tuple[float, np.ndarray]:
    """Maximum of the noisy-or likelihood by Adam over the whole sample, always from zero."""
    y = np.array([r["y"] for r in rows], float)
    plain = np.array([r["plain"] for r in rows], float)
    count = np.array([len(r["ends"]) for r in rows])
    doc = np.repeat(np.arange(len(rows)), count)
    lengths = np.concatenate([np.diff([0, *r["ends"]]) for r in rows if r["ends"]] or [[]]).astype(int)
    feature = np.concatenate([r["ids"] for r in rows if r["ids"]] or [[]]).astype(int)
    sentence = np.repeat(np.arange(len(lengths)), lengths)
    theta = np.zeros(size + 1)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        bias, w = theta[-1], theta[:-1]
        z = bias + np.bincount(sentence, w[feature], len(lengths))
        doubt = plain * np.logaddexp(0, bias) + np.bincount(doc, np.logaddexp(0, z), len(rows))
        doubt = np.maximum(doubt, 1e-9)
        pull = np.where(y > 0, 1 / np.expm1(np.minimum(doubt, 500)), -1.0) / max(1, len(rows))
        at = pull[doc] / (1 + np.exp(-z))
        grad = np.bincount(feature, at[sentence], size) - decay * w / max(1, len(rows)) * 10
        grad = np.append(grad, at.sum() + (pull * plain).sum() / (1 + np.exp(-bias)))
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return float(theta[-1]), theta[:-1]


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_TRAINING_ROWS,
    max_features: int = MAX_FEATURES,
) -> Model:
    """Fit to the documents of at most ``max_rows`` learnable labels; without any, every text scores 0.

    Rows that share a doc_id are one document, with the smallest of their texts, so no more than
    ``max_rows`` texts are learned from, however often an id occurs.
    """
    wanted = F.broadcast(training_rows(labels, doc_id, label, max_rows))  # 16 bytes a row
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # an id that many rows hold is one document here, with the smallest of its texts
    sample = texts.join(wanted, "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("y").alias("y")
    )
    sample = written(sample, "toxicity-sample")
    vocabulary = _vocabulary(sample, max_features)
    rows = _bags(sample, vocabulary)
    if not rows:
        return Model(-math.inf, {})  # no evidence, so no doubt however long the text
    bias, weights = _ascend(rows, len(vocabulary))
    return Model(bias, {word: float(weights[k]) for word, k in vocabulary.items()})


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, n_offending, offending) of every whole text.

    ``offending`` lists the sentences more likely toxic than not as start:end in code points.
    NULL and empty texts have no sentence and score 0. Rows are independent, so repeated rows
    agree; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(t or "") for t in batch.column(2).to_pylist()]
            scores = [f[0] for f in found]
            spans = [",".join(f"{a}:{b}" for a, b in f[2]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= CUT) for s in scores], pa.int32()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array(spans, pa.string()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "n_offending", "offending"],
            )

    chosen = docs.select(
        F.col(doc_id).alias("doc_id"),
        (~learnable(F.col(doc_id))).alias("held_out"),
        F.col(text).alias("text"),
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return map_batches(
        chosen,
        run,
        f"doc_id {kind}, held_out boolean, score double, predicted int, "
        "n_offending long, offending string",
    )


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, all columns unchanged."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [model.score(t or "")[0] < CUT for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_batches(docs, run, docs.schema)
