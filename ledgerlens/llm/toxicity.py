"""Toxicity by two class-conditional Kneser-Ney models.

A word is read byte by byte, each byte after the bytes of its word so far. Its probability in a class
is the discounted count of the longer beginning in that class, plus what the discount freed times a
backoff probability. The backoff leaves the class out of the context and so is *shared*: as in
Kneser-Ney smoothing it counts in how many different places, here documents, a beginning was seen, over
both classes. The discounts are in proportion to the size of the classes. Where a class keeps nothing of a
continuation, rare or never seen, its probability is what the context freed times the shared backoff; the backoff is
the same in either class, so the evidence is the ratio of the freed shares, and the bytes after it say nothing. A
count up to the discount is all freed, so such counts need not be stored: the evidence of every word is the
same with and without them. The frequent expressions, and new words on a stem that only one class uses, are told apart.

The evidence of a text is the difference of its two log-likelihoods, normalised by its length, and the
evidence of those words that by themselves speak for toxicity. A logistic curve, fitted on labelled
rows that gave no counts, turns the two into a probability.

Counts come from a sample of at most ``sample_rows`` labelled ids per class in expectation (a hash
threshold on the id, so the same rows whatever the layout), small enough to broadcast, so that no text
is shuffled; all rows are scored in whole.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import filter_rows, id_and_text, lower_words_of, map_text, share_of

DISCOUNT = 5.0
DEPTH = 24
STRONG = 1.8
SAMPLE_ROWS = 10_000
KEPT_WORDS = 300_000
END = b" "


def beginnings(word: bytes):
    """The beginnings of a word, its end included, up to ``DEPTH`` bytes."""
    marked = word + END
    for stop in range(1, min(len(marked), DEPTH) + 1):
        yield marked[:stop]


@dataclass
class Model:
    """How many documents of each class have each beginning, counted once for each of its words."""

    counts: dict[bytes, tuple[int, int]] = field(default_factory=dict)
    freed: dict[bytes, tuple[float, float]] = field(default_factory=dict)
    discounts: tuple[float, float] = (DISCOUNT, DISCOUNT)
    curve: tuple[float, ...] = (0.0, 1.0, 0.0)

    def prepare(self) -> Model:
        totals = [0, 0]
        for beginning, (ordinary, toxic) in self.counts.items():
            if len(beginning) == 1:
                totals[0] += ordinary
                totals[1] += toxic
        self.counts[b""] = (totals[0], totals[1])
        least = max(min(totals), 1)
        self.discounts = tuple(DISCOUNT * max(n, 1) / least for n in totals)
        # What a class keeps of a beginning's continuations; the rest, rare ones included, is freed for the backoff.
        kept: dict[bytes, list[float]] = {}
        for beginning, own in self.counts.items():
            if beginning:
                taken = kept.setdefault(beginning[:-1], [0.0, 0.0])
                for k in (0, 1):
                    taken[k] += max(own[k] - self.discounts[k], 0.0)
        self.freed = {b: (self.counts[b][0] - taken[0], self.counts[b][1] - taken[1]) for b, taken in kept.items() if b in self.counts}
        self._words = _Evidence(self)
        return self

    def word(self, word: bytes) -> float:
        """Log-likelihood of a word as toxic, less that as ordinary."""
        counts, discounts = self.counts, self.discounts
        likelihood = [1.0, 1.0]
        before, context = counts[b""], b""
        for beginning in beginnings(word):
            own = counts.get(beginning)
            freed = self.freed.get(context)
            if own is None:
                for k in (0, 1):
                    if freed and before[k]:
                        likelihood[k] *= freed[k] / before[k]
                break
            shared = (own[0] + own[1]) / (before[0] + before[1])
            for k in (0, 1):
                if before[k]:
                    likelihood[k] *= (max(own[k] - discounts[k], 0.0) + freed[k] * shared) / before[k] / shared
            before, context = own, beginning
        return log(likelihood[1] / likelihood[0])

    def features(self, text: str | None) -> tuple[float, float]:
        """Evidence per word, and that of the words that by themselves speak for toxicity, on a log scale."""
        words = lower_words_of(text)
        if not words:
            return 0.0, 0.0
        values = np.fromiter(map(self._words.__getitem__, words), float, len(words))
        return float(values.mean()), float(np.log1p(values[values > STRONG].sum()))

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        w0, w1, w2 = self.curve
        return float(1 / (1 + np.exp(-np.clip(w0 + w1 * a + w2 * b, -500, 500))))


class _Evidence(dict):
    """Evidence of each word met, forgotten when there are very many."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        v = self.model.word(word)
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = v
        return v

    def __reduce__(self):
        # A shipped model starts without words.
        return _Evidence, (self.model,)


def fit_curve(rows: list[tuple[float, float, int, float]]) -> tuple[float, ...]:
    """Weighted logistic regression with a small ridge by Newton steps; without both classes a flat curve at their share.

    ``rows`` are the two parts of the evidence, the label and the weight.
    """
    data = np.array(rows, float).reshape(-1, 4)
    labels, weights = data[:, 2], data[:, 3]
    if not len(data) or labels.min() == labels.max():
        share = ((labels * weights).sum() + 0.5) / (weights.sum() + 1)
        return (float(np.log(share / (1 - share))), 0.0, 0.0)
    x = np.column_stack([np.ones(len(data)), data[:, :2]])
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + 1e-2 * w
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def sample(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(id, toxic, weight)`` of at most ``sample_rows`` ids per class in expectation, of ``(id, toxic)`` rows.

    An id with both labels is toxic. Labels other than 0 and 1 and null ids are left out. ``weight`` is
    the number of rows that a sampled one stands for.
    """
    known = labels.filter("toxic IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    held = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {k: min(1.0, sample_rows / max(held.get(k, 0), 1)) for k in (0, 1)}
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    own = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    return known.filter(place < own).withColumn("weight", 1 / own)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``(id, text)`` rows and ``(id, toxic)`` rows, as sampled by ``sample``. Without any it gives one half to every text."""
    # At most two classes of ``sample_rows`` ids: bounded by a parameter, whatever the tables.
    sampled = docs.join(F.broadcast(sample(labels, sample_rows)), "id")
    for_curve = share_of(F.col("id"), 35) % 7 == 6

    def count(stream):
        tally: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
        for batch in stream:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                tally[label].update(set(lower_words_of(text)))
        found: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
        for words, own in zip(tally, found, strict=True):
            for word, n in words.items():
                for beginning in beginnings(word):
                    own[beginning] += n
        keys = list(found[0].keys() | found[1].keys())
        counted = [pa.array([own[k] for k in keys], pa.int64()) for own in found]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *counted], ["beginning", "ordinary", "toxic"])

    schema = "beginning binary, ordinary bigint, toxic bigint"
    counted = sampled.filter(~for_curve).select("text", "toxic").mapInArrow(count, schema)
    counted = counted.groupBy("beginning").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    model = Model()
    # Neither class keeps anything of a count up to the discount; ``word`` gives such a beginning what its context freed.
    # Single bytes stay, as their counts add up to the size of a class.
    for row in counted.filter(f"ordinary + toxic > {DISCOUNT} OR octet_length(beginning) = 1").toLocalIterator():
        model.counts[bytes(row.beginning)] = (row.ordinary, row.toxic)
    model.prepare()
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def measure(texts):
        own = shipped.value
        made = [own.features(t) for t in texts]
        return [[a for a, _ in made], [b for _, b in made]]

    fields = [("evidence", T.DoubleType(), pa.float64()), ("strong", T.DoubleType(), pa.float64())]
    labelled = sampled.filter(for_curve).select(F.struct("toxic", "weight").alias("id"), "text")
    model.curve = fit_curve([(r.evidence, r.strong, r.id.toxic, r.id.weight) for r in map_text(labelled, fields, measure).collect()])
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` of every row; a null, empty or blank text gets the score of no evidence."""
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def rows(texts):
        own = shipped.value
        return [[own.score(t) for t in texts]]

    return map_text(id_and_text(df, id_col, text_col), [("score", T.DoubleType(), pa.float64())], rows).withColumnRenamed("id", id_col)


def reject(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df``, all columns, whose text scores below the threshold."""
    shipped = df.sparkSession.sparkContext.broadcast(model)
    return filter_rows(df, text_col, lambda texts: [shipped.value.score(t) < threshold for t in texts])


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never looked at."""
    return F.coalesce(share_of(id_column, 5) == 0, F.lit(True))


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """The model that the labels of all documents outside the held-out part give."""
    known = labels.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "toxic")
    return train(id_and_text(docs, "doc_id", "text"), known)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, learned(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
