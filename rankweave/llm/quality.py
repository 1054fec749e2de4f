"""Quality classifier: a regularised quadratic discriminant over transformed statistics of a document.

Each class has a normal density with its own mean and a covariance shrunk towards the pooled variances. The score is
the posterior of the good class: the difference of the two Mahalanobis log densities plus the log ratio of the priors,
through the logistic function. The Cholesky factor of each covariance is computed once and kept in the model.

Training uses all labelled rows through sums of outer products, added up in Spark; one short row per class comes to the
driver. The model is a few hundred numbers.

Rows: a null text counts as empty and is scored like any other. Labels that are null are left out; a label row without
its document, or a document without label, does not train. With no labelled rows, or one class only, the score is the
share of good labels seen (0.5 with none). An empty input gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import arrow_function, column, remainder, utf8
from rankweave.llm.text_stats import TextStats

SHRINKAGE = 0.1
LEAST_VARIANCE = 1e-4
THRESHOLD = 0.3
HELD_OUT_PARTS = 5


def transformed(data: bytes) -> list[float]:
    """Statistics of a text on scales where ordinary texts are about normal."""
    t = TextStats(data)
    words, chars, lines, letters = max(t.n_words, 1), max(t.word_chars, 1), max(len(t.lines), 1), max(t.n_upper + t.n_lower, 1)
    other = max(chars - t.n_upper - t.n_lower - t.n_digits - t.n_beyond_ascii, 0)
    return [
        math.log1p(t.n_words),
        math.log(chars / words + 0.1),
        math.log(t.n_symbols / chars + 0.001),
        math.log(t.n_upper / letters + 0.01),
        math.log(t.n_digits / chars + 0.001),
        math.log(other / chars + 0.01),
        math.sqrt(t.n_dup_lines / lines),
        math.sqrt(t.n_repeat_words / words),
        math.log(words / lines),
        t.word_entropy,
        t.n_beyond_ascii / chars,
        math.log(t.n_distinct / words + 0.001),
    ]


def features(text: Column) -> Column:
    """array<double> of the transformed statistics."""

    def make():
        return lambda texts: pa.array([transformed(x) for x in utf8(texts)], pa.list_(pa.float64()))

    return arrow_function(make, "array<double>")(text)


@dataclass(frozen=True)
class Discriminant:
    """means: class -> mean; factors: class -> inverse of the Cholesky factor; constants: log prior and determinant."""

    prior: float
    means: dict[int, np.ndarray]
    factors: dict[int, np.ndarray]
    constants: dict[int, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(self.means) < 2:
            return np.full(len(x), self.prior)
        density = {c: self.constants[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in self.means}
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0], -700, 700)))


def class_sums(rows: DataFrame) -> DataFrame:
    """(quality, n, total, products) over rows (quality, features): partial sums per batch, then one row per class."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("quality").to_numpy(zero_copy_only=False)
            x = np.array(batch.column("features").to_pylist(), float)
            for c in np.unique(label):
                own = x[label == c]
                yield pa.RecordBatch.from_pydict({
                    "quality": pa.array([int(c)], pa.int32()), "n": pa.array([len(own)], pa.int64()),
                    "sums": pa.array([np.concatenate([own.sum(axis=0), (own.T @ own).ravel()]).tolist()], pa.list_(pa.float64())),
                })

    parts = rows.select("quality", "features").mapInArrow(sums, "quality int, n long, sums array<double>")
    places = parts.select("quality", "n", F.posexplode("sums").alias("place", "value"))
    total = places.groupBy("quality", "place").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    return total.groupBy("quality").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "value"))).getField("value").alias("sums"))


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """A discriminant from rows (quality 0 or 1, features)."""
    known = {r.quality: (r.n, np.array(r.sums)) for r in class_sums(rows.filter(F.col("quality").isin(0, 1))).collect()}
    all_rows = sum(n for n, _ in known.values())
    prior = known[1][0] / all_rows if 1 in known else (0.0 if known else 0.5)
    if len(known) < 2:
        return Discriminant(prior, {}, {}, {})
    d = int((math.isqrt(1 + 4 * len(known[0][1])) - 1) // 2)

    def moments(n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = sums[:d] / n
        return mean, sums[d:].reshape(d, d) / n - np.outer(mean, mean)

    pooled = np.maximum(np.diag(moments(all_rows, known[0][1] + known[1][1])[1]), LEAST_VARIANCE)
    means, factors, constants = {}, {}, {}
    for c, (n, sums) in known.items():
        means[c], spread = moments(n, sums)
        weight = max(shrinkage, d / (n + d))
        root = np.linalg.cholesky((1 - weight) * spread + weight * np.diag(pooled) + 1e-9 * np.eye(d))
        factors[c] = np.linalg.inv(root)
        constants[c] = math.log(n / all_rows) - float(np.log(np.diag(root)).sum())
    return Discriminant(prior, means, factors, constants)


def score(of: Column, model: Discriminant) -> Column:
    """The score of an array<double> of features."""

    def make():
        def apply(rows: pa.Array) -> pa.Array:
            if not len(rows):
                return pa.array([], pa.float64())
            return pa.array(model.scores(np.array(rows.to_pylist(), float)), pa.float64())

        return apply

    return arrow_function(make, "double")(of)


def training_rows(described: DataFrame, labels: DataFrame) -> DataFrame:
    """(quality, features) of the labelled rows that may train: crc32 of the doc_id as text modulo 5 is not 0.

    `described` is (doc_id, features), so the join moves a dozen numbers per document and no text.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    usable = known.filter(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), HELD_OUT_PARTS) != 0))
    return described.select("doc_id", "features").join(usable, "doc_id").select("quality", "features")


def fit_documents(docs: DataFrame, labels: DataFrame, text: str = "text") -> Discriminant:
    """A discriminant from documents and their labels (doc_id, quality)."""
    return fit(training_rows(docs.select("doc_id", features(column(text)).alias("features")), labels))


def keep(docs: DataFrame, model: Discriminant, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they were."""
    return docs.filter(score(features(column(text)), model) >= threshold)
