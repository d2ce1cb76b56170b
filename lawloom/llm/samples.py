"""Bounded samples of labelled rows, and sparse rows in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut

#: Labelled rows a model is fitted on, at most.
ROWS = 20_000
#: Tasks that read the sample. Each sends the driver one bounded summary.
TASKS = 8


def labelled(docs: DataFrame, labels: DataFrame, label: str, *, rows: int = ROWS, where=None) -> DataFrame:
    """doc_id, text, y of at most ``rows`` labels, in the order of the ids' hashes. Rows that repeat a label count once.

    Null ids and labels take no part; of several texts with one id the least is taken; null texts are empty.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    if where is not None:
        known = known.where(where)
    some = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return cut(met.repartition(TASKS))


class Rows:
    """Sparse rows: of[i] is the row of entry i, at[i] its column, value[i] what stands there."""

    def __init__(self, at: list[np.ndarray], value: list[np.ndarray]):
        self.n = len(at)
        sizes = np.array([len(x) for x in at], np.int64)
        self.of = np.repeat(np.arange(self.n), sizes)
        self.first, self.some = np.cumsum(sizes) - sizes, sizes > 0
        self.at = np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64)
        self.value = np.concatenate([np.zeros(0), *value]).astype(np.float64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        # a zero behind the entries, so that a row without any begins at a place
        return np.add.reduceat(np.append(w[self.at] * self.value, 0.0), self.first) * self.some

    def back(self, e: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.at, weights=e[self.of] * self.value, minlength=columns)


def adam(start: np.ndarray, gradient, *, steps: int, rate: float = 0.05) -> np.ndarray:
    """A minimum of a smooth function by full gradients."""
    x, m, v = start.astype(np.float64).copy(), np.zeros(len(start)), np.zeros(len(start))
    for t in range(1, steps + 1):
        g = gradient(x)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x
