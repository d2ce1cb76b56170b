"""Quality: ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold[k] - score): all grades share the weights of the score and the thresholds rise. A
text's features are its words and its pairs of neighbouring words, whether a pair is one word twice, and character 1- to
3-grams after letters and digits have become classes; all hashed, each as the square root of its share. The expected
grade ranks documents; the probability of the upper grades selects them.

The model is fitted on at most ``rows`` labelled rows (ROWS); scoring covers every whole text, of any length, in one
pass. Defined results: null texts are empty, and empty texts get the score of a text without features; with one grade
only, that grade is certain; without any labels the expected grade is 0 and every document is kept; an empty table gives
no rows; a probability equal to ``keep`` stays; repeated rows are scored each time; other columns are left alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm import samples
from lawloom.llm.grams import codes, hashed, sigmoid

#: Labelled rows that the model is fitted on, at most.
ROWS = 5_000
BITS = 12
SIZES = (1, 2, 3)
WORD_BITS = 16
#: Where words, pairs and repeated words begin.
_WORDS = 1 << BITS
_PAIRS = _WORDS + (1 << WORD_BITS)
_TWICE = _PAIRS + (1 << WORD_BITS)
COLUMNS = _TWICE + 1
#: Probability of the upper grades from which a document stays.
KEEP = 0.4


def _classes() -> np.ndarray:
    out = np.arange(0x3000, dtype=np.uint64)
    for c in range(0x3000):
        ch = chr(c)
        out[c] = 65 if ch.isupper() else 97 if ch.isalpha() else 48 if ch.isdigit() else 32 if ch.isspace() else c
    return out


_CLASS = _classes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Columns, each once, and their values."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0)
    c = codes(text)
    h = hashed(np.where(c < len(_CLASS), _CLASS[np.minimum(c, len(_CLASS) - 1)], 97), SIZES, BITS)
    n = np.bincount(h, minlength=1 << BITS)
    at = np.flatnonzero(n)
    words = text.encode("utf-8", "replace").split()
    mask, own, pairs = (1 << WORD_BITS) - 1, Counter(words), Counter(zip(words, words[1:]))
    crc, twice = zlib.crc32, sum(k for (a, b), k in pairs.items() if a == b)
    columns = [*(_WORDS + (crc(w) & mask) for w in own), *(_PAIRS + (crc(b, crc(a) + 1) & mask) for a, b in pairs), *[_TWICE] * (twice > 0)]
    # of words in one bucket the counts are added
    more, place = np.unique(np.array(columns, np.int64), return_inverse=True)
    share = np.bincount(place, weights=[*own.values(), *pairs.values(), *[twice] * (twice > 0)], minlength=len(more)) / max(1, len(words))
    return np.r_[at, more], np.sqrt(np.r_[n[at] / len(h), share])


@dataclass
class Model:
    weight: np.ndarray
    thresholds: np.ndarray  # one fewer than grades
    grades: np.ndarray
    cut: int

    def predict(self, text: str | None) -> tuple[float, float]:
        """Expected grade, and the probability of a grade of at least ``cut``."""
        if not len(self.grades):
            return 0.0, 1.0
        at, value = features(text)
        up = sigmoid(self.weight[at] @ value - self.thresholds)  # P(grade > k)
        at_least = np.r_[1.0, up]
        p = at_least - np.r_[up, 0.0]
        k = int(np.searchsorted(self.grades, self.cut))
        return float(p @ self.grades), float(at_least[k]) if k < len(self.grades) else 0.0


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", cut: int = 1, where=None, rows: int = ROWS, l2: float = 1e-4) -> Model:
    def run(batches):
        for b in batches:
            at, value = [], []
            for t in b["text"].to_pylist():
                i, x = features(t)
                at.append(i.astype("<i4").tobytes())
                value.append(x.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["y"], pa.array(at, pa.binary()), pa.array(value, pa.binary())], ["doc_id", "y", "at", "value"])

    sample = samples.labelled(docs, labels, label, rows=rows, where=where).select("doc_id", "y", "text")
    got = sorted((r["doc_id"], r["y"], bytes(r["at"]), bytes(r["value"])) for r in sample.mapInArrow(run, "doc_id long, y int, at binary, value binary").toLocalIterator())
    grades = np.array(sorted({r[1] for r in got}), float)
    steps = len(grades) - 1
    if steps < 1:
        return Model(np.zeros(COLUMNS), np.zeros(0), grades, cut)
    x = samples.Rows([np.frombuffer(r[2], "<i4") for r in got], [np.frombuffer(r[3], "<f4") for r in got])
    k = np.searchsorted(grades, [r[1] for r in got])
    share = np.clip(np.cumsum(np.bincount(k, minlength=steps + 1))[:-1] / len(k), 1e-6, 1 - 1e-6)
    first = np.log(share / (1 - share))
    start = np.r_[np.zeros(COLUMNS), first[0], np.log(np.maximum(np.diff(first), 1e-3))]

    def thresholds(p):
        return np.cumsum(np.r_[p[COLUMNS], np.exp(p[COLUMNS + 1 :])])

    def gradient(p):
        t, s = thresholds(p), x.dot(p)
        hi = np.where(k < steps, sigmoid(t[np.minimum(k, steps - 1)] - s), 1.0)
        lo = np.where(k > 0, sigmoid(t[np.maximum(k - 1, 0)] - s), 0.0)
        chance = np.maximum(hi - lo, 1e-12) * len(k)
        up, down = hi * (1 - hi) / chance, lo * (1 - lo) / chance
        by_t = np.bincount(np.minimum(k, steps - 1), weights=-up * (k < steps), minlength=steps) + np.bincount(np.maximum(k - 1, 0), weights=down * (k > 0), minlength=steps)
        later = np.cumsum(by_t[::-1])[::-1]
        g = x.back(up - down, len(p)) + l2 * p
        g[COLUMNS:] = np.r_[later[0], later[1:] * np.exp(p[COLUMNS + 1 :])]
        return g

    p = samples.adam(start, gradient, steps=300)
    return Model(p[:COLUMNS], thresholds(p), grades, cut)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade, tail_probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            got = np.array([m.predict(t) for t in b["text"].to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(got[:, 0]), pa.array(got[:, 1])], ["doc_id", "expected_grade", "tail_probability"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")


def select(docs: DataFrame, model: Model, *, keep: float = KEEP) -> DataFrame:
    """The documents, all columns as they were, whose probability of the upper grades is at least ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.predict(t)[1] >= keep for t in b["text"].cast(pa.string()).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
