"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased, white space becomes single spaces, and the distinct n-grams of 3 to 7 characters are hashed into
2**20 buckets. The ratio of a bucket is the log of how much more often toxic training texts hold it than others do.
The buckets that tell most about the label are kept, and logistic regression on presence times ratio gives the weights.
Scoring reads each whole text once and looks only at kept buckets.

The model is fitted on at most ``rows`` labelled rows (samples.ROWS); everything else covers all rows. Defined results:
null and empty texts get the score of a text without any n-gram; a text of any length is read whole; an empty table gives
no rows; without labels of both kinds every score is the share of label 1 (0 if there are no labels); a row without an id
is not held out; a score equal to the threshold is toxic; repeated rows are scored each time; other columns are left
alone.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm import samples
from lawloom.llm.grams import codes, hashed, present, sigmoid

SIZES = (3, 4, 5, 6, 7)
BITS = 20
KEPT = 4096
THRESHOLD = 0.7


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        h = hashed(_codes(text), SIZES, BITS)
        w = self.weight[h]
        hit = np.flatnonzero(w)
        return float(sigmoid(self.weight[np.unique(h[hit])].sum(dtype=np.float64) + self.bias)) if len(hit) else float(sigmoid(self.bias))


def _codes(text: str | None) -> np.ndarray:
    return codes(f" {' '.join(text.lower().split())} ") if text and not text.isspace() else np.zeros(0, np.uint64)


def _entropy(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return -(p * np.log(p) + (1 - p) * np.log(1 - p))


def _counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold each bucket, and texts, by label."""

    def run(batches):
        n, all_ = np.zeros((2, 1 << BITS), np.uint32), [0, 0]
        for b in batches:
            for y, t in zip(b["y"].to_pylist(), b["text"].to_pylist()):
                n[int(y > 0)][present(_codes(t), SIZES, BITS)] += 1
                all_[int(y > 0)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(n.tobytes(), 1)], pa.binary()), pa.array([all_], pa.list_(pa.int64()))], ["n", "texts"])

    n, texts = np.zeros((2, 1 << BITS)), np.zeros(2)
    for r in sample.mapInArrow(run, "n binary, texts array<long>").toLocalIterator():
        n += np.frombuffer(zlib.decompress(bytes(r["n"])), np.uint32).reshape(2, -1)
        texts += r["texts"]
    return n, texts


def _kept(n: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Log-count ratios of the buckets that tell most, 0 elsewhere."""
    share = n / texts[:, None]
    gain = _entropy(n.sum(axis=0) / texts.sum()) - (texts[:, None] * _entropy(share)).sum(axis=0) / texts.sum()
    ratio = np.log((n[1] + 1) / (texts[1] + 2)) - np.log((n[0] + 1) / (texts[0] + 2))
    ratio[np.argsort(-gain, kind="stable")[KEPT:]] = 0
    return ratio.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", where=None, rows: int = samples.ROWS, l2: float = 1e-3, weight: float = 10.0) -> Model:
    """weight: how much a toxic row counts against another."""
    sample = samples.labelled(docs, labels, label, rows=rows, where=where)
    n, texts = _counts(sample)
    if not texts.all():
        return Model(np.zeros(1 << BITS, np.float32), 40.0 if texts[1] else -40.0)
    shared = docs.sparkSession.sparkContext.broadcast(_kept(n, texts))

    def run(batches):
        ratio = shared.value
        for b in batches:
            at = []
            for t in b["text"].to_pylist():
                h = hashed(_codes(t), SIZES, BITS)
                at.append(np.unique(h[ratio[h] != 0]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["y"], pa.array(at, pa.binary())], ["doc_id", "y", "at"])

    got = sorted((r["doc_id"], r["y"], bytes(r["at"])) for r in sample.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, at binary").toLocalIterator())
    ratio = shared.value
    at = [np.frombuffer(x, "<i4") for _, _, x in got]
    columns, x_at = np.unique(np.concatenate([np.zeros(0, np.int32), *at]), return_inverse=True)
    x = samples.Rows(at, [ratio[a] for a in at])
    x.at = x_at
    y = np.array([float(r[1] > 0) for r in got])
    each = np.where(y > 0, weight, 1.0)
    each /= each.sum()

    def gradient(p):
        e = (sigmoid(x.dot(p) + p[-1]) - y) * each
        g = x.back(e, len(p)) + l2 * p
        g[-1] = e.sum()
        return g

    p = samples.adam(np.zeros(len(columns) + 1), gradient, steps=300)
    w = np.zeros(1 << BITS, np.float32)
    w[columns] = p[:-1] * ratio[columns]
    return Model(w, float(p[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([m.score(t) for t in b["text"].to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def is_held_out(doc_id="doc_id") -> F.Column:
    """Rows whose labels no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
