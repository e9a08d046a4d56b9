"""Toxicity scores from non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of the same population, labels ignored, is
the unlabelled set. The risk of a linear classifier over hashed words is corrected with the
class prior and its negative part is kept from falling below zero (Kiryo et al., 2017), so the
positives hidden among the unlabelled texts do not count as negatives.

Spark turns the sampled texts into feature lists and scores every text; numpy fits the
weights on the driver from a bounded sample.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, drawn, fold

FEATURES = 1 << 18
# Bounds of the training sample: rows of either kind, and features over all rows.
SAMPLE_ROWS = 8_000
SAMPLE_FEATURES = 8_000_000
THRESHOLD = 0.3
HELD_OUT = (4, 2)  # rows with this remainder of crc32(doc_id) are not learned from

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


class WordFeatures:
    """Distinct hashed words of a text, A-Z lower-cased, split at anything but letters."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = set((text or "").encode("utf-8", "replace").translate(_LETTERS).split())
        if len(self.seen) > 500_000:
            self.seen.clear()
        seen, out = self.seen, []
        for word in words:
            index = seen.get(word)
            if index is None:
                index = seen[word] = zlib.crc32(word) % FEATURES
            out.append(index)
        return np.unique(np.array(out, np.int32))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: Iterable[np.ndarray]) -> np.ndarray:
        return _sigmoid(np.array([self.weights[r].sum() for r in rows]) + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _sums(weights: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0.0], np.cumsum(weights[flat])))[starts])


def fit(
    rows: list[np.ndarray],
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    steps: int = 250,
    rate: float = 1.0,
    sparsity: float = 0.1,
    least_share: float = 0.001,
) -> Model:
    """Proximal gradient descent with momentum on the non-negative risk, logistic loss.

    ``positive`` and ``unlabelled`` mark rows; one row may be both. Words in fewer than
    ``least_share`` of the rows (two at least) carry nothing over to other texts and get no
    weight. ``sparsity`` over the root of the number of rows is the l1 penalty, which follows
    the noise of the mean gradient and removes most of the other words. Without positives or
    unlabelled rows the score of every text is the prior.
    """
    weights, bias = np.zeros(FEATURES, np.float32), float(np.log(prior / (1 - prior)))
    if not positive.any() or not unlabelled.any():
        return Model(weights, bias, prior)
    counts = np.bincount(np.concatenate(rows), minlength=FEATURES)
    used = np.flatnonzero(counts >= max(2, least_share * len(rows)))
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    rows = [r[r >= 0] for r in (place[r] for r in rows)]
    lengths = np.array([len(r) for r in rows])
    flat, starts = np.concatenate(rows), np.concatenate(([0], np.cumsum(lengths)))
    p, u = positive / positive.sum(), unlabelled / unlabelled.sum()
    shrink = rate * sparsity / np.sqrt(len(rows))
    w, pace = np.zeros(len(used)), np.zeros(len(used) + 1)
    for _ in range(steps):
        z = _sums(w, flat, starts) + bias
        probability, loss_negative = _sigmoid(z), np.logaddexp(0, z)
        towards_negative = (u - prior * p) * probability
        if ((u - prior * p) * loss_negative).sum() >= 0:
            slope = prior * p * (probability - 1) + towards_negative
        else:  # step back from the overfitted negative part
            slope = -towards_negative
        gradient = np.bincount(flat, np.repeat(slope, lengths), len(used))
        pace = 0.9 * pace + np.append(gradient, slope.sum())
        w -= rate * pace[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
        bias -= rate * pace[-1]
    weights[used] = w
    return Model(weights, float(bias), prior)


def _feature_lists():
    @F.pandas_udf("array<int>")
    def lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = WordFeatures()
        for texts in batches:
            yield pd.Series([features(t) for t in texts])

    return lists


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled training rows; the fold ``HELD_OUT`` is never read.

    A document labelled more than once is toxic if any label says so. The prior is the share
    of toxic labels. The sample is drawn by hashes of the ids.
    """
    bounded_batches(docs.sparkSession)
    modulus, held_out = HELD_OUT
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(fold(F.col("doc_id"), modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = known.agg(F.count("*"), F.sum(F.expr("int(toxic = 1)"))).first()
    prior = min(max((counts[1] or 0) / max(counts[0], 1), 1e-4), 0.9)
    order = F.xxhash64("doc_id")

    def smallest(rows: DataFrame, n: int) -> DataFrame:
        share = F.lit(2.0 * sample_rows / max(n, 1))
        return rows.where(drawn(order, share)).orderBy(order, "doc_id").limit(sample_rows)

    any_label = smallest(known, counts[0]).withColumn("unlabelled", F.lit(True))
    confirmed = smallest(known.where("toxic = 1"), counts[1] or 0)
    chosen = (
        any_label.unionByName(confirmed.withColumn("unlabelled", F.lit(False)))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.max("unlabelled").alias("unlabelled"))
    )
    # at most 2 * sample_rows ids, so the large side is not shuffled for the sample
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", _feature_lists()("text").alias("features"), "toxic", "unlabelled"
    )
    rows, positive, unlabelled, total = [], [], [], 0
    for row in sample.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        total += len(row.features)
        if total > SAMPLE_FEATURES:
            break
        rows.append(np.array(row.features, np.int32))
        positive.append(row.toxic == 1)
        unlabelled.append(row.unlabelled)
    return fit(rows, np.array(positive, bool), np.array(unlabelled, bool), prior)


def scorer(model: Model):
    """A column function: score of a text between 0 and 1."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = WordFeatures()
        for texts in batches:
            yield pd.Series(model.scores(features(t) for t in texts))

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    A null or empty text has the score of a text without words. A null id counts as not held
    out. Repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    modulus, held_out = HELD_OUT
    score = scorer(model)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"),
        score(F.col("text").cast("string")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    return docs.where(scorer(model)(F.col("text").cast("string")) < THRESHOLD)
