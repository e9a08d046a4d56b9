"""Language of a text: averaged hashed subword embeddings under a linear softmax.

Byte n-grams of the lower-cased text are hashed to buckets, each with a small vector; a text
is the mean of its vectors, and a linear layer gives the languages. Vectors and layer are
trained together by stochastic gradient descent on a bounded sample. Because a mean and a
linear layer commute, scoring needs one number per bucket and language.

Confidence is calibrated on a part of the sample that was not trained on: a temperature, and
the least confidence at which the accepted texts reach the wanted accuracy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, drawn, fold, saved, text_key

NGRAMS = (2, 3, 4)
BUCKET_BITS = 16
DIMENSIONS = 16
HELD_OUT = (3, 1)  # rows with this remainder of crc32(doc_id) are not learned from
# Bounds of the training sample.
SAMPLE_ROWS_PER_LANGUAGE = 300
SAMPLE_BYTES = 24 << 20
ACCEPTED_ACCURACY = 0.99
UNKNOWN = "und"
# Letters, and what this Java does not know yet; ``has_letter`` decides.
MAYBE_LETTER = r"[\p{L}\p{Cn}]"
_FACTORS = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


def buckets(text: str) -> np.ndarray:
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    out = []
    for n in NGRAMS:
        if len(raw) >= n:
            h = np.full(len(raw) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h = (h ^ raw[k : len(raw) - n + 1 + k]) * _FACTORS[k]
                h ^= h >> np.uint32(15)
            out.append(h >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(out)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages
    temperature: float
    least: float

    def logits(self, text: str) -> np.ndarray:
        total, count = np.zeros(len(self.languages)), 0
        for at in range(0, len(text), 1 << 18):  # a bounded part of a very long text at a time
            found = buckets(text[at : at + (1 << 18)])
            total += self.table[found].sum(axis=0, dtype=np.float64)
            count += len(found)
        return total / max(count, 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        p = _softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.least)


def _examples(texts: list[str], draw: np.random.Generator) -> list[list[tuple]]:
    """Per text its whole and three pieces of it, as distinct buckets with their shares."""
    out = []
    for text in texts:
        pieces = [text]
        for _ in range(3):
            size = int(draw.integers(20, 300))
            at = int(draw.integers(0, max(1, len(text) - size)))
            pieces.append(text[at : at + size])
        counted = [np.unique(buckets(p), return_counts=True) for p in pieces]
        out.append([(ids, (n / n.sum()).astype(np.float32)) for ids, n in counted])
    return out


def fit(texts: list[str], langs: list[str], epochs: int = 6, rate: float = 1.0, seed: int = 7) -> Model:
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), 1.0, 0.0)
    draw = np.random.default_rng(seed)
    target = np.searchsorted(languages, langs)
    examples = _examples(texts, draw)
    # every fifth text of each language, so that none is checked only
    checked = pd.Series(langs).groupby(langs).cumcount().to_numpy() % 5 == 4
    vectors = draw.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    # the few texts of a small language are repeated, or the others outweigh it
    learned = np.bincount(target[~checked], minlength=len(languages))
    times = learned.max() // learned
    train = [
        (x, target[i])
        for i in np.flatnonzero(~checked)
        for x in examples[i] * int(times[target[i]])
    ]
    steps = max(1, epochs * len(train))
    for epoch in range(epochs):
        for k, at in enumerate(draw.permutation(len(train)).tolist()):
            (ids, share), y = train[at]
            pace = rate * (1 - (epoch * len(train) + k) / steps)
            hidden = share @ vectors[ids]
            error = _softmax(hidden @ layer)
            error[y] -= 1
            back = layer @ error
            layer -= pace * np.outer(hidden, error)
            # the mean spreads the gradient thinly over many buckets
            vectors[ids] -= (pace * 20 * share)[:, None] * back
    table = vectors @ layer
    held = [(x, target[i]) for i in np.flatnonzero(checked) for x in examples[i]]
    temperature, least = _calibrate(table, held)
    return Model(languages, table, temperature, least)


def _calibrate(table: np.ndarray, held: list[tuple]) -> tuple[float, float]:
    if not held:
        return 1.0, 0.0
    logits = np.array([share @ table[ids] for (ids, share), _ in held], np.float64)
    truth = np.array([y for _, y in held])
    grid = np.geomspace(0.05, 20, 60)
    losses = [
        -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid
    ]
    temperature = float(grid[int(np.argmin(losses))])
    p = _softmax(logits / temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-best, kind="stable")
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(accuracy >= ACCEPTED_ACCURACY)
    return temperature, float(best[order][good[-1]]) if len(good) else 1.0


def train(docs: DataFrame, rows_per_language: int = SAMPLE_ROWS_PER_LANGUAGE) -> Model:
    """A model from text and ``lang`` of the training fold: of each language at most
    ``rows_per_language`` distinct texts drawn by hash, at most ``SAMPLE_BYTES`` of text in all.
    Of a text that would take more than its language's part of these, an excerpt is learned."""
    modulus, held_out = HELD_OUT
    text = F.col("text").cast("string")
    rows = docs.select(
        text.alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64("doc_id").alias("order"),
        text_key(text).alias("hash"),
        fold(F.col("doc_id"), modulus).alias("fold"),
    ).where(
        (F.col("fold") != held_out) & F.col("lang").isNotNull() & F.col("text").rlike(MAYBE_LETTER)
    )
    # a text counts once, however many rows hold it: the draw is by its hash, so all of them
    # pass it or none does, and its share has to follow the number of distinct texts
    distinct = saved(rows.groupBy("lang", "hash").agg(F.min("order").alias("order")), "language-texts")
    # both stored, so that their known size decides the joins: no language's texts meet in a task
    sizes = saved(distinct.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    # a few times the texts wanted of each language are ranked, however many there are
    some = distinct.join(sizes, "lang").where(
        drawn(F.col("hash"), F.lit(4.0 * rows_per_language) / F.col("n"))
    )
    ranked = some.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("order", "hash"))
    ).where(F.col("rank") <= rows_per_language)
    chosen = saved(ranked.select("lang", "hash", "order", "rank"), "language-sample")
    # some texts of every language fit the bytes, whatever their length: eight at four bytes a
    # character. An excerpt starts at the first letter.
    longest = max(1, SAMPLE_BYTES // (32 * max(1, sizes.count())))
    start = F.length(F.split("text", MAYBE_LETTER, 2)[0]) + 1
    excerpt = F.when(
        F.length("text") > longest, F.col("text").substr(start, F.lit(longest))
    ).otherwise(F.col("text"))
    sample = rows.join(chosen, ["lang", "hash", "order"]).groupBy("rank", "lang").agg(
        F.first(excerpt).alias("text")
    )
    texts, langs, size = [], [], 0
    for row in sample.orderBy("rank", "lang").select("text", "lang").toLocalIterator():
        size += len(row.text.encode())
        if texts and size > SAMPLE_BYTES:
            break
        if has_letter(row.text):
            texts.append(row.text)
            langs.append(row.lang)
    return fit(texts, langs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` of every document.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if there
    was nothing to learn from. ``accepted`` is false below the calibrated confidence. A null
    id counts as not held out; repeated rows get a row each; an empty table gives no rows;
    other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    modulus, held_out = HELD_OUT
    parts = (model.languages, model.table, model.temperature, model.least)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def guess(texts: pd.Series) -> pd.DataFrame:
        own = Model(*shared.value)
        rows = [own.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "accepted"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"),
        guess(F.col("text").cast("string")).alias("guess"),
    ).select("doc_id", "held_out", "guess.*")
