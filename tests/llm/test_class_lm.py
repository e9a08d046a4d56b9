"""Class bigram model: counts and base scores against a direct count, and a proper model."""

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchlake.llm import class_lm

SF = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(rows, got):
    counts = Counter(w for i, t in rows if not held_out(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (
            str(i), held_out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
            sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(t)),
        )
        for i, t in rows
    )
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    for w, h in zip(want, have):
        assert h[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


def test_whole_table(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(class_lm, "CHUNK_BYTES", 300_000)
    monkeypatch.setattr(class_lm, "WORDS_PER_PART", 20_000)
    got = class_lm.score_documents(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    once = {r.doc_id: r.score for r in class_lm.score_documents(docs, sweeps=1).collect()}
    assert sum(r.score for r in held) > sum(once[r.doc_id] for r in held)


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "a B\x0bb\x1cb A"), (3, "a B\x0bb\x1cb A"), (None, "a É"), (4, "b " * 200_000),
        (12, "new words only"), (9, "É a é"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"score": F.lit("x"), "chunk": F.lit(1), "k": F.lit(2)}
    )
    check(rows, class_lm.score_documents(docs).collect())
    assert class_lm.score_documents(docs.limit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(60) if held_out(i)]
    docs = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")
    for r in class_lm.score_documents(docs).collect():
        assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_an_unknown_word_costs_more_than_a_known_one(spark):
    """On held-out documents, by least squares over their known and unknown tokens."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in class_lm.score_documents(docs).collect() if r.held_out]
    counts = np.array([(r.n_known, r.n_tokens - r.n_known) for r in rows], float)
    weight = 1 / np.sqrt(counts.sum(axis=1))
    per_token, base = (
        np.linalg.lstsq(counts * weight[:, None], np.array([r[c] for r in rows]) * weight, rcond=None)[0]
        for c in ("score", "base_score")
    )
    assert per_token[1] < per_token[0] < 0 and counts[:, 1].sum() > 1000
    assert per_token[0] > base[0]  # known words are likelier than under the unigram


def test_probabilities_add_up():
    draw = np.random.default_rng(2)
    width = class_lm.CLASSES + 1
    pairs = draw.integers(0, 50, (width, width)) * (draw.random((width, width)) < 0.3)
    pairs[-1] = pairs[:, -1] = pairs[:, 4] = 0
    logs = class_lm.log_transitions(pairs.ravel(), once=30, distinct=500).reshape(width, width)
    sizes = pairs[:-1, :-1].sum(axis=0)  # a class has words with as many tokens in all
    for row in logs:
        assert (10 ** row[:-1] * sizes).sum() + 10 ** row[-1] * 501 == pytest.approx(1)


def test_a_sweep_raises_the_likelihood():
    draw = np.random.default_rng(4)
    n, classes = 300, class_lm.CLASSES
    kinds = draw.integers(0, 3, n)  # words of three kinds, each with contexts of its own
    owners, slots, seen = [], [], []
    for w in range(n):
        for slot in range(class_lm.SLOTS):
            if slot % 3 == kinds[w] and draw.random() < 0.6:
                owners.append(w), slots.append(slot), seen.append(int(draw.integers(1, 9)))
    counts = np.bincount(owners, seen, n).astype("<i8") // 2  # contexts before and after
    row = pd.DataFrame(
        [
            (
                counts.tobytes(), draw.integers(1, classes, n).astype("u1").tobytes(),
                np.array(owners, "<i4").tobytes(), np.array(slots, "u1").tobytes(), np.array(seen, "<i8").tobytes(),
            )
        ],
        columns=["counts", "first", "owners", "slots", "seen"],
    )

    def likelihood(found):
        m = found[:-1].astype(float)
        sizes = found[-1].astype(float)
        part = np.where(m > 0, m * np.log(np.maximum(m, 1)), 0).sum()
        return part - 2 * np.where(sizes > 0, sizes * np.log(np.maximum(sizes, 1)), 0).sum()

    contexts, values = None, []
    for _ in range(6):
        out = next(class_lm._context_counts(contexts)(iter([row])))
        total = np.zeros((class_lm.SLOTS + 1) * classes + 3, np.int64)
        total[out["k"]] = out["n"]
        contexts = total[:-3].reshape(-1, classes)
        values.append(likelihood(contexts))
    assert values[0] < values[1] and max(values) - values[-1] < 0.05 * (max(values) - values[0])
