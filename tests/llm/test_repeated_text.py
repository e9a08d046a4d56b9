"""Repeated strings against a direct table of all strings of 400 bytes."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import repeated_text


def plain(rows, length=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for doc_id, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(doc_id), len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(docs):
    found = repeated_text.digests(repeated_text.without_repeats(docs)).collect()
    return sorted((str(r[0]), *r[1:]) for r in found)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert result(docs) == want and any(w[2] for w in want)


def test_all_kinds_of_edges(spark):
    draw = np.random.default_rng(11)

    def text(n, letters="abcdefgh "):
        return "".join(draw.choice(list(letters), n))

    shared = [text(n) for n in (399, 400, 401, 432, 700, 1500)]
    rows = []
    for i in range(40):
        parts = [text(int(draw.integers(0, 700)))]
        for k in draw.permutation(len(shared))[: int(draw.integers(0, 4))]:
            whole = shared[k]
            a = int(draw.integers(0, 60)) if draw.random() < 0.6 else 0
            b = int(draw.integers(0, 60)) if draw.random() < 0.6 else 0
            parts += [whole[a : len(whole) - b], text(int(draw.integers(0, 300)))]
        rows.append((i, "".join(parts)))
    rows += [(100, "é" * 300), (101, "x" + "é" * 199 + "é"), (102, "ab" * 1000), (103, "a" * 399), (104, "a" * 401)]
    rows += [(105, text(500, "01") + "\n" * 450), (106, shared[5] + shared[5][::-1] + shared[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs) == plain(rows)


def test_edge_rows(spark):
    body = " ".join(f"word{i}" for i in range(100))
    rows = [(1, None), (2, ""), (3, body), (3, body), (None, body[5:]), (3, "short"), (4, "short"), (5, "z" * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"spans": F.lit(1), "lo": F.lit("x")}
    )
    assert result(docs) == plain(rows)
    assert result(docs.limit(0)) == []


def test_many_rows_without_an_id_and_one_text(spark):
    """Work per row does not grow with the number of equal rows."""
    draw = np.random.default_rng(3)
    text = "".join(draw.choice(list("abcdefgh "), 8_000))
    other = text[:900] + text[::-1][:900]
    rows = spark.range(50_000).selectExpr("cast(null as long) doc_id").withColumn("text", F.lit(text))
    docs = rows.unionByName(spark.createDataFrame([(1, other), (2, text[::-1])], "doc_id long, text string"))
    found = repeated_text.digests(repeated_text.without_repeats(docs))
    counts = {tuple(r) for r in found.groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()}
    assert counts == {(None, 8_000, 8_000, 1, 50_000), (1, 1_800, 1_800, 1, 1), (2, 8_000, 900, 1, 1)}


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(repeated_text, "SEGMENT", 1 << 10)
    draw = np.random.default_rng(1)
    own = "".join(draw.choice(list("abcdefghij"), 9_000))
    rows = [(1, own), (2, own[1_000:5_500] + own[:450] + "x"), (3, own[2_000:2_400]), (4, own[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs) == plain(rows)


def test_many_partitions_are_written_as_few_files(spark, conf, monkeypatch, tmp_path):
    """An executor forks for every file, and a fork counts as much memory as the executor."""
    conf(spark__sql__shuffle__partitions="96", spark__sql__adaptive__coalescePartitions__enabled="false")
    folders = [str(tmp_path / str(i)) for i in range(20)]
    taken = []

    def path(_spark, label):
        taken.append(folders[len(taken)])
        return taken[-1]

    monkeypatch.setattr("matchlake.llm.common.scratch_path", path)
    draw = np.random.default_rng(7)
    texts = ["".join(draw.choice(list("abcdefgh "), 1_200)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i][i * 9 :] + texts[-i - 1][: 500 + i]) for i in range(40)]
    rows += [(7, texts[7]), (200, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(96)
    removed = repeated_text.without_repeats(docs)
    removed.write.parquet(path(spark, "result"))
    assert sorted((str(r[0]), *r[1:]) for r in repeated_text.digests(removed).collect()) == plain(rows)
    most = max(96 // 4, spark.sparkContext.defaultParallelism)
    files = [len([f for f in os.listdir(d) if f.endswith(".parquet")]) for d in taken]
    assert len(files) > 5 and max(files) <= most, files


@pytest.mark.parametrize("width, n", [(1, 5), (4, 4), (7, 50)])
def test_sliding_least(width, n):
    values = np.random.default_rng(n).integers(0, 90, n).astype(np.uint64)
    got = repeated_text._sliding_least(values, width)
    assert got.tolist() == [min(values[i : i + width].tolist()) for i in range(n - width + 1)]
