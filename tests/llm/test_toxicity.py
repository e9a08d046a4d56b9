"""Toxicity: held-out accuracy, the folds it may learn from, and unusual rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from matchlake.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels)).join(labels, "doc_id")
    rows = [r for r in scored.collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    toxic = np.array([r.score for r in rows if r.toxic == 1])
    clean = np.array([r.score for r in rows if r.toxic == 0])
    assert np.mean(toxic[:, None] > clean[None, :]) > 0.8  # area under the curve, about 300 labelled rows to learn from
    assert np.mean(clean >= 0.3) < 0.1


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "x " * 200_000), (3, "x " * 200_000), (None, "text"), (4, "?!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"score": F.lit(5), "toxic": F.lit(1), "features": F.lit("x")}
    )
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels))
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    assert sorted(r.doc_id or 0 for r in scored.collect()) == [0, 1, 2, 3, 3, 4]
    assert all(0 <= r.score <= 1 for r in scored.collect())


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    assert toxicity.score_documents(docs, model).count() == 0
    assert toxicity.drop_toxic(docs, model).columns == ["doc_id", "text"]
