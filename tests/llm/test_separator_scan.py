"""Token counts from flat files against the tokenizer and against a reading value by value."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlake.llm import separator_scan
from matchlake.llm.tokens import vocabulary_path


def counts(docs):
    tokenizer = Tokenizer.from_file(vocabulary_path())
    tokenizer.encode_special_tokens = True
    return sorted(
        (str(r.doc_id), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids))
        for r in docs.collect()
    )


def result(docs):
    found = separator_scan.document_token_counts(docs).collect()
    assert all(r.ended for r in found)
    return sorted((str(r.doc_id), r.n_tokens) for r in found)


@pytest.mark.parametrize("cut", ["128m", "30k"])
def test_documents(spark, conf, cut):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = counts(docs)
    conf(spark__sql__files__maxPartitionBytes=cut)
    assert result(docs) == want


def test_edge_rows(spark, conf):
    conf(spark__sql__files__maxPartitionBytes="20k")
    rows = [
        (1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (-5, "# ## a#b $ <|endoftext|>"),
        (2**63 - 1, "x"), (4, "many words " * 30_000), (0, "\n\n!"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"file": F.lit(1), "block": F.lit("x")}
    )
    assert result(docs) == counts(docs)
    assert result(docs.limit(0)) == []


def plain(data):
    values, out, own = np.frombuffer(data, "<u2", len(data) // 2).tolist(), [], []
    for v in values:
        if v:
            own.append(v)
        else:
            out.append((len(out), len(own), True))
            own = []
    return out + ([(len(out), len(own), False)] if len(data) % 2 or own else [])


@pytest.mark.parametrize("cut", ["64m", "500b"])
def test_foreign_files(spark, conf, tmp_path, cut):
    """Any values, line ends among them, with and without a separator at the end."""
    conf(spark__sql__files__maxPartitionBytes=cut, spark__sql__files__openCostInBytes="1")
    draw = np.random.default_rng(8)
    for i in range(6):
        values = draw.choice([0, 1, 10, 255, 256, 2560, 2570, 10 + 256 * 3, 513], int(draw.integers(0, 1500)))
        if i % 3 == 0:
            values = np.append(values, 0)
        (tmp_path / f"tokens-{i}").write_bytes(values.astype("<u2").tobytes() + b"\n" * (i == 4))
    found = separator_scan.count_tokens(spark, str(tmp_path), with_ids=False).collect()
    got = {}
    for r in found:
        got.setdefault(os.path.basename(r.file), []).append((r.number, r.n_tokens, r.ended))
    want = {p.name: plain(p.read_bytes()) for p in tmp_path.iterdir()}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
