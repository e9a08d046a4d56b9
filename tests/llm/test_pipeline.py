"""The corpus pipeline against the stages applied by hand, and its guard."""

import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontaminate import plain as plain_items
from test_pii import plain as plain_spans
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from matchlake.llm import packing, toxicity
from matchlake.llm.tokens import vocabulary_path

SF = "/root/testdata/sf0.001"


def masked(text):
    spans = sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in plain_spans(text)))
    out, at = "", 0
    for start, end, kind in spans:
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def kept_by_hand(spark, rows, sf_dir):
    """(doc_id, text) that should reach the packing stage."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    features = toxicity.WordFeatures()
    rows = [r for r, s in zip(rows, model.scores(features(t) for _, t in rows)) if s < 0.3]
    label = plain_components([plain_fingerprint(t) for _, t in rows])
    least = {}
    for (doc_id, _), at in zip(rows, label):
        least[at] = min(least.get(at, doc_id), doc_id)
    rows = [(d, t) for (d, t), at in zip(rows, label) if least[at] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    return [
        (d, masked(t)) for (d, t), held in zip(rows, plain_items([t for _, t in rows], items)) if not held
    ]


def test_pipeline_against_the_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = dict(kept_by_hand(spark, rows, SF))
    got = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in want.items()}
    assert {r.doc_id: r.doc_tokens for r in got} == lengths
    assert sum(r.length for r in got) == sum(lengths.values()) and 0 < len(want) < len(rows)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "packing",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (None, ""), (2, "x " * 50_000), (2, "x " * 50_000)]])
def test_unusual_documents(spark, rows):
    docs = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    if rows:  # one empty text and one long one stay
        assert {(r.doc_id, r.doc_tokens) for r in docs.collect()} == {(1, 1), (2, 50_001)}
        assert np.sum([r.length for r in docs.collect()]) == 50_002
    else:
        assert docs.columns == packing.pack(docs.select("doc_id", F.lit("").alias("text"))).drop("ids").columns


def test_every_operator_has_its_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_the_library_works_without_the_subpackage(tmp_path):
    """A session that cannot import it registers the other queries."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, *rest):\n"
        "        if name in ('matchlake.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 35 and not [n for n in e.queries() if n.startswith('op')]\n"
        "assert set(e.queries()) <= set(e.oracle_sql())\n"
    )
    root = entry.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
