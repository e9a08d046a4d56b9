"""Benchmark decontamination against direct overlap of every item with every document."""

import pickle

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchlake.llm import decontaminate as d

SF = "/root/testdata/sf0.01"


def plain(texts, items):
    """Items whose five-word shingles are in the text, by passages of the index's length."""
    step = max((len(d.words_of(t)) for _, t in items), default=1) + d.SHINGLE_WORDS
    out = []
    for text in texts:
        words, held = d.words_of(text), set()
        for item_id, item in items:
            wanted = d.shingles(d.words_of(item))
            parts = [d.shingles(p) for p in d.question_and_answer(item)]
            for at in range(0, max(1, len(words)), step):
                own = words[at : at + 2 * step]
                have = {b" ".join(own[i : i + n]) for n in range(1, 6) for i in range(len(own) - n + 1)}
                if (
                    wanted
                    and len(wanted & have) >= 0.8 * len(wanted)
                    and all(len(p & have) >= 0.5 * len(p) for p in parts)
                ):
                    held.add(item_id)
        out.append(sorted(held))
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    got = {r.doc_id: list(r.item_ids) for r in d.contaminated(docs, benchmark).collect()}
    holding = {
        r.doc_id: sorted(i for i, t in items if t in (r.text or "")) for r in docs.collect()
    }
    assert got == holding and any(got.values())  # passages are planted as they are


def test_retrieval_loses_no_overlap():
    draw = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]

    def text(n):
        words = draw.choice(vocabulary, n, p=np.arange(60, 0, -1) / 1830)
        return " ".join(w + ("." if draw.random() < 0.1 else "") for w in words)

    items = [(i, text(int(draw.integers(8, 40)))) for i in range(60)]
    texts = [text(300) for _ in range(40)]
    for k in range(30):  # planted, some with words changed
        words = items[k][1].split()
        for at in draw.integers(0, len(words), k % 3):
            words[at] = "changed"
        texts[k] = text(150) + " " + " ".join(words) + " " + text(90)
    index = d.Index(items)
    got = [index.matches(t) for t in texts]
    assert got == plain(texts, items) and sum(map(bool, got)) >= 12


def test_edge_rows(spark):
    item = "one two three four five six seven. The answer is eight nine ten"
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (None, item), (3, ""), (4, "short one")], "item_id long, text string"
    )
    rows = [
        (1, None), (2, ""), (3, item), (3, item), (None, item.upper()), (4, "x " * 100_000 + item),
        (5, item.replace(".", ",\n")), (6, "a short one here"), (7, "short and one"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_ids", F.lit("x"))
    got = sorted((r.doc_id or 0, list(r.item_ids)) for r in d.contaminated(docs, benchmark).collect())
    assert got == [
        (0, [1]), (1, []), (2, []), (3, [1]), (3, [1]), (4, [1]), (5, [1]), (6, [4]), (7, []),
    ]
    assert d.drop_contaminated(docs, benchmark).columns == docs.columns
    assert d.drop_contaminated(docs, benchmark).count() == 3
    none = benchmark.limit(0)
    assert d.drop_contaminated(docs, none).count() == len(rows)
    assert d.contaminated(docs.limit(0), benchmark).count() == 0


def test_shards_hold_everything(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = d.contaminated(docs, benchmark).orderBy("doc_id").collect()
    monkeypatch.setattr(d, "SHARD_ITEMS", 7)
    assert len(list(d.shards(benchmark))) == 6
    assert d.contaminated(docs, benchmark).orderBy("doc_id").collect() == whole


def test_weights_and_passages_do_not_depend_on_the_shards(spark, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    benchmark = benchmark.unionByName(
        spark.createDataFrame([(10**6, "!?"), (10**6 + 1, "ñ ñ ñ é"), (10**6 + 1, "ñ ñ ñ é")], benchmark.schema)
    )

    def weights():
        out, corpus_of = {}, d.corpora(benchmark)
        for items in d.shards(benchmark):
            index = d.Index(items, corpus_of(items))
            for word, term in index.terms.items():
                for item, weight in index.postings[term]:
                    out[index.items[item].item_id, word] = (round(weight, 12), index.step)
        return out

    whole = weights()
    rows = {(r.item_id, r.text) for r in benchmark.collect()}
    alone = d.Index(sorted(rows))
    assert whole == {
        (alone.items[item].item_id, word): (round(weight, 12), alone.step)
        for word, term in alone.terms.items()
        for item, weight in alone.postings[term]
    }
    monkeypatch.setattr(d, "SHARD_ITEMS", 7)
    assert weights() == whole
    used, matcher = [], d._matcher
    monkeypatch.setattr(d, "_matcher", lambda shared: used.append(shared.value) or matcher(shared))
    d.contaminated(benchmark.selectExpr("item_id AS doc_id", "text"), benchmark)
    assert len(used) > 1 and {d.Corpus(*c).n for _, c in used} == {len(rows) - 1}
    # executors need no copy of the package to read what is broadcast
    assert b"matchlake" not in pickle.dumps(used)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_any_text_is_accepted(text):
    index = d.Index([(1, "alpha beta gamma delta epsilon zeta. eta theta"), (2, "!")])
    assert index.matches(text) == []


def test_columns_named_like_the_keys_stay(spark):
    docs = spark.createDataFrame([(1, "some text", 7, "x")], "doc_id long, text string, __held_id int, __HELD_TEXT string")
    benchmark = spark.createDataFrame([(1, "another text of the benchmark that is long enough")], "item_id long, text string")
    kept = d.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "some text", 7, "x")]
