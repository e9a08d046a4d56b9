"""Packing: an exact round trip, no gaps, and lengths that need no padding."""

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlake.llm import packing
from matchlake.llm.tokens import WordIds, vocabulary_path

SF = "/root/testdata/sf0.001"


def check(docs, window=4096):
    tokenizer = Tokenizer.from_file(vocabulary_path())
    wanted = sorted(
        (str(r.doc_id), tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]))
        for r in docs.collect()
    )
    pieces = packing.pack(docs, window=window).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length > 0 and zlib.crc32(bytes(p.ids)) == p.ids_crc32
        by_sequence[p.sequence_id].append((p.offset, p.length, p.sequence_length))
        by_doc[str(p.doc_id)].append((p.start, p.doc_tokens, tuple(ids.tolist())))
    for parts in by_sequence.values():
        at = 0
        for offset, length, whole in sorted(parts):
            assert offset == at
            at += length
        assert at == whole and (at == window or at & (at - 1) == 0 and at < window)
    return wanted, by_doc, by_sequence


def test_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted, by_doc, _ = check(docs)
    for doc_id, ids in wanted:
        parts = sorted(by_doc[doc_id])
        assert sum((p[2] for p in parts), ()) == ids
        assert {p[1] for p in parts} == {len(ids)}


def test_edge_rows(spark):
    long = "word and other words, " * 9_000
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "no id"), (4, long),
            (5, "it's <|endoftext|>x É")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"ids": F.lit("x"), "start": F.lit(1)}
    )
    wanted, by_doc, _ = check(docs.coalesce(1), window=64)
    assert sorted(wanted, key=len) and {d for d, _ in wanted} == set(by_doc)
    got = sorted(i for parts in by_doc.values() for p in parts for i in p[2])
    assert got == sorted(i for _, ids in wanted for i in ids)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_place_minimises_the_sum_of_squares():
    draw = np.random.default_rng(5)
    levels = packing.Levels(32)
    for size in draw.integers(1, 32, 400).tolist():
        before = levels.counts.copy()
        costs = {}
        for h in [0] + [h for h in range(1, 33 - size) if before[h]]:
            after = before.copy()
            if h:
                after[h] -= 1
            if h + size < 32:
                after[h + size] += 1
            costs[h] = int((after[1:32] ** 2).sum())
        got = levels.place(size)
        level = 0 if got is None else got[0]
        assert costs[level] == min(costs.values())
        assert level == max(h for h, c in costs.items() if c == min(costs.values()))
        if level + size < 32:
            levels.put([level + size], level + size)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("aZ.,'sté1 <|>", max_size=40) | st.text("ßıİǅŉſéñüÿĳ́ ", max_size=12))
def test_ids_word_by_word_equal_ids_of_the_text(text):
    global _words
    try:
        words = _words
    except NameError:
        words = _words = WordIds(vocabulary_path())
    whole = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.raw(text), "<u4").tolist() == whole
