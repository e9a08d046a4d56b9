"""SimHash near-duplicates against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from matchlake.llm import simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fps)
    least = {}
    for (doc_id, _), at in zip(rows, label):
        if doc_id is not None:
            least[at] = min(least.get(at, doc_id), doc_id)
    return sorted(
        ((d, f"{fp:016x}", least.get(at)) for (d, _), fp, at in zip(rows, fps, label)), key=str
    )


def result(docs):
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, "a b c"),
        (7, "a b c"), (None, "a b c"), (None, "alone and without an id"), (8, long),
        (9, long + " x"), (10, "É é ß x y"), (11, "A\x1cB c d"), (12, "A\x0bB c d"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"component_id": F.lit("x"), "fp": F.lit(1), "table0": F.lit(None)}
    )
    assert result(docs) == expected(rows)
    kept = simhash.one_of_each_group(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    groups = len(set(plain_components([plain_fingerprint(t) for _, t in rows])))
    assert kept.count() == groups


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert result(docs) == []
    assert simhash.one_of_each_group(docs, simhash.near_duplicates(docs)).count() == 0


@pytest.mark.parametrize("spread", [3, 9])
def test_dense_group_of_fingerprints(spark, spread):
    """Chains and dense groups: every link counts, whatever keys its ends share."""
    draw = np.random.default_rng(spread)
    fps = {0, (1 << 64) - 1}
    for centre in draw.integers(0, 1 << 63, 4).tolist():
        for _ in range(60):
            flips = draw.integers(0, 64, int(draw.integers(0, spread)))
            fps.add(centre ^ sum(1 << int(b) for b in set(flips.tolist())))
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = simhash.link_fingerprints(spark.createDataFrame(signed, "fp long"))
    root = {r.node % (1 << 64): r.root for r in found.collect()}
    label = plain_components(fps)
    groups = {}
    for fp, at in zip(fps, label):
        groups.setdefault(at, []).append(fp)
    for members in groups.values():
        if len(members) == 1:
            assert members[0] not in root
        else:
            assert len({root[m] for m in members}) == 1
    assert len(set(root.values())) == sum(len(m) > 1 for m in groups.values())


def test_columns_named_like_the_keys_stay(spark):
    rows = [(2, "one text here", 7, "x"), (1, "one text here", 8, "y"), (1, "one text here", 8, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __simhash_id int, __simhash_text string")
    kept = simhash.one_of_each_group(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [rows[1]]
