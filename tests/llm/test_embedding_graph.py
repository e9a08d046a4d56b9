"""Embedding links against brute force over all pairs, and the recall audit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import embedding_graph as g


def plain(rows):
    own = {}
    for vec_id, vector, label in rows:
        ok = vec_id is not None and vector and None not in vector and label is not None
        if ok and np.isfinite(vector).all() and any(vector):
            own[vec_id] = (np.array(vector, float), label)
    ids = sorted(own)
    links = {i: set() for i in ids}
    for label, dim in {(own[i][1], len(own[i][0])) for i in ids}:
        some = [i for i in ids if own[i][1] == label and len(own[i][0]) == dim]
        x = np.stack([own[i][0] / np.linalg.norm(own[i][0]) for i in some])
        for a, b in np.argwhere(x @ x.T >= 0.98).tolist():
            if a != b:
                links[some[a]].add(some[b])
    root = {i: i for i in ids}
    for i in ids:
        todo = [i] if root[i] == i else []
        while todo:
            for n in links[todo.pop()]:
                if root[n] > i:
                    root[n] = i
                    todo.append(n)
    return sorted(
        (str(v), len(links.get(v, ())), str(root.get(v, v)), root.get(v, v) == v) for v, _, _ in rows
    )


def result(vectors):
    found = g.near_duplicates(vectors)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found.collect())


def test_whole_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plain([(r.vec_id, r.embedding, r.label) for r in vectors.collect()])
    assert result(vectors) == want


def test_whole_table_over_several_shards(spark, monkeypatch):
    """The same table with some pivots to every label, so that dealing and overlap are used."""
    monkeypatch.setattr(g, "SHARD", 4)
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    _, vertices = g._vertices(vectors)
    pivots = g._pivots(vertices)
    assert len(pivots) == 10 and min(map(len, pivots.values())) > g.OVERLAP
    want = plain([(r.vec_id, r.embedding, r.label) for r in vectors.collect()])
    assert result(vectors) == want


def clustered(n, dim, seed):
    """Vectors in near pairs and small near groups."""
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dim))
    of = np.arange(n) // 3 * 3
    x = x[of] + 0.1 * draw.normal(size=(n, dim)) * (np.arange(n) % 3 > 0)[:, None]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_shards_of_a_vector_do_not_grow_with_the_pivots(spark):
    x = clustered(2_000, 64, 8)
    vertices = spark.createDataFrame(
        [(i, 1, 1, 64, v.tobytes()) for i, v in enumerate(x)], "node long, weight long, label long, dim int, unit binary"
    )
    for n in (16, 64, 256):
        dealt = g._dealt(vertices, {(1, 64): x[:: len(x) // n][:n]}, g.OVERLAP)
        most, mean = dealt.agg(F.max(F.size("shards")), F.avg(F.size("shards"))).first()
        assert most == g.OVERLAP and 4 < mean <= g.OVERLAP


def test_overlap_grows_until_the_audit_is_met(spark, monkeypatch):
    monkeypatch.setattr(g, "SHARD", 12)
    monkeypatch.setattr(g, "OVERLAP", 1)
    rows = [(i, v, 1) for i, v in enumerate(clustered(600, 64, 5).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    _, vertices = g._vertices(vectors)
    tried, link = [], g.link
    monkeypatch.setattr(g, "link", lambda v, p, overlap: tried.append(overlap) or link(v, p, overlap))
    g._links(vertices)
    assert tried == [2**i for i in range(len(tried))] and len(tried) > 1
    want, got = plain(rows), result(vectors)
    assert sum(b[1] for b in got) >= 0.98 * sum(a[1] for a in want) > 0


def test_a_recall_that_stays_low_is_an_error(spark, monkeypatch):
    rows = [(i, v, 1) for i, v in enumerate(clustered(90, 16, 2).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(g.Searcher, "near", lambda self, query, own=-1: (np.array([], np.int64), np.array([])))
    with pytest.raises(Exception, match="0.000 of the audited links"):
        g.near_duplicates(vectors)


@pytest.mark.parametrize("shard, part", [(150, 100_000), (150, 60), (100_000, 100)])
def test_shards_and_parts(spark, monkeypatch, shard, part):
    """Pairs, chains and one dense group, over several shards and parts of shards."""
    monkeypatch.setattr(g, "SHARD", shard)
    monkeypatch.setattr(g, "PART", part)
    draw = np.random.default_rng(6)
    x = draw.normal(size=(700, 24))
    x[100:160] = x[100] + 0.35 * draw.normal(size=(60, 24)) * 0.35
    x[200:400] = x[200] + 0.12 * draw.normal(size=(200, 24))
    x[400:430] = x[300:330]  # equal vectors
    rows = [(i, v, int(i % 2 if i < 100 else 1)) for i, v in enumerate(x.tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want, got = plain(rows), result(vectors)
    links = sum(w[1] for w in want)
    assert sum(min(a[1], b[1]) for a, b in zip(want, got)) >= 0.99 * links
    assert all(b[1] <= a[1] for a, b in zip(want, got))  # no false links
    assert [w[2] for w in want] == [h[2] for h in got]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (13, [1e-200, 1e-201], 3),
        (14, [1e200, 1e199], 3), (15, [-1.0, 0.0], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {"node": F.lit("x"), "links": F.lit(1), "h1": F.lit(None)}
    )
    assert result(vectors) == plain([r if r[0] != 13 and r[0] != 14 else (r[0], [10.0, 1.0], 3) for r in rows])
    assert result(vectors.limit(0)) == []


def test_audit(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 16))
    x[50:90] = x[50] + 0.02 * draw.normal(size=(40, 16))
    rows = [(i, v, 1) for i, v in enumerate(x.tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = g.near_duplicates(vectors)
    assert g.audit_recall(vectors, found) == 1.0
    assert g.audit_recall(vectors, found.withColumn("n_links", F.lit(0).cast("long")), 500) == 0.0


def test_pruned_graph_is_sparse_and_finds_the_nearest():
    draw = np.random.default_rng(9)
    x = draw.normal(size=(800, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    edges = g.build_graph(x)
    assert max(map(len, edges)) <= 2 * g.DEGREE + g.DEGREE
    nearest = (x @ x.T - 2 * np.eye(len(x))).argmax(axis=1)
    assert np.mean([n in e for n, e in zip(nearest, edges)]) > 0.99
