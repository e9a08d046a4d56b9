"""Near-duplicate embeddings through a robust-pruned flat graph.

Vectors of a label are dealt to overlapping shards around pivots: to the nearest pivot (home)
and the next few, as many at every size of the table. In every shard a flat graph is built with robust pruning;
a vector's neighbour lists of all its shards are joined to one. Every vector is then a query
in its home shard: a greedy search from medoids, and from the vector itself where it is a
member, whose result is expanded along the graph as long as vertices stay near. What it finds
is verified by the exact cosine. Recall is audited against brute force in every run: where it
falls short the vectors are dealt to twice as many shards, in the end to all that could hold a
link, and a recall that stays low is an error.

Equal vectors are one vertex with a weight. A shard too large for a task is cut into parts;
each part has its own graph, and each part of the queries visits each part of the members.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import drawn, saved
from matchlake.llm.components import connected_components

LOG = logging.getLogger(__name__)
COSINE = 0.98
EXPAND_COSINE = 0.95  # vertices this near are expanded, though only COSINE links
SHARD = 250  # vectors wanted around a pivot
MOST_PIVOTS = 16_384  # bounds what is broadcast; more vectors make larger shards
PART = 8_000  # members, or queries, of a shard in one task
OVERLAP = 8  # shards of a vector, home included
# A linked vector's home is farther from the other by at most this much than the other's own.
MARGIN = 2 * np.arccos(COSINE)
WANTED_RECALL = 0.98  # by the audit; below it the overlap is doubled
LEAST_RECALL = 0.9  # an error where even the full overlap finds less
POOL, DEGREE, ALPHA = 48, 24, 1.2
BEAM = 24
MEDOIDS = 64
AUDITED = 256
GROUP = ["label", "dim"]
NODES = "node long, weight long, label long, dim int, unit binary"
HASH = ["label", "dim", "h1", "h2"]


# --- one shard, in numpy ----------------------------------------------------------------


def _matrix(units) -> np.ndarray:
    return np.stack([np.frombuffer(bytes(u), "<f8") for u in units])


def _prune(pool: np.ndarray, similarity: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Robust pruning of every row's pool (nearest first, -1 for none) to ``DEGREE`` ids."""
    n, size = pool.shape
    kept = np.full((n, DEGREE), -1, np.int64)
    far = 1 - similarity
    pooled = vectors[pool]
    between = 1 - pooled @ pooled.transpose(0, 2, 1)
    alive, rows = pool >= 0, np.arange(n)
    for k in range(DEGREE):
        chosen = alive.argmax(axis=1)
        has = alive[rows, chosen]
        if not has.any():
            break
        kept[has, k] = pool[rows, chosen][has]
        # a vertex goes if the chosen one is clearly nearer to it than the row's own is
        alive &= ~(ALPHA**2 * between[rows, chosen] <= far)
        alive[rows, chosen] = False
    return kept


def _nearest(vectors: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    similarity = vectors[of] @ vectors.T
    similarity[np.arange(len(of)), of] = -np.inf
    pool = np.argpartition(-similarity, size - 1, axis=1)[:, :size]
    own = np.take_along_axis(similarity, pool, axis=1)
    order = np.argsort(-own, axis=1, kind="stable")
    return np.take_along_axis(pool, order, axis=1), np.take_along_axis(own, order, axis=1)


def build_graph(vectors: np.ndarray) -> list[np.ndarray]:
    """Pruned neighbours of every vector, both ways."""
    n = len(vectors)
    size = min(POOL, n - 1)
    if size < 1:
        return [np.array([], np.int64)] * n
    out = np.full((n, DEGREE), -1, np.int64)
    for at in range(0, n, 256):
        of = np.arange(at, min(n, at + 256))
        out[of] = _prune(*_nearest(vectors, of, size), vectors)
    # an edge back from each neighbour; crowded vertices are pruned once more, but stay the way
    # to those they are nearest to, so that every vertex can be reached
    order = np.argsort(out[:, 0], kind="stable")
    led = np.split(order, np.searchsorted(out[order, 0], np.arange(1, n)))
    u, v = np.repeat(np.arange(n), DEGREE), out.ravel()
    u, v = u[v >= 0], v[v >= 0]
    pairs = np.unique(np.concatenate((u * n + v, v * n + u)))
    edges = np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))
    for i, own in enumerate(edges):
        if len(own) > 2 * DEGREE:
            near = vectors[own] @ vectors[i]
            nearest = np.argsort(-near, kind="stable")[: 2 * POOL]
            own = own[nearest]
            pruned = _prune(own[None], near[nearest][None], vectors)[0]
            edges[i] = np.unique(np.concatenate((pruned[pruned >= 0], own[:DEGREE], led[i])))
    return edges


class Searcher:
    """Greedy search and range expansion over a graph of unit vectors."""

    def __init__(self, vectors: np.ndarray, edges: list[np.ndarray]):
        self.vectors = vectors
        self.edges = edges
        self.medoids = self._medoids()

    def _medoids(self) -> np.ndarray:
        """The vertices nearest to the means of cells around evenly picked vertices."""
        picked = np.unique(np.linspace(0, len(self.vectors) - 1, MEDOIDS).astype(np.int64))
        cell = (self.vectors @ self.vectors[picked].T).argmax(axis=1)
        means = np.zeros((len(picked), self.vectors.shape[1]))
        np.add.at(means, cell, self.vectors)
        return np.unique((self.vectors @ means.T).argmax(axis=0))

    def near(self, query: np.ndarray, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Vertices with at least the wanted cosine, and their cosines."""
        similarity = np.full(len(self.vectors), -2.0)
        expanded = np.zeros(len(self.vectors), bool)
        entry = self.medoids if own < 0 else np.union1d(self.medoids, [own])
        similarity[entry] = self.vectors[entry] @ query
        seen = entry
        while True:
            best = seen if len(seen) <= BEAM else seen[np.argpartition(-similarity[seen], BEAM - 1)[:BEAM]]
            todo = best[~expanded[best]]
            if not len(todo):  # the beam is settled; go on where it is near enough
                todo = seen[(similarity[seen] >= EXPAND_COSINE) & ~expanded[seen]]
                if not len(todo):
                    break
            expanded[todo] = True
            reached = np.unique(np.concatenate([self.edges[t] for t in todo]))
            fresh = reached[similarity[reached] == -2.0]
            if len(fresh):
                similarity[fresh] = self.vectors[fresh] @ query
                seen = np.concatenate((seen, fresh))
        found = seen[similarity[seen] >= COSINE]
        return found, similarity[found]


def _graph_of_part(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    nodes = rows["node"].to_numpy()
    edges = build_graph(_matrix(rows["unit"]))
    return pd.DataFrame({"node": nodes, "near": [nodes[e] for e in edges]})


def _search_part(rows: pd.DataFrame) -> pd.DataFrame:
    members = rows[rows["member"]].sort_values("node")
    queries = rows[~rows["member"]].sort_values("node")
    if not len(members) or not len(queries):
        return pd.DataFrame({"node": [], "links": [], "joined": []}).astype("int64")
    nodes, weights = members["node"].to_numpy(), members["weight"].to_numpy()
    place = {n: i for i, n in enumerate(nodes.tolist())}
    edges = []
    for near in members["near"]:
        known = [place[n] for n in near if n in place] if near is not None else []
        edges.append(np.array(known, np.int64))
    searcher = Searcher(_matrix(members["unit"]), edges)
    asked = queries["node"].to_numpy()
    every = np.unique(np.concatenate((nodes, asked)))
    spot, label = np.searchsorted(every, nodes), np.arange(len(every))
    links = []
    for node, vector in zip(asked.tolist(), _matrix(queries["unit"])):
        found, _ = searcher.near(vector, place.get(node, -1))
        found = found[nodes[found] != node]
        links.append(int(weights[found].sum()))
        if len(found):  # one label for all that is linked so far
            held = np.unique(np.append(label[spot[found]], label[np.searchsorted(every, node)]))
            if len(held) > 1:
                label[np.isin(label, held[1:])] = held[0]
    joined = every[label[np.searchsorted(every, asked)]]
    out = pd.DataFrame({"node": asked, "links": links, "joined": joined})
    # members that are no queries here are joined too
    rest = ~np.isin(nodes, asked) & (every[label[spot]] != nodes)
    more = pd.DataFrame({"node": nodes[rest], "links": 0, "joined": every[label[spot[rest]]]})
    return pd.concat((out, more), ignore_index=True).astype("int64")


# --- the table, in Spark ----------------------------------------------------------------


def _units(batches):
    for batch in batches:
        units = []
        for vector in batch["embedding"]:
            raw = np.array([np.nan if x is None else x for x in vector], np.float64)
            raw = raw / max(np.abs(raw).max(), 1e-300) if np.isfinite(raw).all() and len(raw) else raw
            norm = np.sqrt(raw @ raw) if len(raw) else 0.0
            units.append((raw / norm).astype("<f8").tobytes() if np.isfinite(norm) and norm > 0 else None)
        yield batch.drop(columns=["embedding"]).assign(unit=units)


def _vertices(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(vec_id, node)`` of the vectors that can link, and their distinct vectors."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0")
    hashed = rows.withColumns(
        {"dim": F.size("embedding"), "h1": F.xxhash64("embedding"), "h2": F.hash("embedding")}
    )
    # an id that stands for several vectors counts with one of them
    ids = hashed.groupBy("vec_id").agg(F.min(F.struct(*HASH)).alias("own")).select("vec_id", "own.*")
    ids = saved(ids, "graph-ids")
    found = (
        hashed.join(ids.groupBy(*HASH).agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")), HASH)
        .where("vec_id = node")
        .dropDuplicates(["node"])
        .select("node", "weight", *HASH, "embedding")
    )
    schema = "node long, weight long, label long, dim int, h1 long, h2 int, unit binary"
    units = saved(found.mapInPandas(_units, schema).where("unit IS NOT NULL"), "graph-vertices")
    of = ids.join(units.select("node", "weight", *HASH), HASH).select("vec_id", "node", "weight")
    return saved(of, "graph-vec-ids"), units.select("node", "weight", *GROUP, "unit")


def _pivots(vertices: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Vectors of each label drawn by their hashes, one for about ``SHARD`` of them."""
    sizes = vertices.groupBy(*GROUP).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    shard = max(SHARD, -(-total // MOST_PIVOTS))
    wanted = sizes.select(*GROUP, F.ceil(F.col("n") / shard).alias("wanted")).where("wanted > 1")
    order = Window.partitionBy(*GROUP).orderBy(F.xxhash64("node"), "node")
    # a few times the pivots wanted are ranked, however many vectors a label has
    some = vertices.where(drawn(F.xxhash64("node"), F.lit(4.0 / shard)))
    ranked = some.join(wanted, GROUP).withColumn("rank", F.row_number().over(order))
    # at most MOST_PIVOTS and one more for each label with several shards
    rows = ranked.where("rank <= wanted").orderBy(*GROUP, "rank").collect()
    out: dict[tuple[int, int], list] = {}
    for r in rows:
        out.setdefault((r.label, r.dim), []).append(r.unit)
    return {k: _matrix(v) for k, v in out.items()}


def _dealt(vertices: DataFrame, pivots: dict, overlap: int) -> DataFrame:
    """Vertices with the at most ``overlap`` shards they are members of; the first is their home."""
    shared = vertices.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            shards = [[0]] * len(batch)
            for group, rows in batch.groupby(GROUP).indices.items():
                own = shared.value.get(group)
                for at in range(0, len(rows) if own is not None else 0, 256):
                    some = rows[at : at + 256]
                    cosine = _matrix(batch["unit"].iloc[some]) @ own.T
                    angle = np.arccos(np.clip(cosine, -1, 1))
                    near = np.argsort(angle, axis=1, kind="stable")[:, :overlap]
                    far = np.take_along_axis(angle, near, axis=1)
                    for row, order, held in zip(some.tolist(), near, far <= far[:, :1] + MARGIN):
                        shards[row] = order[held].tolist()
            yield batch.assign(shards=shards)

    return vertices.mapInPandas(run, NODES + ", shards array<int>")


def _parts(dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of shards by part, and queries by part of their home shard."""
    members = dealt.select("node", "weight", *GROUP, "unit", F.explode("shards").alias("shard"))
    sizes = members.groupBy(*GROUP, "shard").agg(F.ceil(F.count("*") / PART).alias("parts"))
    sizes = saved(sizes, "graph-shards")
    own_part = F.pmod(F.xxhash64("node"), F.col("parts"))
    key = [*GROUP, "shard"]
    members = members.join(sizes, key).withColumn("part", own_part)
    queries = (
        dealt.select("node", "weight", *GROUP, "unit", F.col("shards")[0].alias("shard"))
        .join(sizes, key)
        .withColumn("query_part", own_part)
    )
    return members, queries


def link(vertices: DataFrame, pivots: dict, overlap: int) -> DataFrame:
    """``node, links, joined``: summed weights of linked vertices, and a vertex of the same
    component; several rows to a node."""
    dealt = saved(_dealt(vertices, pivots, overlap), "graph-dealt")
    members, queries = _parts(dealt)
    key = [*GROUP, "shard", "part"]
    lists = members.select(*key, "node", "unit").groupBy(*key).applyInPandas(
        _graph_of_part, "node long, near array<long>"
    )
    graph = saved(
        lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")),
        "graph-edges",
    )
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    held = members.join(graph, "node").withColumn("query_part", every_part)
    asked = queries.withColumn("part", every_part)
    columns = [*key, "query_part", "node", "weight", "unit"]
    rows = held.select(*columns, "near", F.lit(True).alias("member")).unionByName(
        asked.select(*columns, F.lit(None).cast("array<long>").alias("near"), F.lit(False).alias("member"))
    )
    found = rows.groupBy(*key, "query_part").applyInPandas(
        _search_part, "node long, links long, joined long"
    )
    return saved(found, "graph-links")


def _links(vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``link`` finds and the links of every vertex, under the first overlap whose audited
    recall is good enough."""
    pivots = _pivots(vertices)
    every = max((len(p) for p in pivots.values()), default=1)
    overlap = OVERLAP
    while True:
        found = link(vertices, pivots, overlap)
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        counts = counts.join(vertices.select("node", "weight"), "node").select(
            "node", (F.col("links") + F.col("weight") - 1).alias("n_links")
        )
        counts = saved(counts, "graph-counts")
        recall = _recall(vertices, counts, AUDITED)
        LOG.info("recall %.4f with %d shards a vector", recall, overlap)
        if recall >= WANTED_RECALL:
            return found, counts
        if overlap >= every:
            if recall < LEAST_RECALL:
                raise RuntimeError(f"the graph finds {recall:.3f} of the audited links, wanted {LEAST_RECALL}")
            return found, counts
        overlap *= 2


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link if their labels are equal and not null and their cosine is at least
    ``COSINE``. A vector that is null, empty, zero or holds a null or non-finite component, and
    one without an id, links with nothing and is its own component; vectors of different
    lengths do not link. Audited before it is returned; a recall below ``LEAST_RECALL`` under
    the widest overlap raises. Rows with the same id are one vector (that with the smallest hash),
    each with the same result; equal vectors link. An empty table gives no rows; other columns
    are ignored.
    """
    ids, vertices = _vertices(vectors)
    found, counts = _links(vertices)
    roots = connected_components(found, "node", "joined")
    nodes = counts.join(roots, "node", "left").select("node", "n_links", F.coalesce("root", "node").alias("root"))
    known = ids.join(saved(nodes, "graph-nodes"), "node").select(
        F.col("vec_id").alias("id"), F.col("n_links").alias("links"), "root"
    )
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    return own.join(saved(known, "graph-result"), F.col("vec_id") == F.col("id"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce("root", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def audit_recall(vectors: DataFrame, found: DataFrame, queries: int = AUDITED) -> float:
    """Share of the links of at most ``queries`` vectors that the search found.

    Brute force: every vector is compared with the queries, which are the ids with the
    smallest hashes among those that link in truth or by the search. 1.0 without links.
    """
    _, vertices = _vertices(vectors)
    return _recall(vertices, found.select(F.col("vec_id").alias("node"), "n_links"), queries)


def _recall(vertices: DataFrame, found: DataFrame, queries: int) -> float:
    linked = found.where("n_links > 0").select("node")
    order = [F.xxhash64("node"), "node"]
    some = vertices.join(linked, "node").orderBy(*order).limit(queries)
    rows = some.unionByName(vertices.orderBy(*order).limit(queries)).dropDuplicates(["node"]).collect()
    asked: dict[tuple[int, int], tuple[list, list]] = {}
    for r in rows:
        own = asked.setdefault((r.label, r.dim), ([], []))
        own[0].append(r.node)
        own[1].append(bytes(r.unit))
    shared = vertices.sparkSession.sparkContext.broadcast(asked)

    def count(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for group, own in batch.groupby(["label", "dim"]):
                if group in shared.value:
                    nodes, units = shared.value[group]
                    near = _matrix(own["unit"]) @ _matrix(units).T >= COSINE
                    for node, n in zip(nodes, own["weight"].to_numpy() @ near):
                        total[node] = total.get(node, 0) + int(n)
        yield pd.DataFrame({"node": list(total), "n": list(total.values())}, dtype="int64")

    truth = vertices.mapInPandas(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    both = truth.join(found, "node").agg(
        F.sum(F.col("n") - 1), F.sum(F.least(F.col("n") - 1, F.col("n_links")))
    ).first()
    return 1.0 if not both[0] else both[1] / both[0]
