"""Exact top-k by inner product through an index of pivots and distances.

Inner products become distances by one more component: a candidate v gets sqrt(M - |v|^2), M
being the largest squared norm, a query gets 0; then |q' - v'|^2 = |q|^2 + M - 2 q.v, so the
best scores are the nearest vectors. Every candidate is keyed by its nearest pivot and its
distance to it, and each pivot's distances are cut into annuli. A query visits annuli in the
order of the least distance the triangle inequality allows, more of them each round, and stops
when that bound exceeds the distance of its k-th best score so far. Bounds that tie are visited,
so equal scores go to the smaller id.

An annulus is cut into parts and its queries into batches, so that a task holds a bounded
number of both however hot a place is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import drawn, saved

SCALE = 1024.0
TOP = 10
ANNULUS = 1_000  # vectors wanted in an annulus
MOST_PIVOTS, MOST_RINGS = 1_024, 64  # bound the directory, which is broadcast; annuli grow instead
PART, QUERIES = 4_000, 2_000  # vectors and queries in a task
EXPANSION = 8
EXACT_DOUBLE, EXACT_LONG = 2.0**52, 2.0**62
MARGIN = 1e-5  # of sqrt(M): beyond what rounding can do to a distance
KEYED = "dim int, pivot int, dist double, vec_id long, vec binary"
VISITS = "query_id long, vec binary, kth long, block int, part long"
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id, dim, vec, norm``: distinct rows with floor(scale * component); norm is squared."""
    wide = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")
    )
    finite = F.forall("e", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = wide.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull()).where(finite)
    floors = F.transform("e", lambda x: F.floor(x * F.lit(scale)))
    size = F.aggregate("e", F.lit(0.0), lambda sum_, x: sum_ + F.pow(F.floor(x * F.lit(scale)).cast("double"), F.lit(2)))
    fits = F.when(size < EXACT_LONG, size).otherwise(
        F.raise_error(F.lit("vectors too large for inner products of 64 bits")).cast("double")
    )
    rows = whole.select("vec_id", F.size("e").alias("dim"), floors.alias("vec"), fits.alias("norm"))
    return rows.dropDuplicates(["vec_id", "vec"])


# --- the index ------------------------------------------------------------------------------


def _matrix(raw, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, raw)), "<i8").reshape(len(raw), dim)


class Pivots:
    """Pivots of one dimension, and distances to them in the space with one more component."""

    def __init__(self, vectors: np.ndarray, largest: float):
        self.vectors, self.largest = vectors.astype(np.float64), largest
        self.norms = (self.vectors**2).sum(axis=1)
        self.extra = np.sqrt(np.maximum(largest - self.norms, 0))

    def distances(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        vectors = vectors.astype(np.float64)
        norms = (vectors**2).sum(axis=1)
        extra = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(self.largest - norms, 0))
        squared = norms[:, None] + self.norms - 2 * vectors @ self.vectors.T
        return np.sqrt(np.maximum(squared + (extra[:, None] - self.extra) ** 2, 0))


def _draw(rows: DataFrame, counts: dict[int, int], largest: float) -> dict[int, Pivots]:
    """Pivots by dimension, drawn by hash; a zero vector where none is drawn. Any pivots are
    right, their number only decides how much is pruned."""
    total = sum(counts.values())
    wanted = {
        dim: max(1, min(round((n / ANNULUS) ** 0.5), MOST_PIVOTS * n // total)) for dim, n in counts.items()
    }
    own = rows.sparkSession.createDataFrame(
        [(dim, w, min(1.0, 16.0 * w / counts[dim])) for dim, w in wanted.items()], "dim int, wanted int, share double"
    )
    order = F.xxhash64("vec")
    some = rows.join(F.broadcast(own), "dim").where(drawn(order, F.col("share"))).dropDuplicates(["vec"])
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(order, "vec"))
    found: dict[int, list] = {}
    for r in some.withColumn("rank", rank).where("rank <= wanted").select("dim", "vec").collect():
        found.setdefault(r.dim, []).append(r.vec)
    zero = {dim: [[0] * dim] for dim in counts}
    return {dim: Pivots(np.array(v, np.int64).reshape(len(v), dim), largest) for dim, v in (zero | found).items()}


def _keys(pivots) -> object:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                vectors = np.array([np.asarray(v, np.int64) for v in own["vec"]], np.int64).reshape(len(own), dim)
                far = pivots.value[dim].distances(vectors)
                nearest = far.argmin(axis=1)
                yield pd.DataFrame(
                    {
                        "dim": dim,
                        "pivot": nearest,
                        "dist": far[np.arange(len(own)), nearest],
                        "vec_id": own["vec_id"].to_numpy(),
                        "vec": [v.tobytes() for v in vectors.astype("<i8")],
                    }
                )

    return run


class Index:
    """Every candidate by annulus and part, and the directory of the annuli."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("norm")).collect()
        counts = {r.dim: r.n for r in sizes}
        self.largest = max((r.norm for r in sizes), default=0.0)
        self.pivots = _draw(rows, counts, self.largest)
        self.shared_pivots = spark.sparkContext.broadcast(self.pivots)
        keyed = saved(rows.select("dim", "vec_id", "vec").mapInPandas(_keys(self.shared_pivots), KEYED), "topk-keys")
        cuts = [k / MOST_RINGS for k in range(1, MOST_RINGS)]
        # at most MOST_PIVOTS rows and one more for each dimension
        rings = keyed.groupBy("dim", "pivot").agg(
            F.least(F.ceil(F.count("*") / ANNULUS), F.lit(MOST_RINGS)).alias("rings"),
            F.percentile_approx("dist", cuts, 1_000).alias("cuts"),
        )
        ends = F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(MOST_RINGS - 1)), lambda k: (k > 0) & (k < F.col("rings"))),
            lambda k: F.get("cuts", F.floor(k * MOST_RINGS / F.col("rings")).cast("int") - 1),
        )
        rings = saved(rings.select("dim", "pivot", ends.alias("ends")), "topk-rings")
        ring = F.size(F.filter("ends", lambda end: end <= F.col("dist")))
        keyed = keyed.join(F.broadcast(rings), ["dim", "pivot"]).withColumn("ring", ring)
        place = ["dim", "pivot", "ring"]
        found = keyed.groupBy(*place).agg(
            F.min("dist").alias("low"), F.max("dist").alias("high"), F.ceil(F.count("*") / PART).alias("parts")
        )
        self.annuli = found.orderBy(*place).toPandas()  # MOST_PIVOTS * MOST_RINGS rows
        self.annuli["block"] = np.arange(len(self.annuli))
        blocks = spark.createDataFrame(
            self.annuli[[*place, "block", "parts"]], "dim int, pivot int, ring int, block int, parts long"
        )
        own = keyed.join(F.broadcast(blocks), place)
        part = F.pmod(F.xxhash64("vec_id", "vec"), "parts")
        self.members = saved(own.select("block", part.alias("part"), "vec_id", "vec", "dim"), "topk-index")


def least_distances(far: np.ndarray, annuli: pd.DataFrame) -> np.ndarray:
    """Least distance from queries (``far``: to every pivot) to vectors of every annulus."""
    to_pivot = far[:, annuli["pivot"].to_numpy()]
    return np.maximum(np.maximum(to_pivot - annuli["high"].to_numpy(), annuli["low"].to_numpy() - to_pivot), 0)


def _frontier(index: Index, shared, low: int, high: int):
    pivots = index.shared_pivots
    largest = index.largest

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                annuli = shared.value[dim]
                vectors = np.array([np.asarray(v, np.int64) for v in rows["vec"]], np.int64).reshape(len(rows), dim)
                norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
                kth = rows["kth"].to_numpy(np.float64, na_value=np.nan)
                radius = np.sqrt(np.maximum(norms + largest - 2 * kth, 0)) + MARGIN * np.sqrt(largest)
                far = pivots.value[dim].distances(vectors, queries=True)
                blocks, parts = annuli["block"].to_numpy(), annuli["parts"].to_numpy()
                pivot = annuli["pivot"].to_numpy()
                out = []
                for i, (query, best) in enumerate(zip(rows["query_id"].tolist(), rows["kth"])):
                    bound = least_distances(far[i : i + 1], annuli)[0]
                    order = np.lexsort((blocks, far[i, pivot], bound))[low:high]
                    # without k results yet the radius is not a number, and nothing stops it
                    order = order[~(bound[order] > radius[i])]
                    raw = vectors[i].astype("<i8").tobytes()
                    best = None if pd.isna(best) else int(best)
                    out += [(query, raw, best, b, p) for b, n in zip(blocks[order], parts[order]) for p in range(n)]
                if out:
                    names = [c.split()[0] for c in VISITS.split(", ")]
                    yield pd.DataFrame(out, columns=names).astype({"kth": "Int64"})

    return run


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k highest scores, ties to the smaller id (ascending)."""
    if scores.shape[1] > k:
        bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, column = np.nonzero(scores >= bar[:, None])
    else:
        row, column = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def _visit(k: int, exact: bool):
    def run(members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in FOUND.split(", ")]
        if not len(members) or not len(asked):
            return pd.DataFrame({n: np.array([], np.int64) for n in names})
        members = members.sort_values("vec_id", kind="stable")
        dim = int(members["dim"].iloc[0])
        kind = np.float64 if exact else np.int64  # doubles hold every sum that occurs, or else longs
        scores = _matrix(asked["vec"], dim).astype(kind) @ _matrix(members["vec"], dim).astype(kind).T
        ids, first = np.unique(members["vec_id"].to_numpy(), return_index=True)
        scores = np.maximum.reduceat(scores, first, axis=1).astype(np.int64)
        query = asked["query_id"].to_numpy()
        row, column = best_of(scores, ids, k + 1)  # the query itself may be among them
        score = scores[row, column]
        kth = asked["kth"].to_numpy(np.int64, na_value=np.iinfo(np.int64).min)
        keep = (ids[column] != query[row]) & (score >= kth[row])
        return pd.DataFrame(dict(zip(names, (query[row][keep], ids[column][keep], score[keep]))))

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = TOP, scale: float = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products.

    Queries are the rows of ``is_query`` (over ``vec_id``; by default the ids divisible by 100),
    candidates all rows with another id. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part. Vectors of different lengths have no score;
    empty ones score 0 with each other. Repeated rows count once; an id with several vectors
    scores the best of them and takes one rank. Ties go to the smaller id. A query without
    candidates and an empty table give no rows; other columns are ignored. Inner products that
    might not fit in 64 bits are an error.
    """
    return _search(vectors, is_query, k, scale)[0]


def _search(vectors: DataFrame, is_query: Column | None, k: int, scale: float) -> tuple[DataFrame, list[int]]:
    """The result, and the number of (query, part of an annulus) visits of every round."""
    spark = vectors.sparkSession
    rows = saved(quantised(vectors, scale), "topk-vectors")
    index = Index(rows)
    by_dim = {int(d): own.reset_index(drop=True) for d, own in index.annuli.groupby("dim")}
    shared = spark.sparkContext.broadcast(by_dim)
    is_query = F.col("vec_id") % 100 == 0 if is_query is None else is_query
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "dim", "vec")
    results = _ranked(spark.createDataFrame([], FOUND), k)
    low, high, counted = 0, 1, []
    while low < len(index.annuli):
        kth = results.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        visits = saved(
            queries.join(kth, "query_id", "left").mapInPandas(_frontier(index, shared, low, high), VISITS), "topk-visits"
        )
        load = visits.groupBy("block").agg(F.count_if(F.col("part") == 0).alias("n"))
        batches = saved(load.select("block", F.ceil(F.col("n") / QUERIES).alias("batches")), "topk-load")
        counted.append(visits.count())
        if not counted[-1]:
            break
        batch = F.pmod(F.xxhash64("query_id", "vec"), "batches")
        asked = visits.join(F.broadcast(batches), "block").withColumn("batch", batch)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
        copies = batches.select("block", F.col("batches").alias("copies"))
        members = index.members.join(F.broadcast(copies), "block").withColumn("batch", every)
        place = ["block", "part", "batch"]
        found = members.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(
            _visit(k, index.largest < EXACT_DOUBLE), FOUND
        )
        results = saved(_ranked(results.select("query_id", "vec_id", "score").unionByName(found), k), "topk-results")
        low, high = high, high * EXPANSION
    return results.select("query_id", "rank", "vec_id", "score"), counted
