"""SimHash near-duplicates over word shingles, linked through pivot distance tables.

Every distinct fingerprint gets a table of its Hamming distances to reference fingerprints
(pivots). By the triangle inequality two fingerprints within ``max_bits`` differ by at most
``max_bits`` in every coordinate of that table, so a larger difference in any coordinate
discards a pair and only survivors are verified.

Which fingerprints meet is decided by equal bits: with at most two differing bits, one of
three parts of the fingerprint is equal, and so is one of three pieces of the rest. The nine
(part, piece) keys are split further by strips of the first pivot's distance. No pair is lost
and no group of fingerprints is expanded into pairs: a group is walked breadth first and
yields one edge per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, filled_id, free_names, keyed, saved, text_key
from matchlake.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
PARTS = 3
STRIP = 3 * MAX_BITS
# Reference fingerprints: 16 pseudo-random ones from a splitmix sequence.
PIVOTS = 16
KEY = ["__simhash_id", "__simhash_text"]


def pivots(count: int = PIVOTS) -> np.ndarray:
    z = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle_words + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # a bounded part of a very long text at a time
        to = min(n, at + (1 << 16))
        spans = zip(starts[at:to].tolist(), ends[at + shingle_words - 1 : to + shingle_words - 1].tolist())
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return of


def _bits(low: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))


def _cuts(total: int, parts: int) -> list[tuple[int, int]]:
    edges = [total * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def meeting_keys() -> Column:
    """Packed keys, at least one of which two fingerprints within two bits share."""
    keys = []
    for i, (low, high) in enumerate(_cuts(64, PARTS)):
        part = _bits(low, high - low)
        below = _bits(0, low) if low else F.lit(0).cast("long")
        above = _bits(high, 64 - high) if high < 64 else F.lit(0).cast("long")
        rest = F.shiftleft(above, low).bitwiseOR(below)
        for j, (a, b) in enumerate(_cuts(64 - (high - low), PARTS)):
            piece = F.shiftright(rest, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            packed = F.shiftleft(part, 20).bitwiseOR(F.shiftleft(piece, 4))
            keys.append(packed.bitwiseOR(F.lit(i * PARTS + j)))
    return F.array(*keys)


def with_pivot_table(fingerprints: DataFrame) -> DataFrame:
    """Adds the distances to all pivots: eight to a long, one byte each."""
    signed = pivots().view(np.int64).tolist()
    tables = []
    for at in range(0, PIVOTS, 8):
        packed = F.lit(0).cast("long")
        for k, pivot in enumerate(signed[at : at + 8]):
            distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(pivot))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(distance, 8 * k))
        tables.append(packed.alias(f"table{at // 8}"))
    return fingerprints.select("fp", *tables)


def walk(fps: np.ndarray, distances: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Edges (index, index of its component's start) that connect what is within range."""
    left = np.arange(len(fps))
    while len(left) > 1:
        start, left = left[0], left[1:]
        queue = [start]
        while queue and len(left):
            at = queue.pop()
            near = np.ones(len(left), bool)
            for coordinate in distances.T:  # largest coordinate difference
                near &= np.abs(coordinate[left] - coordinate[at]) <= max_bits
            survivors = np.flatnonzero(near)
            verified = np.bitwise_count(fps[left[survivors]] ^ fps[at]) <= max_bits
            found = survivors[verified]
            if len(found):
                queue.extend(left[found].tolist())
                yield from ((int(i), int(start)) for i in left[found])
                left = np.delete(left, found)


def _linker(max_bits: int):
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def edges(rows: pd.DataFrame) -> pd.DataFrame:
            fps = rows["fp"].to_numpy()
            groups = rows[["key", "strip"]].to_numpy()
            first = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[first, len(rows)])
            tables = np.ascontiguousarray(rows[["table0", "table1"]].to_numpy(np.int64))
            out = []
            for at, size in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                own = fps[at : at + size]
                table = tables[at : at + size].view(np.uint8).astype(np.int16)
                out.extend((own[i], own[j]) for i, j in walk(own.view(np.uint64), table, max_bits))
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

        kept = None  # the last group of a batch may go on in the next one
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            if not len(rows):
                continue
            last = rows.iloc[-1]
            open_ = ((rows["key"] == last["key"]) & (rows["strip"] == last["strip"])).to_numpy()
            kept = rows[open_]
            if not open_.all():
                yield edges(rows[~open_])
        if kept is not None:
            yield edges(kept)

    return link


def link_fingerprints(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(node, root)`` of the distinct longs in column ``fp``, for those linked to another."""
    if not 0 <= max_bits < PARTS:
        raise ValueError(f"max_bits must be below the number of parts, {PARTS}")
    distance = F.col("table0").bitwiseAND(F.lit(255))
    strips = F.array_distinct(F.array(F.floor(distance / STRIP), F.floor((distance + max_bits) / STRIP)))
    rows = (
        with_pivot_table(fingerprints)
        .select("fp", "table0", "table1", F.explode(meeting_keys()).alias("key"))
        .withColumn("strip", F.explode(strips))
        .repartition("key", "strip")
        .sortWithinPartitions("key", "strip", "fp")
    )
    return connected_components(rows.mapInPandas(_linker(max_bits), "a long, b long"), "a", "b")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: ``doc_id, text_key, fp, fingerprint, group_fp, component_id``.

    A null, empty or blank text has fingerprint zero and links like any other. ``component_id``
    is the smallest id reachable over links (null only if every id there is null);
    ``group_fp`` names the group even where ids repeat. An empty table gives no rows, repeated
    rows one row each. Other columns of ``docs`` are ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    of = _fingerprints(shingle_words)
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_key(F.col("text")).alias("text_key"),
            of(F.col("text").cast("string")).alias("fp"),
        ),
        "simhash-rows",
    )
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = link_fingerprints(distinct.select("fp"), max_bits)
    placed = saved(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("group_fp"), "least"
        ),
        "simhash-placed",
    )
    groups = placed.groupBy("group_fp").agg(F.min("least").alias("component_id"))
    named = saved(placed.drop("least").join(groups, "group_fp"), "simhash-named")
    return rows.join(named, "fp").select(
        "doc_id",
        "text_key",
        "fp",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "group_fp",
        "component_id",
    )


def one_of_each_group(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The document with the smallest id of each group, with all columns of ``docs``.

    Null ids count as the largest; of documents with the same id the one whose text has the
    smallest hash stays, and of rows with the same id and text any one. Null and empty texts
    form a group like any other.
    """
    names = free_names(docs, *KEY)
    chosen = (
        found.select("group_fp", filled_id(F.col("doc_id")).alias("id"), F.col("text_key").alias("hash"))
        .groupBy("group_fp")
        .agg(F.min(F.struct("id", "hash")).alias("one"))
        .select(F.col("one.id").alias(names[0]), F.col("one.hash").alias(names[1]))
    )
    rows = keyed(docs, names)
    kept = rows.join(saved(chosen, "simhash-chosen"), names, "left_semi").dropDuplicates(names)
    return kept.drop(*names)
