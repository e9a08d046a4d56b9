"""Removal of repeated byte strings: position ranks refined in rounds over sampled positions.

A byte goes if a string of ``length`` bytes over it also starts anywhere else. Prefix doubling
ranks every position by ever longer strings until its rank is unique or the strings are long
enough. Sorting a row per byte and round moves many times the text, so here a *position* is
first an anchor: the smallest hash of ``GRAM`` bytes in a window of ``length`` bytes, which is
the same anchor at the same offset in every copy of that window. Each anchor stands for the
run of windows that chose it.

Round by round the strings that must be equal grow, and what is settled drops out:

1. anchors with a unique hash: none of their windows is repeated;
2. anchors whose whole run, all its windows' bytes, equals another's: all are repeated;
3. the rest, at the edges of repeats, goes to blocks of windows of ``LEVELS`` sizes. A block
   whose common core is unique is not repeated, a block equal to another as a whole is, and
   any other is cut into the next smaller blocks, down to single windows.

Ranks are 64-bit hashes, always compared with the anchor's own hash beside them. Of equal runs
or blocks one goes on and stands for all, so copies cost no more than one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, bounded_reads, filled_id, saved, text_key

LENGTH = 400
GRAM = 32
LEVELS = (32, 4, 1)
PARTITIONS_A_TASK = 4  # shuffled partitions that one task writes, where there are many
SEGMENT = 1 << 19  # windows of a text handled at a time
KEY = ["id_key", "text_hash"]
ANCHORS = "id_key long, text_hash long, lo long, count long, offset long, anchor long, run long"
CONTEXTS = "id_key long, text_hash long, lo long, count long, offset long, anchor long, twin long, bytes binary"
BLOCKS = "core long, whole long, at_id long, at_lo long, block long, twin long"
REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHIFT = np.uint64(20)
_LOW = np.uint64((1 << 20) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values and powers of the base, made once in a task."""
    if SEGMENT in _TABLES:
        return _TABLES[SEGMENT]
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    n = SEGMENT + 4 * LENGTH
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(_INVERSE)
    _TABLES[SEGMENT] = values, np.cumprod(up), np.cumprod(down)
    return _TABLES[SEGMENT]


class Hashes:
    """Hashes of any string within a piece of text, equal for equal strings anywhere."""

    def __init__(self, raw: np.ndarray):
        values, up, self.down = _powers()
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        plain = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(plain + (end - start).astype(np.uint64))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window, from running minima within blocks of its width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(after[:n], upto[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """First window, number of windows, offset of the anchor in the first, hashes."""
    for at in range(0, len(raw) - LENGTH + 1, SEGMENT):
        piece = raw[at : at + SEGMENT + LENGTH - 1]
        hashes = Hashes(piece)
        start = np.arange(len(piece) - GRAM + 1)
        grams = hashes.of(start, start + GRAM)
        # ties go to the leftmost, in every copy alike
        ranked = (grams & ~_LOW) | start.astype(np.uint64)
        chosen = (_sliding_least(ranked, LENGTH - GRAM + 1) & _LOW).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        count = np.diff(np.r_[lo, len(chosen)])
        offset = chosen[lo] - lo
        run = hashes.of(lo, lo + count - 1 + LENGTH)
        run = mix(run ^ (offset * 512 + count).astype(np.uint64))
        yield lo + at, count, offset, grams[chosen[lo]].view(np.int64), run.view(np.int64)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _find_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = []
        for id_key, text_hash, text in zip(batch["id_key"], batch["text_hash"], batch["text"]):
            for lo, count, offset, anchor, run in anchors(_bytes(text)):
                n = len(lo)
                parts.append((np.full(n, id_key), np.full(n, text_hash), lo, count, offset, anchor, run))
        if parts:
            names = [c.split()[0] for c in ANCHORS.split(", ")]
            yield pd.DataFrame({name: np.concatenate(p) for name, p in zip(names, zip(*parts))})


def _cut_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes that a run's windows cover, cut out of the texts."""
    names = [c.split()[0] for c in CONTEXTS.split(", ")]
    for batch in batches:
        rows = []
        for id_key, text_hash, text, runs in zip(*(batch[c] for c in (*KEY, "text", "runs"))):
            raw = _bytes(text)
            for r in runs:
                own = raw[r["lo"] : r["lo"] + r["count"] - 1 + LENGTH].tobytes()
                rows.append((id_key, text_hash, r["lo"], r["count"], r["offset"], r["anchor"], r["twin"], own))
            if len(rows) >= 5_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)


def _together(sizes: np.ndarray) -> Iterator[slice]:
    """Rows in runs whose bytes fit one table of hashes."""
    at, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total + size > SEGMENT + LENGTH and i > at:
            yield slice(at, i)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield slice(at, len(sizes))


def _block_rows(level: int, above: int | None):
    """Blocks of ``level`` windows by offset, out of a run or out of its open larger blocks."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def of_rows(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["bytes"].map(len).to_numpy()
        base = np.cumsum(sizes) - sizes
        hashes = Hashes(np.frombuffer(b"".join(map(bytes, rows["bytes"])), np.uint8))
        last = rows["offset"].to_numpy()
        first = last - rows["count"].to_numpy() + 1
        if above is None:
            n = last // level - first // level + 1
            own = np.repeat(np.arange(len(rows)), n)
            blocks = np.arange(n.sum()) - (np.cumsum(n) - n)[own] + (first // level)[own]
            twins = rows["twin"].to_numpy()[own]
        else:
            per = above // level
            own = np.repeat(np.arange(len(rows)), rows["blocks"].map(len))
            larger = np.array([(b["block"], b["twin"]) for bs in rows["blocks"] for b in bs], np.int64)
            own, twins = np.repeat(own, per), np.repeat(larger[:, 1], per)
            blocks = (larger[:, :1] * per + np.arange(per)).ravel()
            inside = (blocks * level <= last[own]) & (blocks * level + level > first[own])
            own, blocks, twins = own[inside], blocks[inside], twins[inside]
        first, last, base = first[own], last[own], base[own]
        # a window with offset x starts ``last - x`` bytes into the run
        low = np.maximum(blocks * level, first)
        high = np.minimum(blocks * level + level - 1, last)
        # the core lies in every window of the block, those beyond the run included
        core = hashes.of(
            base + last - blocks * level, base + last - (blocks * level + level - 1) + LENGTH
        )
        whole = hashes.of(base + last - high, base + last - low + LENGTH)
        anchor = rows["anchor"].to_numpy().view(np.uint64)[own]
        core = mix(core ^ mix(anchor + blocks.astype(np.uint64) * np.uint64(_BASE)))
        whole = mix(whole ^ (low * 512 + high).astype(np.uint64))
        at_id, lo = rows["at_id"].to_numpy()[own], rows["lo"].to_numpy()[own]
        parts = (core.view(np.int64), whole.view(np.int64), at_id, lo, blocks, twins)
        return pd.DataFrame(dict(zip(names, parts)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _together(batch["bytes"].map(len).to_numpy()):
                yield of_rows(batch.iloc[part])

    return run


def _spans_of_blocks(blocks: DataFrame, runs: DataFrame, level: int) -> DataFrame:
    """Bytes covered by blocks: offsets back to positions, cut to the run."""
    low = F.greatest(F.col("block") * level, F.expr("offset - count + 1"))
    high = F.least(F.col("block") * level + (level - 1), F.col("offset"))
    anchor = F.col("lo") + F.col("offset")
    return blocks.join(runs, ["at_id", "at_lo"]).select(
        *KEY, (anchor - high).alias("start"), (anchor - low + LENGTH).alias("end")
    )


def _few_files(df: DataFrame) -> DataFrame:
    """Rows that fewer tasks write than shuffle: a task takes several partitions in turn.

    On a local file system without Hadoop's native library an executor forks three times for a
    file, and until the new program starts, a fork counts as much memory as the executor.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_A_TASK
    return df.coalesce(max(tasks, spark.sparkContext.defaultParallelism))


def _stored(df: DataFrame, label: str) -> DataFrame:
    return saved(_few_files(df), label)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``id_key, text_hash, start, end`` of repeated strings; they may overlap.

    Rows with the same id and text are repeated as a whole, so only one of them is compared with
    the others."""
    bounded_batches(docs.sparkSession, 500)
    bounded_reads(docs.sparkSession, 500)
    rows = docs.select(
        filled_id(F.col("doc_id")).alias("id_key"),
        text_key(F.col("text")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).where(F.octet_length("text") >= LENGTH)
    size = F.octet_length("text").cast("long").alias("size")
    sizes = rows.select(*KEY, size).groupBy(*KEY).agg(F.min("size").alias("size"), F.count("*").alias("n"))
    again = _stored(sizes.where("n > 1").select(*KEY, "size"), "repeats-rows")
    whole = again.select(*KEY, F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
    if not again.isEmpty():
        one = rows.join(again.select(*KEY), KEY, "left_semi").dropDuplicates(KEY)
        rows = rows.join(again.select(*KEY), KEY, "left_anti").unionByName(one)
    found = _stored(rows.mapInPandas(_find_anchors, ANCHORS), "repeats-anchors")
    classes = found.groupBy("anchor", "run").agg(
        F.count("*").alias("members"), F.min(F.struct(*KEY, "lo", "count", "offset")).alias("one")
    )
    classes = _stored(classes, "repeats-classes")
    groups = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    equal = classes.where("members > 1").select("anchor", "run")
    spans = [
        whole,
        found.join(equal, ["anchor", "run"], "left_semi").select(
            *KEY, F.col("lo").alias("start"), (F.col("lo") + F.col("count") - 1 + LENGTH).alias("end")
        ),
    ]
    open_runs = (
        classes.join(groups, "anchor")
        .select("one.*", "anchor", (F.col("members") > 1).cast("long").alias("twin"))
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("lo", "count", "offset", "anchor", "twin")).alias("runs"))
    )
    contexts = rows.join(open_runs, KEY).mapInPandas(_cut_contexts, CONTEXTS)
    contexts = _stored(
        contexts.withColumns({"at_id": F.xxhash64(*KEY), "at_lo": F.col("lo")}), "repeats-contexts"
    )
    runs = contexts.drop("bytes", "anchor", "twin")
    above, source = None, contexts
    for level in LEVELS:
        blocks = _stored(source.mapInPandas(_block_rows(level, above), BLOCKS), f"repeats-blocks-{level}")
        kinds = blocks.groupBy("core", "whole").agg(
            F.sum(F.col("twin") + 1).alias("members"), F.min(F.struct("at_id", "at_lo", "block")).alias("one")
        )
        if level != LEVELS[-1]:
            kinds = _stored(kinds, f"repeats-kinds-{level}")
        equal = kinds.where("members > 1").select("core", "whole")
        # the members of a run that had an equal are done
        settled = blocks.where("twin = 0").join(equal, ["core", "whole"], "left_semi")
        spans.append(_spans_of_blocks(settled.select("at_id", "at_lo", "block"), runs, level))
        if level == LEVELS[-1]:
            break
        undecided = kinds.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
        further = (
            kinds.join(undecided, "core")
            .select("one.*", (F.col("members") > 1).cast("long").alias("twin"))
            .groupBy("at_id", "at_lo")
            .agg(F.collect_list(F.struct("block", "twin")).alias("blocks"))
        )
        source = contexts.drop("twin").join(further, ["at_id", "at_lo"])
        above = level
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in REMOVED.split(", ")]
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
            raw = _bytes(text)
            edges = np.zeros(len(raw) + 1, np.int64)
            if spans is not None:
                np.add.at(edges, [s["start"] for s in spans], 1)
                np.add.at(edges, [s["end"] for s in spans], -1)
            gone = np.cumsum(edges[:-1]) > 0
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
            out.append(
                (None if pd.isna(doc_id) else int(doc_id), len(raw), int(gone.sum()), runs, raw[~gone].tobytes())
            )
        yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept``, the bytes that stay.

    A null text is empty. Repeated rows repeat each other's text, so all of it goes that is at
    least ``LENGTH`` bytes long. A null id stays null; an empty table gives no rows; other
    columns are ignored. One text and its spans are held at a time.
    """
    spans = (
        repeated_spans(docs).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        filled_id(F.col("doc_id")).alias("id_key"),
        text_key(F.col("text")).alias("text_hash"),
    )
    spans = _stored(spans, "repeats-spans")
    removed = rows.join(spans, KEY, "left").select("doc_id", "text", "spans").mapInPandas(_remove, REMOVED)
    return _few_files(removed)


def digests(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
