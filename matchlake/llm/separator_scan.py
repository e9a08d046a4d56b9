"""Token counts of documents in flat, unindexed token files, by a scan for separators.

A token file is a sequence of 16-bit little-endian values without any index: a token id ``t``
stands as ``t + 1``, and 0 ends a document. Optionally a document begins with its id in
``ID_VALUES`` values, 15 bits each with the top bit set, which therefore never equal 0.

Files are split at any byte by Spark's own text reader (its lines are only a way to get at the
bytes, on any store). A block, the part of a file that one split got, is searched for 0 with
one vectorised comparison for either alignment of its first byte. Sums of the blocks' sizes in
front of each block, a prefix scan over one row per block, give the alignment that holds and
join documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, saved
from matchlake.llm.tokens import WordIds, vocabulary_path
from matchlake.session import scratch_path

ID_VALUES = 5
ID_BYTES = 2 * ID_VALUES
NO_ID = 0xFFFF
BLOCKS = (
    "file string, block long, size long, file_size long, phase int, n_bytes long, first long, last long, "
    "head binary, tail binary, ids array<long>, counts array<long>"
)


# --- writing --------------------------------------------------------------------------


def id_values(doc_id: int | None) -> np.ndarray:
    if doc_id is None:
        return np.full(ID_VALUES, NO_ID, "<u2")
    value = doc_id % (1 << 64)
    return np.array([0x8000 | value >> 15 * k & 0x7FFF for k in range(ID_VALUES)], "<u2")


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None) -> str:
    """Token files of the documents, one per task, each document with its id in front."""
    bounded_batches(docs.sparkSession)
    source = vocabulary or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordIds(source, "H", special_tokens_are_text=True)
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch["doc_id"], words.raws(batch["text"].tolist())):
                ids = np.frombuffer(raw, "<u2") + np.uint16(1)
                head = id_values(None if pd.isna(doc_id) else int(doc_id))
                rows.append(head.tobytes() + ids.astype("<u2").tobytes())
            yield pd.DataFrame({"document": rows})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # the text writer puts the bytes of a string as they are, and 0 behind each
    documents = rows.mapInPandas(run, "document binary").select(F.col("document").cast("string"))
    documents.write.option("lineSep", "\0\0").text(path)
    return path


# --- scanning -------------------------------------------------------------------------


def _ids_at(values: np.ndarray, starts: np.ndarray) -> list[int | None]:
    at = np.minimum(starts[:, None] + np.arange(ID_VALUES), max(len(values) - 1, 0))
    own = values[at].astype(np.uint64)
    whole = np.zeros(len(starts), np.uint64)
    for k in range(ID_VALUES):
        whole |= (own[:, k] & np.uint64(0x7FFF)) << np.uint64(15 * k)
    none = (own == NO_ID).all(axis=1)
    return [None if n else i for i, n in zip(whole.view(np.int64).tolist(), none.tolist())]


def scan_block(data: bytes, phase: int, with_ids: bool) -> tuple:
    """First and last separator (byte positions, -1 if none), ends of the block, and ids and
    counts of the documents between two separators."""
    values = np.frombuffer(data, "<u2", (len(data) - phase) // 2, phase)
    ends = np.flatnonzero(values == 0)
    if not len(ends):
        return -1, -1, data[:ID_BYTES], b"", [], []
    last = phase + 2 * int(ends[-1])
    counts = np.diff(ends) - 1 - ID_VALUES * with_ids
    ids = _ids_at(values, ends[:-1] + 1) if with_ids else [None] * len(counts)
    tail = data[last + 2 : last + 2 + ID_BYTES]
    return phase + 2 * int(ends[0]), last, data[:ID_BYTES], tail, ids, counts.tolist()


def _scan(with_ids: bool):
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def rows(key: tuple, parts: list[bytes]) -> pd.DataFrame:
        data = b"\n".join(parts) + b"\n"
        out = [(*key, phase, len(data), *scan_block(data, phase, with_ids)) for phase in (0, 1)]
        return pd.DataFrame(out, columns=names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, parts = None, []
        for batch in batches:
            new = batch[["file", "block"]].ne(batch[["file", "block"]].shift()).any(axis=1).to_numpy()
            edges = [*np.flatnonzero(new).tolist(), len(batch)]
            lines = batch["line"].tolist()
            for a, b in zip(edges, edges[1:]):
                own = tuple(batch[c].iloc[a] for c in ("file", "block", "size", "file_size"))
                if key is not None and own != key:
                    yield rows(key, parts)
                    parts = []
                key = own
                parts.extend(lines[a:b])
        if key is not None:
            yield rows(key, parts)

    return run


def _header(column):
    """The id in ten bytes; null where a part is missing."""
    value = F.lit(0).cast("long")
    for k in range(ID_VALUES):
        low = F.conv(F.hex(F.substring(column, 2 * k + 1, 1)), 16, 10).cast("long")
        high = F.conv(F.hex(F.substring(column, 2 * k + 2, 1)), 16, 10).cast("long")
        own = (F.shiftleft(high, 8) + low).bitwiseAND(F.lit(0x7FFF))
        value = value.bitwiseOR(F.shiftleft(own, 15 * k))
    none = column == F.lit(b"\xff" * ID_BYTES)
    return F.when((F.octet_length(column) == ID_BYTES) & ~none, value)


def _joined(parts):
    return F.unhex(F.concat_ws("", F.transform(parts, lambda p: F.hex(p))))


def count_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the token files under ``path``.

    Columns ``doc_id`` (null without ids), ``n_tokens``, ``file``, ``number`` (of the document in
    its file, from 0) and ``ended`` (false for what follows a file's last separator). Two
    separators side by side enclose a document without tokens; an empty file has none. Only
    one block is held at a time.
    """
    bounded_batches(spark, 10_000)
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_block_length").alias("size"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    blocks = saved(lines.mapInPandas(_scan(with_ids), BLOCKS), "separator-blocks")
    head = ID_VALUES if with_ids else 0
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # the alignment follows from the bytes in front; both rows of a block have the same size
    placed = (
        blocks.where("phase = 0")
        .select("file", "block", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).alias("at"))
        .withColumn("phase", (F.col("at") % 2).cast("int"))
    )
    stitched = (
        blocks.join(placed, ["file", "block", "phase"])
        .withColumn("next_heads", _joined(F.collect_list("head").over(in_file.rowsBetween(1, ID_BYTES))))
        .withColumns(
            {
                "found": F.col("first") >= 0,
                # a header may go on in the next blocks, each of which has a byte at least
                "after": F.concat("tail", "next_heads"),
                "rest": F.concat("head", "next_heads"),
            }
        )
        .withColumns(
            {
                "open_at": F.coalesce(
                    F.max(F.when(F.col("found"), F.col("at") + F.col("last") + 2)).over(before), F.lit(0)
                ),
                "open_head": F.last(F.when(F.col("found"), F.col("after")), True).over(before),
                "ends_before": F.coalesce(F.sum(F.when(F.col("found"), F.size("ids") + 1)).over(before), F.lit(0)),
                "is_last": F.lead("block").over(in_file).isNull(),
            }
        )
        .withColumn("start_head", F.first("rest").over(in_file.rowsBetween(Window.unboundedPreceding, 0)))
    )
    crossing = stitched.where("found").select(
        "file",
        F.col("ends_before").alias("number"),
        F.substring(F.coalesce("open_head", "start_head"), 1, ID_BYTES).alias("head"),
        ((F.col("at") + F.col("first") - F.col("open_at")) / 2 - head).cast("long").alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    tail_at = F.when(F.col("found"), F.col("at") + F.col("last") + 2).otherwise(F.col("open_at"))
    tail_head = F.when(F.col("found"), F.col("after")).otherwise(F.coalesce("open_head", "start_head"))
    unended = (
        stitched.where("is_last")
        .withColumn("left_over", F.col("file_size") - tail_at)
        .where("left_over > 0")
        .select(
            "file",
            (F.col("ends_before") + F.expr("if(found, size(ids) + 1, 0)")).alias("number"),
            F.substring(tail_head, 1, ID_BYTES).alias("head"),
            (F.floor(F.col("left_over") / 2) - head).alias("n_tokens"),
            F.lit(False).alias("ended"),
        )
    )
    edges = crossing.unionByName(unended).select(
        (_header(F.col("head")) if with_ids else F.lit(None).cast("long")).alias("doc_id"),
        "n_tokens", "file", "number", "ended",
    )
    inner = stitched.where(F.size("ids") > 0).select(
        "file", "ends_before", F.posexplode(F.arrays_zip("ids", "counts")).alias("i", "document")
    )
    inner = inner.select(
        F.col("document.ids").alias("doc_id"),
        F.col("document.counts").alias("n_tokens"),
        "file",
        (F.col("ends_before") + 1 + F.col("i")).alias("number"),
        F.lit(True).alias("ended"),
    )
    return inner.unionByName(edges)


def document_token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes token files of the documents to the scratch folder and counts by scanning them.

    A null or empty text has 0 tokens; a null id stays null; repeated rows get a row each; an
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    path = write_token_files(docs, scratch_path(spark, "token-files"), vocabulary)
    return count_tokens(spark, path)
