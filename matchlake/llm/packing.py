"""Sum-of-squares packing of tokenised documents into fixed windows.

Windows that are open (partly filled) are counted by fill level in an array. A document goes
to the level, or to a new window, for which the sum of the squared counts over all partly
filled levels is least; on a tie to the fullest window. A document longer than a window is cut
into full windows and a rest, which is then placed.

Every partition of the input packs on its own, in one pass, without a shuffle. What is still
open at its end is closed by cutting: pieces move from the emptiest open windows into the
fullest, until one window is left, which is cut at powers of two (sequences of these lengths
need no padding). So no sequence is padded, and only the last open windows of a partition hold
documents that were cut for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches
from matchlake.llm.tokens import END_ID, WordIds, vocabulary_path

WINDOW = 4096
PIECES = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)
PARTITION_SHIFT = 33


class Levels:
    """Numbers of open windows by fill level, and the windows themselves."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def place(self, size: int) -> list | None:
        """The open window that a piece of ``size`` goes to, or None for a new one."""
        to = self.counts[size : self.window + 1]  # counts at the level reached, from 0 up
        since = self.counts[: len(to)]
        # change of the sum of squares: level h loses a window, level h + size gains one
        change = 2 * (to - since) + 2
        change[0] = 2 * to[0] + 1  # a new window
        change[-1] = 1 - 2 * since[-1]  # fills the window, which is then no longer counted
        if size == self.window:
            return None
        change[1:][since[1:] == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(np.argmin(change[::-1]))
        if level == 0:
            return None
        self.counts[level] -= 1
        return self.open[level].pop()

    def put(self, pieces: list, level: int) -> None:
        self.counts[level] += 1
        self.open.setdefault(level, []).append(pieces)

    def drain(self) -> list[list]:
        """All open windows, the fullest first."""
        return [w for level in sorted(self.open, reverse=True) for w in self.open[level]]


def _size(pieces: list) -> int:
    return sum(len(p[2]) for p in pieces) // 4


def _cut(piece: tuple, ids: int) -> tuple[tuple, tuple]:
    doc_id, start, raw, total = piece
    return (doc_id, start, raw[: 4 * ids], total), (doc_id, start + ids, raw[4 * ids :], total)


def _take(pieces: list, ids: int) -> list:
    """Remove ``ids`` ids from the end of a window's pieces, cutting the last one needed."""
    taken = []
    while ids:
        piece = pieces.pop()
        own = len(piece[2]) // 4
        if own > ids:
            left, piece = _cut(piece, own - ids)
            pieces.append(left)
            own = ids
        taken.append(piece)
        ids -= own
    return taken


def close(windows: list[list], window: int) -> Iterator[list]:
    """Full windows from partly filled ones, then sequences whose lengths are powers of two."""
    windows = [list(w) for w in windows]
    while len(windows) > 1:
        target, source = windows[0], windows[-1]
        target.extend(_take(source, min(window - _size(target), _size(source))))
        if not source:
            windows.pop()
        if _size(target) == window:
            yield windows.pop(0)
    for rest in windows:
        while size := _size(rest):
            yield _take(rest, 1 << (size.bit_length() - 1))


def pack_partition(
    documents: Iterator[tuple[int | None, bytes]], window: int
) -> Iterator[list[tuple]]:
    """Sequences, each a list of pieces ``(doc_id, start, raw ids, doc_tokens)``."""
    levels = Levels(window)
    for doc_id, raw in documents:
        total = len(raw) // 4
        rest = (doc_id, 0, raw, total)
        while len(rest[2]) >= 4 * window:
            full, rest = _cut(rest, window)
            yield [full]
        size = len(rest[2]) // 4
        if not size:
            continue
        pieces = levels.place(size) or []
        pieces.append(rest)
        level = _size(pieces)
        if level == window:
            yield pieces
        else:
            levels.put(pieces, level)
    yield from close(levels.drain(), window)


def pack(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, window: int = WINDOW
) -> DataFrame:
    """One row per piece of a document.

    Columns ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``
    and ``sequence_length``. A null or empty text is its end id alone; repeated rows are packed
    each; a null id stays null; an empty table gives no rows. Other columns are ignored.

    A sequence id is the partition's number and a count within it. A retried task reads its
    input in the same order and so repeats its rows.
    """
    bounded_batches(docs.sparkSession)
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << PARTITION_SHIFT
        ids = WordIds(path)
        end = np.array([end_id], "<u4").tobytes()

        def documents():
            for batch in batches:
                for doc_id, raw in zip(batch["doc_id"], ids.raws(batch["text"].tolist())):
                    yield None if pd.isna(doc_id) else int(doc_id), raw + end

        rows = []
        for number, pieces in enumerate(pack_partition(documents(), window)):
            offset, length = 0, _size(pieces)
            for doc_id, start, raw, total in pieces:
                own = len(raw) // 4
                rows.append(
                    (doc_id, start, own, raw, zlib.crc32(raw), total, base + number, offset, length)
                )
                offset += own
            if len(rows) >= 2000:
                yield _frame(rows)
                rows = []
        if rows:
            yield _frame(rows)

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInPandas(run, PIECES)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
    return frame.astype({"doc_id": "Int64"})
