"""Strict CSV scan of match files.

The declared 48 columns are read by position, the first record of every file is its header,
and a record with missing, extra or unreadable fields stops the job.

A record ends at LF, CRLF or CR outside quotes; blank records are skipped. A field may hold any
of them inside quotes, where a quote is written twice. Every file is read by the same rules,
whatever stands in it; a quote that neither encloses a field nor is doubled is an error.

Spark's ``multiLine`` reader would give a whole file to one task. Here files are read as lines
(up to LF), by blocks of a fixed size. A line with an odd number of quotes opens or closes a
field that goes on in other lines. One scan adds up quotes per block, and a prefix sum over a
file's blocks tells which of them such fields touch. A second scan parses the lines of all
other blocks where they are, without a shuffle: the list of touched blocks is broadcast, which has
a row for each block (so for each task of the scan) and file at most. Only if there are touched
blocks, their lines are read again. A record that begins and ends in a block is put together by
the task that reads the block, by Arrow batches; only the lines of records that go over the end of
a block are shuffled, which are two records a block at most, beside blocks that lie in one field.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlake.schemas import BRONZE
from matchlake.session import SETTINGS

# Python tasks get this module's functions with the task, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "encoding": "UTF-8"}
# A record may cover this much of whole blocks, besides its part of the first and the last one.
MAX_RECORD_BYTES = 64 << 20
SPLITS = "spark.sql.files.minPartitionNum"
BLOCK = ["file", "block"]
NO_POS = f"{2**63 - 1}L"  # a line that no block has
# Lines of records that go over the end of a block.
CUT = "pos <= head_to OR pos >= tail_from"
# Runs of quoted parts and of other characters up to the end of the record.
RECORD = r'(?:[^"\r\n]++|"[^"]*+")++'


def read_matches_csv(
    spark: SparkSession,
    path: str | list[str],
    allow_quoted_newlines: bool = True,
    schema: StructType = BRONZE,
) -> DataFrame:
    """Rows of all match files under ``path``.

    With ``allow_quoted_newlines=False`` a field that holds a line end is malformed.
    """
    if spark.conf.get(SPLITS, None) is None:  # all scans must cut the files alike
        spark.conf.set(SPLITS, SETTINGS[SPLITS])
    lines = _lines(spark, path)
    marks = _marks(lines, allow_quoted_newlines)
    heads = marks.select(*BLOCK, "header_at", "touched")
    untouched = (
        lines.join(F.broadcast(heads), BLOCK, "left")
        .where("NOT coalesce(touched, false)")
        .select("value", F.expr("coalesce(pos = header_at, false)").alias("header"))
    )
    in_touched = lines.join(F.broadcast(marks.where("touched")), BLOCK).withColumn(
        "header", F.expr("coalesce(pos = header_at, false)")
    )
    chunks = untouched.unionByName(_whole_records(in_touched)).unionByName(_cut_records(in_touched))
    return (
        chunks.select(F.explode(_records("value", "header")).alias("value"))
        .select(F.from_csv(_well_quoted(F.col("value")), schema.toDDL(), CSV_OPTIONS).alias("row"))
        .select("row.*")
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines up to LF with their file, the block they were read in and their order there."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            "value",
            (quotes % 2).cast("long").alias("odd"),
        )
    )


def _marks(lines: DataFrame, allow_quoted_newlines: bool) -> DataFrame:
    """The blocks that hold a file's header or touch a field that goes over several lines.

    Odd lines open and close such fields in turn, so the number of odd lines before a line
    tells whether it starts inside a field, and halved it numbers the record.
    """
    odd_at = F.when(F.col("odd") == 1, F.col("pos"))
    filled_at = F.when(F.col("value").rlike(r"\S"), F.col("pos"))
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    # blocks that lie as a whole inside one field
    inside = Window.partitionBy("file", "odd_before")
    blocks = (
        lines.groupBy(*BLOCK)
        .agg(
            F.sum("odd").alias("odd_lines"),
            F.min(odd_at).alias("first_odd"),
            F.max(odd_at).alias("last_odd"),
            F.min(filled_at).alias("filled_at"),
            F.sum(F.octet_length("value") + 1).alias("size"),
        )
        .withColumns(
            {
                "odd_before": F.coalesce(F.sum("odd_lines").over(before), F.lit(0)),
                "odd_in_file": F.sum("odd_lines").over(whole),
                "first": F.min(F.when(F.col("filled_at").isNotNull(), F.struct("block", "filled_at"))).over(whole),
            }
        )
        .withColumn("covered", F.sum(F.expr("if(odd_lines = 0 AND odd_before % 2 = 1, size, 0)")).over(inside))
    )
    too_long = F.concat(
        F.lit("Malformed record: longer than the allowed bytes in "), F.col("file")
    )
    checked = F.when(F.col("odd_in_file") % 2 == 1, _error("quoted field never closed in "))
    checked = checked.when(F.col("covered") > MAX_RECORD_BYTES, F.raise_error(too_long))
    if not allow_quoted_newlines:
        checked = checked.when(F.col("odd_lines") > 0, _error("field with a line end in "))
    # up to which line the block lies in a record of the block before, and from which line in one
    # that the next block goes on with
    blocks = blocks.withColumns(
        {
            "head_to": F.expr(f"if(odd_before % 2 = 1, coalesce(first_odd, {NO_POS}), -1)"),
            "tail_from": F.expr(
                f"if((odd_before + odd_lines) % 2 = 1, coalesce(last_odd, {NO_POS}), {NO_POS})"
            ),
        }
    )
    # written so that all readers of the list need the same sums, which are then made once
    touched = F.expr(f"odd_lines > 0 OR head_to >= 0 OR tail_from < {NO_POS}")
    return blocks.select(
        *BLOCK,
        F.expr("if(first.block = block, first.filled_at, NULL)").alias("header_at"),
        "odd_before",
        "odd_lines",
        "head_to",
        "tail_from",
        checked.otherwise(touched).cast("boolean").alias("touched"),
    ).where("touched OR header_at IS NOT NULL")


def _error(text: str) -> Column:
    return F.raise_error(F.concat(F.lit("Malformed record: " + text), F.col("file")))


def _whole_records(lines: DataFrame) -> DataFrame:
    """Texts with an even number of quotes, of the records that begin and end in a block."""
    own = lines.where(f"NOT ({CUT})").selectExpr("value", "odd = 1 AS odd", "header")
    return own.mapInArrow(_glued, "value string, header boolean")


def _glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together by record, which ends with the line that makes the number of quotes even.

    The records of a block are whole, so each block has an even number of odd lines, and the
    blocks of a task need not be told apart.
    """
    held, seen = [], 0  # the batches of a record that has not ended, and the odd lines so far
    for batch in batches:
        odd_seen = seen + np.cumsum(batch["odd"].to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.flatnonzero(odd_seen % 2 == 0) + 1
        seen = int(odd_seen[-1]) % 2 if len(odd_seen) else seen
        if not len(ends):
            held.append(batch)
            continue
        cut = int(ends[-1])
        parts = [*held, batch.slice(0, cut)]
        before = sum(part.num_rows for part in held)
        held = [batch.slice(cut)] if cut < batch.num_rows else []
        values = pa.concat_arrays([part["value"] for part in parts])
        headers = pa.concat_arrays([part["header"] for part in parts])
        bounds = np.concatenate([[0], before + ends])
        texts = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [pc.binary_join(texts, pa.scalar("\n", values.type)), headers.take(pa.array(bounds[:-1]))],
            ["value", "header"],
        )
    if any(batch.num_rows for batch in held):
        raise ValueError("the lines of a block end within a record")


def _cut_records(lines: DataFrame) -> DataFrame:
    """Texts with an even number of quotes, of the records that go over the end of a block."""
    # a record is numbered by the odd lines before it in the file
    record = F.expr("if(pos <= head_to, odd_before, odd_before + odd_lines) div 2")
    return (
        lines.where(CUT)
        .groupBy("file", record.alias("record"))
        .agg(
            F.array_join(
                F.sort_array(F.collect_list(F.struct("block", "pos", "value")))["value"], "\n"
            ).alias("value"),
            F.max("header").alias("header"),
        )
        .select("value", "header")
    )


def _records(text: str, header: str) -> Column:
    """Records of a text, without blank ones and without the first if it is the header.

    Line ends that are still in the text, bare CRs outside quotes among them, are the exception.
    """
    parts = F.when(
        F.col(text).rlike("[\r\n]"), F.regexp_extract_all(text, F.lit(RECORD), F.lit(0))
    ).otherwise(F.array(text))
    filled = F.filter(parts, lambda record: record.rlike(r"\S"))
    return F.slice(filled, F.when(F.col(header), 2).otherwise(1), F.greatest(F.size(filled), F.lit(1)))


def _well_quoted(record: Column) -> Column:
    """The record, or an error if a quote neither encloses a whole field nor is doubled.

    Counting quotes finds the records only in text without such quotes, and the parser
    would drop what follows a wrong line break without a word.
    """
    undoubled = F.replace(record, F.lit('""'), F.lit(""))
    unquoted = F.regexp_replace(undoubled, r'(^|,)"[^"]*+"(?=,|\z)', "$1")
    message = F.concat(F.lit("Malformed record, stray quote: "), record)
    # most records have no quote at all, which is found out at a fraction of the cost
    plain = F.when(~F.contains(record, F.lit('"')), record)
    return plain.when(~F.contains(unquoted, F.lit('"')), record).otherwise(F.raise_error(message))
