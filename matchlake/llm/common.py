"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read from there.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of rows that were ``saved``, once nothing reads them any more."""
    jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def fold(doc_id: Column, modulus: int) -> Column:
    """Remainder of crc32 over the decimal text of an id; 0 for a null id."""
    crc = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(crc % modulus, F.lit(0)).cast("int")


def text_key(text: Column) -> Column:
    """64-bit hash of a text; with the document's id it names a row of the input. Rows that
    share both are the same document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def filled_id(doc_id: Column) -> Column:
    """The id as a join key; null ids get the largest long."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer where ``df`` has such a column, so that none of its own is lost."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def keyed(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with the filled id and the hash of the text under these names."""
    return docs.withColumns(dict(zip(names, (filled_id(F.col("doc_id")), text_key(F.col("text"))))))


def drawn(order: Column, share: Column) -> Column:
    """Whether a 64-bit hash is within a share of its range: a draw that a few rows pass."""
    return F.pmod(order, F.lit(1 << 31)) < share * (1 << 31)


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hand Python tasks smaller batches of long texts than Spark's 10,000 rows.

    A session setting (Spark has no other place for it) that is only ever lowered.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def bounded_reads(spark: SparkSession, rows: int) -> None:
    """Read Parquet with long texts in smaller batches than Spark's 4,096 rows, whose bytes a
    task holds in one array; set as for ``bounded_batches``.
    """
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)
