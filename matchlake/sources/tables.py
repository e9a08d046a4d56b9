"""Namespaces and stored tables.

A rebuild writes a new version into a folder of its own, records it as published and switches
the name over in one catalog operation: the name is a view of one version's files. So a name
always reads whole, old or new, and a running query keeps the version it began with. Versions
that are no longer current are removed after a grace period.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.schemas import MART_COLUMNS

GRACE_SECONDS = 24 * 3600.0  # how long a query may go on reading a version that was replaced
CALENDAR = "_calendar"  # within a version of the mart; hidden, so no part of its rows
BY_DATE = "_by_date"  # ending of the name that filters on the date alone prune
# Keys look the same in every file, so no statistics skip by them. Divisions and leagues have
# dictionaries, which skip row groups without a filter of their own.
MART_OPTIONS = {
    "parquet.bloom.filter.enabled#match_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",  # as small as a row group's keys allow
}
PUBLISHED = "_published"  # folder of markers, one for each publication, named by its time


def route_namespace(custom: str | None, default: str) -> str:
    """A layer's own namespace, used as written but trimmed; else the default one."""
    return default if custom is None else custom.strip()


@dataclass(frozen=True)
class Namespaces:
    """Database per layer. ``root`` is where tables live; without it the catalog decides."""

    default: str = "default"
    raw: str | None = "matchlake_raw"
    staging: str | None = "matchlake_staging"
    mart: str | None = "matchlake_mart"
    root: str | None = None

    def database(self, layer: str) -> str:
        return route_namespace(getattr(self, layer), self.default)

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def path(self, layer: str, name: str) -> str | None:
        return f"{self.root}/{self.database(layer)}/{name}" if self.root else None

    def create(self, spark: SparkSession) -> None:
        for layer in ("raw", "staging", "mart"):
            database = self.database(layer)
            place = f" LOCATION '{self.root}/{database}'" if self.root else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")

    def attach(self, spark: SparkSession, layer: str, name: str) -> None:
        """Point a name at what was last published under ``root``, for a catalog that does not
        remember it or was not reached any more."""
        table, path = self.table(layer, name), self.path(layer, name)
        if path:
            version = current(spark, path)
            if version is None:
                raise FileNotFoundError(f"no published version of {table} under {path}")
            point(spark, table, files_of(version))
            if _names(spark, f"{version}/{CALENDAR}"):
                point(spark, table + BY_DATE, rows_by_date(version))


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


def publications(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Time (ns) and version folder of every publication still on record, the last one last."""
    marks = [n.split(".", 1) for n in _names(spark, f"{path}/{PUBLISHED}")]
    return [(int(at), f"{path}/{version}") for at, version in marks]


def current(spark: SparkSession, path: str) -> str | None:
    """The version folder that was published last."""
    found = publications(spark, path)
    return found[-1][1] if found else None


def _record(spark: SparkSession, path: str, version: str) -> str:
    """Mark a version as published; making an empty file is one operation in any store."""
    mark = f"{path}/{PUBLISHED}/{time.time_ns():020d}.{version.rsplit('/', 1)[1]}"
    files, place = _folder(spark, mark)
    files.create(place, False).close()
    return mark


def files_of(version: str) -> str:
    place = version.replace("`", "``")
    return f"SELECT * FROM parquet.`{place}`"


def point(spark: SparkSession, name: str, query: str) -> None:
    """Make a view of the query. A view that exists is altered, which is one catalog operation
    (to replace it would drop it first)."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE VIEW {name} AS {query}")
    elif spark.catalog.getTable(name).tableType == "VIEW":
        spark.sql(f"ALTER VIEW {name} AS {query}")
    else:  # a table of the same name; its own files stay where they are
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE VIEW {name} AS {query}")


def _write_version(
    df: DataFrame, version: str, partition_by: Sequence[str], options: Mapping[str, str]
) -> None:
    writer = df.write.options(**options)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.parquet(version)
    if partition_by and not any("=" in n for n in _names(df.sparkSession, version)):
        # no rows, so no partition and no file that tells the columns
        df.limit(0).write.mode("append").parquet(version)


def _clear(spark: SparkSession, path: str, grace: float) -> None:
    """Remove versions replaced longer ago than the grace period, and as old ones never published."""
    found = publications(spark, path)
    limit = time.time_ns() - int(grace * 1e9)
    # a publication was replaced when the next one was made
    kept = {found[-1][1]} | {v for (_, v), (until, _) in zip(found, found[1:]) if until > limit}
    for name in _names(spark, path):
        if name.startswith("v-") and f"{path}/{name}" not in kept and int(name.split("-")[1]) <= limit:
            _remove(spark, f"{path}/{name}")
    for at, version in found[:-1]:
        if version not in kept:
            _remove(spark, f"{path}/{PUBLISHED}/{at:020d}.{version.rsplit('/', 1)[1]}")


def publish(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    grace: float = GRACE_SECONDS,
    options: Mapping[str, str] | None = None,
    beside: Callable[[str], None] | None = None,
    views: Mapping[str, Callable[[str], str]] | None = None,
) -> None:
    """Full rebuild of a Parquet table: write a new version, record it, switch the name over.

    ``options`` go to the writer. ``beside`` adds to the version what is not its rows, before it
    is recorded. ``views`` are further names over the version, with their queries; each is
    switched in one operation too, after the name. Without a path the versions lie in the database's folder. A build that ends before the
    record is made leaves the old rows; one that ends after it leaves the old rows under a name
    that knows them, and the new ones wherever the folder is attached. ``grace`` is in seconds.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = path or f"{home}/{table}"
    version = f"{path}/v-{time.time_ns():020d}-{uuid.uuid4().hex}"
    try:
        _write_version(df, version, partition_by, options or {})
        if beside:
            beside(version)
    except Exception:
        _remove(spark, version)
        raise
    mark = _record(spark, path, version)
    try:
        point(spark, name, files_of(version))
    except Exception:
        _remove(spark, mark)
        _remove(spark, version)
        raise
    for view, query in (views or {}).items():
        point(spark, view, query(version))
    _clear(spark, path, grace)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    publish(df, name, path)


def lay_out_mart(mart: DataFrame, watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Distribute by year and division, order files by year, division and league.

    ``rebalance`` lets the adaptive planner split a year or division that outgrows
    one task and merge small ones. The year leads the sort because a partitioned
    write would otherwise sort again by year and lose the rest of the order.
    """
    order = ["match_year", "division", "league_name"]
    spread = mart.hint("rebalance", F.col("match_year"), F.col("division"))
    # after the shuffle, in the stage that writes, and before the sort that the writer relies on
    return (watch(spread) if watch else spread).sortWithinPartitions(*order)


def write_mart(
    mart: DataFrame,
    name: str,
    path: str | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Publish the mart, and by date; ``watch`` sees its rows as they are written."""
    publish(
        lay_out_mart(mart, watch),
        name,
        path,
        ["match_year"],
        options=MART_OPTIONS,
        beside=lambda version: _write_calendar(mart.sparkSession, version),
        views={name + BY_DATE: rows_by_date},
    )


def _write_calendar(spark: SparkSession, version: str) -> None:
    """The dates of a version's rows with their years: a row a day, whatever the rows."""
    rows = spark.read.parquet(version).groupBy("match_date", "match_year").count()
    rows.drop("count").coalesce(1).write.parquet(f"{version}/{CALENDAR}")


def rows_by_date(version: str) -> str:
    """The rows of a version, each joined to its day in the calendar of the same version.

    A filter on the date reaches the calendar through the join, and what is left of the
    calendar prunes the year folders when the query runs. The calendar is made from the rows
    themselves, so only rows without a date are left out, and the mart has none.
    """
    place = version.replace("`", "``")
    return f"""
        SELECT m.* FROM parquet.`{place}` m
        JOIN parquet.`{place}/{CALENDAR}` c ON m.match_date = c.match_date AND m.match_year = c.match_year
        """


def as_mart(df: DataFrame) -> DataFrame:
    """Stored mart back in declared order; a partition column reads back last and as int."""
    return df.select(
        *[F.col(c).cast("bigint").alias(c) if c == "match_year" else F.col(c) for c in MART_COLUMNS]
    )


def read_mart(spark: SparkSession, name: str) -> DataFrame:
    return as_mart(spark.table(name))


def match_date_between(mart: DataFrame, low: str | date, high: str | date) -> DataFrame:
    """Rows of an inclusive date range (dates or yyyy-mm-dd text). The year bounds follow from the dates and are what
    prunes the year folders; a date filter alone would open every file."""
    first, last = date.fromisoformat(str(low)), date.fromisoformat(str(high))
    return mart.where(
        F.col("match_date").between(first, last)
        & F.col("match_year").between(first.year, last.year)
    )
