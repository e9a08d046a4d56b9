"""Silver: cast, keyed and league-enriched match rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from matchlake.functions.casts import CAST_BY_KIND, match_year, surrogate_key
from matchlake.schemas import KEY_COLUMNS, REQUIRED_RAW, STAGED
from matchlake.sources.tables import point

# Staged column -> SQL expression over the bronze columns.
STAGED_SQL = {
    "match_id": surrogate_key(KEY_COLUMNS, doubles=("FTHome", "FTAway")),
    **{staged: CAST_BY_KIND[kind](raw) for raw, staged, kind in STAGED},
}


def cast_columns(raw: DataFrame, *names: str, keep: Sequence[str] = ()) -> DataFrame:
    """Staged columns from bronze rows: all of them unless some are named. ``keep`` lists
    raw columns to carry along."""
    return raw.selectExpr(*keep, *[f"{STAGED_SQL[n]} AS {n}" for n in names or STAGED_SQL])


def silver_sql(raw: str, leagues: str) -> str:
    """The silver model as a statement over two relations, for SQL users and for ``stage``."""
    staged = ",\n  ".join(f"{sql} AS {name}" for name, sql in STAGED_SQL.items())
    required = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_RAW)
    return f"""
        WITH staged AS (SELECT {staged} FROM {raw} WHERE {required})
        SELECT s.*, d.country AS country, d.league_name AS league_name,
               {match_year("s.match_date")} AS match_year
        FROM staged s LEFT JOIN {leagues} d ON s.division = d.code
        """


def stage(raw: DataFrame, leagues: DataFrame) -> DataFrame:
    """The silver model over two DataFrames."""
    spark, run = raw.sparkSession, uuid.uuid4().hex
    names = [f"raw_{run}", f"leagues_{run}"]
    for name, df in zip(names, (raw, leagues)):
        df.createOrReplaceTempView(name)
    silver = spark.sql(silver_sql(*names))
    for name in names:  # the plan holds the relations, not their names
        spark.catalog.dropTempView(name)
    return silver


def publish_view(spark: SparkSession, view: str, raw_table: str, leagues_table: str) -> None:
    """The same model as a catalog view; nothing is computed until it is read."""
    point(spark, view, silver_sql(raw_table, leagues_table))
