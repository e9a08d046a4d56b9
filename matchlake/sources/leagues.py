"""The league dimension."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from matchlake.schemas import LEAGUE_SCHEMA, LEAGUES


def leagues(spark: SparkSession) -> DataFrame:
    """The built-in 38 rows. Built from Arrow, so Catalyst knows their exact size and
    picks the join strategy by it; there is no broadcast hint anywhere."""
    columns = list(zip(*LEAGUES))
    names = LEAGUE_SCHEMA.fieldNames()
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns)))), LEAGUE_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A seed file with a header: UTF-8, every column declared as string."""
    return (
        spark.read.schema(LEAGUE_SCHEMA)
        .options(header="true", quote='"', escape='"', mode="FAILFAST", encoding="UTF-8")
        .csv(path)
    )
