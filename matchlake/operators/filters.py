"""Row filters of the silver and mart steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.schemas import MART_DIVISIONS, REQUIRED_CAST, REQUIRED_RAW


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where no listed column is NULL. Unlike ``dropna``, whose counting predicate
    stays above the scan, these conditions reach Parquet."""
    return df.where(" AND ".join(f"{column} IS NOT NULL" for column in columns))


def required_raw(raw: DataFrame) -> DataFrame:
    """Rows whose date text and team names are present, whatever the text is."""
    return present(raw, REQUIRED_RAW)


def mart_divisions(matches: DataFrame, column: str = "division") -> DataFrame:
    return matches.where(F.col(column).isin(MART_DIVISIONS))


def required_cast(staged: DataFrame) -> DataFrame:
    """Rows whose date and full-time goals survived the cast."""
    return present(staged, REQUIRED_CAST)
