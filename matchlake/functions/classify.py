"""Row classifications of the mart, as plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def result_label(code: Column) -> Column:
    return (
        F.when(code == "H", "Home Win")
        .when(code == "A", "Away Win")
        .when(code == "D", "Draw")
        .otherwise("Unknown")
    )


def goal_timing(half_time: Column, full_time: Column) -> Column:
    """``half_time`` and ``full_time`` are goal totals; a missing half-time side makes
    the half-time total NULL, which decides before anything else. The order is that of the
    data model's definition."""
    return (
        F.when(half_time.isNull(), "Data Unavailable")
        .when((half_time > 0) & (half_time == full_time), "All Goals in First Half")
        .when((half_time == 0) & (full_time > 0), "All Goals in Second Half")
        .when(full_time == 0, "No Goals")
        .otherwise("Goals in Both Halves")
    )


def scoring_category(total: Column) -> Column:
    """Bands by upper bound: 0, 2, 4, and everything else (a NULL total included)."""
    return (
        F.when(total == 0, "Goalless")
        .when(total <= 2, "Low Scoring")
        .when(total <= 4, "Normal")
        .otherwise("High Scoring")
    )
