"""Mart: classified matches of the ten selected leagues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.classify import goal_timing, result_label, scoring_category
from matchlake.operators.filters import mart_divisions, required_cast
from matchlake.schemas import MART_COLUMNS


def classified(matches: DataFrame) -> DataFrame:
    home, away = F.col("home_goals_ft"), F.col("away_goals_ft")
    half_time = F.col("home_goals_ht") + F.col("away_goals_ht")
    full_time = F.col("total_goals")
    return matches.withColumn("total_goals", home + away).withColumns(
        {
            "match_result_label": result_label(F.col("full_time_result")),
            "goal_difference": F.abs(home - away),
            "goal_timing": goal_timing(half_time, full_time),
            "scoring_category": scoring_category(full_time),
        }
    )


def build_mart(silver: DataFrame) -> DataFrame:
    return (
        silver.transform(mart_divisions)
        .transform(required_cast)
        .transform(classified)
        .select(*MART_COLUMNS)
    )
