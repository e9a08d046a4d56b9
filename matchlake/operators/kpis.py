"""The seven dashboard aggregations over the mart.

Each is a partial aggregate per task and one small shuffle of the groups. Shares are
taken over the grouped result, whose size is bounded by the labels and leagues.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def total_matches(mart: DataFrame) -> DataFrame:
    return mart.agg(F.count("*").alias("total_matches"))


def avg_goals(mart: DataFrame) -> DataFrame:
    return mart.agg(F.avg("total_goals").alias("avg_goals"))


def matches_by_league(mart: DataFrame) -> DataFrame:
    return mart.groupBy("league_name").agg(F.count("*").alias("matches"))


def avg_goals_by_year(mart: DataFrame) -> DataFrame:
    return mart.groupBy("match_year").agg(F.avg("total_goals").alias("avg_goals"))


def outcome_distribution(mart: DataFrame) -> DataFrame:
    counts = mart.groupBy("match_result_label").agg(F.count("*").alias("matches"))
    return counts.withColumn("share", F.col("matches") / F.sum("matches").over(Window.partitionBy()))


def scoring_share_by_league(mart: DataFrame) -> DataFrame:
    counts = mart.groupBy("league_name", "scoring_category").agg(F.count("*").alias("matches"))
    league = Window.partitionBy("league_name")
    return counts.withColumn("share", F.col("matches") / F.sum("matches").over(league))


def high_scoring_by_league(mart: DataFrame) -> DataFrame:
    return (
        mart.where(F.col("scoring_category") == "High Scoring")
        .groupBy("league_name")
        .agg(F.count("*").alias("high_scoring"))
    )


KPIS = {
    "kpi_total_matches": total_matches,
    "kpi_avg_goals": avg_goals,
    "kpi_matches_by_league": matches_by_league,
    "kpi_avg_goals_by_year": avg_goals_by_year,
    "kpi_outcome_distribution": outcome_distribution,
    "kpi_scoring_share_by_league": scoring_share_by_league,
    "kpi_high_scoring_by_league": high_scoring_by_league,
}
