"""Data tests: not_null, unique, accepted_values, relationships.

The single-test functions return the failing values. ``run_suite`` evaluates all
tests of a model together: each row yields the (test, value) pairs that matter, the
pairs are counted with map-side combine, and the counts decide every test. That is
one scan and one wide shuffle however many tests a model has, and a hot value
collapses to one pair per task before it is shuffled.

Counts of failing rows can also be observed while a model is written; tests that they decide
need no scan of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.filters import present
from matchlake.schemas import GOAL_TIMINGS, RESULT_CODES, RESULT_LABELS, SCORING_CATEGORIES


@dataclass(frozen=True)
class Check:
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    values: tuple[str, ...] = ()
    parent: str = ""
    field: str = ""


def _not_null(*columns: str) -> list[Check]:
    return [Check(c, "not_null") for c in columns]


SILVER_CHECKS = [
    Check("match_id", "unique"),
    *_not_null("match_id", "division"),
    Check("division", "relationships", parent="leagues", field="code"),
    *_not_null("match_date", "home_team", "away_team"),
    Check("full_time_result", "accepted_values", tuple(RESULT_CODES)),
    *_not_null("league_name"),
]

MART_CHECKS = [
    Check("match_id", "unique"),
    *_not_null("match_id", "match_date", "division", "league_name"),
    *_not_null("home_goals_ft", "away_goals_ft", "total_goals"),
    Check("match_result_label", "accepted_values", tuple(RESULT_LABELS)),
    *_not_null("goal_difference"),
    Check("goal_timing", "accepted_values", tuple(GOAL_TIMINGS)),
    Check("scoring_category", "accepted_values", tuple(SCORING_CATEGORIES)),
]


# --- single tests ---------------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) for every listed column, from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values occurring more than once, with their count; NULLs do not take part."""
    counts = present(df, columns).groupBy(*columns).agg(F.count("*").alias("occurrences"))
    return counts.where("occurrences > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list, with their count; NULL passes."""
    rejected = df.where(~F.col(column).isin(*values))  # NULL compares to NULL: not kept
    return rejected.groupBy(column).agg(F.count("*").alias("occurrences"))


def unaccepted_values(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(column_name, value, occurrences) of all values outside their lists, in one scan."""
    rejected = [
        F.when(~F.col(c.column).isin(*c.values), F.col(c.column).cast("string")).alias(c.column) for c in checks
    ]
    values = df.select(*rejected).unpivot([], [c.column for c in checks], "column_name", "value")
    counts = values.where("value IS NOT NULL").groupBy("column_name", "value")
    return counts.agg(F.count("*").alias("occurrences"))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values missing from the parent, with the number of child rows.

    Both sides shrink to distinct keys before they meet, so hot child or parent keys
    do not matter, and the join reuses the grouping's partitioning.
    """
    children = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("occurrences"))
    keys = parent.select(F.col(field).alias("parent_key")).distinct()
    return children.join(keys, F.col(column) == F.col("parent_key"), "left_anti")


# --- tests within the write -------------------------------------------------------


class Watch:
    """Counts rows, and those that fail not_null and accepted_values tests, in passing.

    Rows must pass in the stage that writes them: tasks of an earlier stage may run again after
    a lost executor and would be counted twice.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.test in ("not_null", "accepted_values")]
        self.seen = Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        failing = [
            F.col(c.column).isNull() if c.test == "not_null" else ~F.col(c.column).isin(*c.values)
            for c in self.checks
        ]
        counts = [F.count(F.when(f, 1)).alias(f"t{i}") for i, f in enumerate(failing)]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    def failures(self, stored_rows: int) -> dict[Check, int]:
        """Failures of the tests that the counts decide, once the rows are written.

        Rows that fail accepted_values say that there are failures, not how many values, so
        such a test is left to a scan. If other rows are stored than were counted, all are.
        """
        counts = self.seen.get
        if counts["rows"] != stored_rows:
            return {}
        found = {c: counts[f"t{i}"] for i, c in enumerate(self.checks)}
        return {c: n for c, n in found.items() if c.test == "not_null" or n == 0}


# --- whole suites ---------------------------------------------------------------


def _key(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        value = value + F.lit(0.0)  # one text for both zeros
    return value.cast("string")


def _pair_value(df: DataFrame, check: Check) -> Column:
    """What a row contributes to a test; NULL when it has no say in it."""
    column = F.col(check.column)
    if check.test == "not_null":
        return F.when(column.isNull(), F.lit(""))
    if check.test == "accepted_values":
        return F.when(~column.isin(*check.values), _key(df, check.column))
    return _key(df, check.column)


def run_suite(
    df: DataFrame,
    model: str,
    checks: Sequence[Check],
    parents: Mapping[str, DataFrame] | None = None,
    known: Mapping[Check, int] | None = None,
) -> DataFrame:
    """(model, column_name, test, failures), one row per check, in one scan of ``df`` that reads
    the columns of the checks whose failures are not known yet."""
    spark = df.sparkSession
    listing = _listing(spark, model, checks, known or {})
    numbered = [(f"t{i}", c) for i, c in enumerate(checks) if c not in (known or {})]
    if not numbered:
        return listing.select("model", "column_name", "test", F.col("known").alias("failures"))
    tags, checks = zip(*numbered)
    pairs = (
        df.select(*[_pair_value(df, c).alias(t) for t, c in zip(tags, checks)])
        .unpivot([], tags, "tag", "value")
        .where(F.col("value").isNotNull())
    )
    counted = pairs.groupBy("tag", "value").agg(F.count("*").alias("n"))

    related = [(t, c) for t, c in zip(tags, checks) if c.test == "relationships"]
    if related:
        known = reduce(
            DataFrame.unionByName,
            [
                (parents or {})[c.parent]
                .select(F.lit(t).alias("tag"), _key(parents[c.parent], c.field).alias("value"))
                .distinct()
                for t, c in related
            ],
        )
        counted = counted.join(known.withColumn("known", F.lit(True)), ["tag", "value"], "left")

    by_test = {kind: [t for t, c in zip(tags, checks) if c.test == kind] for kind in
               ("not_null", "unique", "accepted_values", "relationships")}
    failures = F.when(F.col("tag").isin(by_test["not_null"]), F.col("n"))
    failures = failures.when(F.col("tag").isin(by_test["unique"]), (F.col("n") > 1).cast("bigint"))
    if related:
        failures = failures.when(
            F.col("tag").isin(by_test["relationships"]), F.when(F.col("known").isNull(), F.col("n"))
        )
    failures = failures.otherwise(F.lit(1))
    found = counted.groupBy("tag").agg(F.sum(failures).alias("found"))
    return listing.join(found, "tag", "left").select(
        "model", "column_name", "test", F.coalesce("known", "found", F.lit(0)).alias("failures")
    )


def _listing(
    spark: SparkSession, model: str, checks: Sequence[Check], known: Mapping[Check, int]
) -> DataFrame:
    return spark.createDataFrame(
        pa.table(
            {
                "tag": [f"t{i}" for i in range(len(checks))],
                "model": [model] * len(checks),
                "column_name": [c.column for c in checks],
                "test": [c.test for c in checks],
                "known": pa.array([known.get(c) for c in checks], pa.int64()),
            }
        )
    )


class QualityError(RuntimeError):
    """At least one data test has failing rows."""


def gate(report: DataFrame) -> None:
    """Raise if any test failed. The report has one row per test."""
    failed = report.where("failures > 0").orderBy("model", "column_name", "test").collect()
    if failed:
        lines = [f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in failed]
        raise QualityError("data tests failed: " + "; ".join(lines))
