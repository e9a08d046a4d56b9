"""Tests decided while the mart is written."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchlake.operators import quality
from matchlake.operators.quality import MART_CHECKS, Check, Watch, run_suite
from matchlake.plans.build import BuildConfig, last_report, quality_report, run_build
from matchlake.session import scratch_path
from matchlake.sources import tables

SF = "/root/testdata/sf0.001"


def rows_of(report):
    return {(r.model, r.column_name, r.test): r.failures for r in report.collect()}


def written(spark, mart, label):
    watch, name = Watch(MART_CHECKS), f"default.{label}"
    tables.write_mart(mart, name, scratch_path(spark, label), watch)
    return watch, tables.read_mart(spark, name)


def test_observed_failures_equal_a_scan(spark):
    mart = entry.mart(spark, SF).withColumns(
        {
            "league_name": F.when(F.col("home_goals_ft") > 1, F.col("league_name")),
            "goal_timing": F.when(F.col("away_goals_ft") > 1, F.lit("Other")).otherwise(F.col("goal_timing")),
        }
    )
    watch, stored = written(spark, mart, "watched")
    known = watch.failures(stored.count())
    by_scan = rows_of(run_suite(stored, "m", MART_CHECKS))
    assert rows_of(run_suite(stored, "m", MART_CHECKS, known=known)) == by_scan
    left = {(c.column, c.test) for c in MART_CHECKS if c not in known}
    assert left == {("match_id", "unique"), ("goal_timing", "accepted_values")}
    assert by_scan["m", "league_name", "not_null"] > 0 == by_scan["m", "match_id", "not_null"]
    assert by_scan["m", "goal_timing", "accepted_values"] == 1


def test_what_is_left_reads_its_columns_only(spark):
    watch, stored = written(spark, entry.mart(spark, SF), "narrow")
    report = run_suite(stored, "m", MART_CHECKS, known=watch.failures(stored.count()))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.split("ReadSchema: struct<")[1].split(">")[0] == "match_id:string"


def test_other_rows_than_counted_are_scanned(spark):
    watch, stored = written(spark, entry.mart(spark, SF), "recount")
    assert watch.failures(stored.count() + 1) == {}


def test_all_known_and_an_empty_mart(spark):
    watch, stored = written(spark, entry.mart(spark, SF).limit(0), "none")
    assert watch.failures(0) == {c: 0 for c in MART_CHECKS if c.test != "unique"}
    checks = [Check("match_id", "not_null")]
    assert rows_of(run_suite(stored, "m", checks, known={checks[0]: 3})) == {("m", "match_id", "not_null"): 3}


def test_rows_are_watched_after_the_last_shuffle(spark):
    """Where each partition is counted once, however often earlier stages run."""
    plan = tables.lay_out_mart(entry.mart(spark, SF), Watch(MART_CHECKS))._jdf.queryExecution().optimizedPlan()
    lines = [line for line in plan.toString().splitlines()]
    order = [i for word in ("Sort ", "CollectMetrics", "RebalancePartitions") for i, x in enumerate(lines) if word in x][:3]
    assert order == sorted(order) and len(order) == 3


def test_the_build_publishes_its_report(spark, monkeypatch):
    root = scratch_path(spark, "reported")
    names = tables.Namespaces(raw="rep_raw", staging="rep_staging", mart="rep_mart", root=root)
    cfg = BuildConfig(f"{root}/landed", namespaces=names, stop_on_failed_tests=False)
    entry.land_csv(entry.matches(spark, SF), cfg.matches_csv)
    run_build(spark, cfg)
    assert rows_of(last_report(spark, cfg)) == rows_of(quality_report(spark, cfg))
    assert last_report(spark, cfg).count() == len(quality.SILVER_CHECKS) + len(MART_CHECKS) == 21
