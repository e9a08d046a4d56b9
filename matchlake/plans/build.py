"""The build: bronze, dimension, silver, mart, tests, and models of the user's own."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from matchlake.operators.quality import (
    MART_CHECKS,
    SILVER_CHECKS,
    Check,
    QualityError,
    Watch,
    gate,
    run_suite,
)
from matchlake.plans.mart import build_mart
from matchlake.plans.models import Model, Step, make_models, sorter
from matchlake.plans.staging import publish_view
from matchlake.session import compiled_methods
from matchlake.sources.leagues import leagues, read_seed_csv
from matchlake.sources.matches_csv import read_matches_csv
from matchlake.sources.tables import Namespaces, current, publish, read_mart, write_mart, write_table

LOG = logging.getLogger(__name__)
BRONZE_TABLE, SEED_TABLE = "raw_matches", "leagues"
SILVER_VIEW, MART_TABLE = "stg_matches", "fct_european_matches"
REPORT_TABLE = "test_report"


@dataclass(frozen=True)
class BuildConfig:
    matches_csv: str | list[str]
    leagues_csv: str | None = None  # the built-in dimension when unset
    namespaces: Namespaces = field(default_factory=Namespaces)
    allow_quoted_newlines: bool = True
    stop_on_failed_tests: bool = True
    models: tuple[Model, ...] = ()  # further models, which may read the ones below
    sources: Mapping[str, str] = field(default_factory=dict)  # tables of others that they read


def build_silver(spark: SparkSession, cfg: BuildConfig) -> None:
    ns = cfg.namespaces
    publish_view(
        spark,
        ns.table("staging", SILVER_VIEW),
        ns.table("raw", BRONZE_TABLE),
        ns.table("raw", SEED_TABLE),
    )


def build_models(cfg: BuildConfig) -> list[Model]:
    """The layers with what they read, and the models of the configuration."""

    def bronze(step: Step) -> None:
        # All 48 columns are parsed here, once: a pruned CSV scan would not notice a bad
        # value in a column it skips.
        rows = read_matches_csv(step.spark, cfg.matches_csv, cfg.allow_quoted_newlines)
        write_table(rows, step.table, step.path)

    def seed(step: Step) -> None:
        given = cfg.leagues_csv
        rows = read_seed_csv(step.spark, given) if given else leagues(step.spark)
        write_table(rows, step.table, step.path)

    def silver(step: Step) -> None:
        publish_view(step.spark, step.table, step.ref(BRONZE_TABLE), step.ref(SEED_TABLE))

    def gold(step: Step) -> dict[Check, int]:
        """Failures of the tests that were decided while the mart was written."""
        watch = Watch(MART_CHECKS)
        write_mart(build_mart(step.spark.table(step.ref(SILVER_VIEW))), step.table, step.path, watch)
        # the count reads file footers only
        return watch.failures(step.spark.table(step.table).count())

    def report(step: Step) -> None:
        tested = _report(
            step.spark, step.ref(SILVER_VIEW), step.ref(SEED_TABLE), step.ref(MART_TABLE), step.result(MART_TABLE)
        )
        publish(tested.coalesce(1), step.table, step.path)  # 21 rows

    return [
        Model(BRONZE_TABLE, "raw", bronze),
        Model(SEED_TABLE, "raw", seed),
        Model(SILVER_VIEW, "staging", silver, (BRONZE_TABLE, SEED_TABLE)),
        Model(MART_TABLE, "mart", gold, (SILVER_VIEW,)),
        Model(REPORT_TABLE, "mart", report, (SILVER_VIEW, SEED_TABLE, MART_TABLE)),
        *cfg.models,
    ]


def open_layers(spark: SparkSession, cfg: BuildConfig) -> None:
    """Reach what an earlier session built under the same root."""
    ns = cfg.namespaces
    ns.create(spark)
    for layer, name in (("raw", BRONZE_TABLE), ("raw", SEED_TABLE), ("mart", MART_TABLE)):
        ns.attach(spark, layer, name)
    if ns.root and current(spark, ns.path("mart", REPORT_TABLE)):
        ns.attach(spark, "mart", REPORT_TABLE)
    build_silver(spark, cfg)


def _report(
    spark: SparkSession, silver: str, seed: str, mart: str, known: Mapping[Check, int] | None
) -> DataFrame:
    return run_suite(
        spark.table(silver), SILVER_VIEW, SILVER_CHECKS, {"leagues": spark.table(seed)}
    ).unionByName(run_suite(read_mart(spark, mart), MART_TABLE, MART_CHECKS, known=known))


def quality_report(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """All 21 tests over the published view and table."""
    ns = cfg.namespaces
    names = ("staging", SILVER_VIEW), ("raw", SEED_TABLE), ("mart", MART_TABLE)
    return _report(spark, *(ns.table(*name) for name in names), None)


def last_report(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """The tests' results as the last build published them."""
    return spark.table(cfg.namespaces.table("mart", REPORT_TABLE))


def run_build(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """Build every layer in the order of what it reads, then run all tests on what was
    published, and publish their results. Returns the mart.

    With ``stop_on_failed_tests`` a failure raises; without, it is logged.
    """
    models = build_models(cfg)
    sorter(models, cfg.sources)  # nothing is created for models that do not fit together
    compiled_methods(spark)
    cfg.namespaces.create(spark)
    make_models(spark, cfg.namespaces, models, cfg.sources)
    try:
        gate(last_report(spark, cfg))
    except QualityError as failed:
        if cfg.stop_on_failed_tests:
            raise
        LOG.warning("%s", failed)
    return read_mart(spark, cfg.namespaces.table("mart", MART_TABLE))
