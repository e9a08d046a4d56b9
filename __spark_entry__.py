"""Registered queries: each operator over match rows derived from ``lineitem``."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_sql as expected  # noqa: E402
from matchlake import schemas as S  # noqa: E402
from matchlake.fixtures import matches  # noqa: E402
from matchlake.functions import classify  # noqa: E402
from matchlake.operators import filters, kpis, quality  # noqa: E402
from matchlake.operators.enrich import with_league  # noqa: E402
from matchlake.plans.build import MART_TABLE, BuildConfig, last_report, run_build  # noqa: E402
from matchlake.plans.mart import build_mart  # noqa: E402
from matchlake.plans.staging import cast_columns, publish_view, stage  # noqa: E402
from matchlake.session import scratch_path  # noqa: E402
from matchlake.sources import tables  # noqa: E402
from matchlake.sources.leagues import leagues, read_seed_csv  # noqa: E402
from matchlake.sources.matches_csv import read_matches_csv  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(matches(spark, sf_dir), leagues(spark))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(silver(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    return kpis.scoring_share_by_league(mart(spark, "/root/testdata/sf0.001"))


# --- sources, sinks and the whole build ---------------------------------------------


CSV_OUT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# A compressed file is read by one task, so it is kept to about a block of text.
CSV_LZ4 = {"compression": "lz4", "maxRecordsPerFile": "250000"}


def land_csv(rows: DataFrame, path: str, **options: str) -> str:
    rows.write.mode("overwrite").options(**CSV_OUT, **options).csv(path)
    return path


def csv_scan_roundtrip(spark, sf_dir):
    path = land_csv(matches(spark, sf_dir), scratch_path(spark, "landed"))
    return read_matches_csv(spark, path)


def csv_quoted_newline(spark, sf_dir):
    rows = matches(spark, sf_dir).withColumns(
        {
            "HomeTeam": F.concat("HomeTeam", F.lit(' "'), "Division", F.lit('",\nReserves')),
            "AwayTeam": F.concat("AwayTeam", F.lit("\r\n'B'")),
            "MatchTime": F.coalesce("MatchTime", F.lit("\nlate")),
            "HTResult": F.concat("HTResult", F.lit("\r")),
        }
    )
    return read_matches_csv(spark, land_csv(rows, scratch_path(spark, "landed-quoted")))


def bronze_rebuild_idempotent(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    name = "default.bronze_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        tables.write_table(matches(spark, sf_dir), name, path)
    return spark.table(name)


def seed_leagues(spark, sf_dir):
    path = land_csv(leagues(spark), scratch_path(spark, "seed"))
    counts = silver(spark, sf_dir).groupBy("division").agg(F.count("match_id").alias("n"))
    seed = read_seed_csv(spark, path)
    return seed.join(counts, seed.code == counts.division, "left").select(
        "code", "country", "league_name", F.coalesce("n", F.lit(0)).alias("matches")
    )


def stored_mart(spark, sf_dir):
    path = scratch_path(spark, "mart")
    name = "default.mart_" + path.rsplit("-", 1)[1]
    tables.write_mart(mart(spark, sf_dir), name, path)
    return tables.read_mart(spark, name)


def mart_date_range_pruned(spark, sf_dir):
    return tables.match_date_between(stored_mart(spark, sf_dir), "1996-07-01", "1998-06-30")


def mart_date_filter_pruned(spark, sf_dir):
    """A filter on the date alone, over the published name that prunes years by it."""
    name = published(spark, sf_dir)[1] + tables.BY_DATE
    rows = spark.sql(f"SELECT * FROM {name} WHERE match_date BETWEEN '1996-07-01' AND '1998-06-30'")
    return tables.as_mart(rows)


def mart_lookup_by_key(spark, sf_dir):
    """The rows of the smallest key of every division, looked up in the stored mart."""
    stored = published_mart(spark, sf_dir)
    keys = stored.groupBy("division").agg(F.min("match_id").alias("match_id"))
    return stored.join(keys.select("match_id"), "match_id", "left_semi").select(*stored.columns)


def built(spark, sf_dir) -> BuildConfig:
    """All layers, built and tested from landed files."""
    root = scratch_path(spark, "build")
    run = root.rsplit("-", 1)[1]
    names = tables.Namespaces(
        raw=f"raw_{run}", staging=f"staging_{run}", mart=f"mart_{run}", root=root
    )
    landed = land_csv(matches(spark, sf_dir, spread=True), f"{root}/landed", **CSV_LZ4)
    # The derived rows fail some data tests on purpose; the reports show those counts.
    cfg = BuildConfig(landed, namespaces=names, stop_on_failed_tests=False)
    run_build(spark, cfg)
    return cfg


def medallion_end_to_end(spark, sf_dir):
    return tables.read_mart(spark, built(spark, sf_dir).namespaces.table("mart", MART_TABLE))


def medallion_test_report(spark, sf_dir):
    return last_report(spark, built(spark, sf_dir))


PUBLISHED: dict[tuple[str, str], tuple[str, str]] = {}


def published(spark, sf_dir) -> tuple[str, str]:
    """Names of the silver view and the mart table over ``sf_dir``, made once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in PUBLISHED:
        root = scratch_path(spark, "published")
        run = root.rsplit("-", 1)[1]
        raw, seed, view, fact = (f"default.{n}_{run}" for n in ("raw", "leagues", "stg", "fct"))
        tables.write_table(matches(spark, sf_dir, spread=True), raw, f"{root}/raw")
        tables.write_table(leagues(spark), seed, f"{root}/leagues")
        publish_view(spark, view, raw, seed)
        tables.write_mart(build_mart(spark.table(view)), fact, f"{root}/mart")
        PUBLISHED[key] = view, fact
    return PUBLISHED[key]


def silver_view(spark, sf_dir):
    return spark.table(published(spark, sf_dir)[0])


def published_mart(spark, sf_dir):
    return tables.read_mart(spark, published(spark, sf_dir)[1])


# --- casts and classifications --------------------------------------------------------


def casts_of(kind: str) -> Query:
    names = [staged for _, staged, k in S.STAGED if k == kind]
    return lambda spark, sf_dir: cast_columns(matches(spark, sf_dir), *names)


def safe_cast_date(spark, sf_dir):
    return cast_columns(matches(spark, sf_dir), "match_date", keep=["MatchDate"])


def safe_cast_date_forms(spark, sf_dir):
    """Dates written in forms that are taken (the first three) and that are not."""
    forms = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "CAST(l_shipdate AS DATE) AS day", "cast(l_orderkey % 10 AS INT) AS form"
    ).selectExpr(
        """get(array(
            date_format(day, 'yyyy-MM-dd'), date_format(day, 'yyyy-M-d'), date_format(day, 'yyyy-MM-d'),
            date_format(day, 'yyyy'), date_format(day, 'yyyy-MM'), date_format(day, 'dd/MM/yyyy'),
            concat(date_format(day, 'yyyy-MM-dd'), ' 15:00'), concat('1', date_format(day, 'yyyy-MM-dd')),
            concat(' ', date_format(day, 'yyyy-MM-dd')), concat(date_format(day, 'yyyy'), '-02-30')
        ), form) AS MatchDate"""
    )
    return cast_columns(forms, "match_date", keep=["MatchDate"])


def safe_cast_int_halves(spark, sf_dir):
    """Negative and half goals, which round away from zero."""
    goals = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "cast(l_orderkey % 21 - 10 AS DOUBLE) / 2 AS FTHome",
        "cast(l_partkey % 41 - 20 AS DOUBLE) / 4 AS FTAway",
    )
    return cast_columns(goals, "home_goals_ft", "away_goals_ft", keep=["FTHome", "FTAway"])


def surrogate_key(spark, sf_dir):
    return cast_columns(matches(spark, sf_dir), "match_id", keep=S.KEY_COLUMNS)


def abs_difference(spark, sf_dir):
    goals = silver(spark, sf_dir).select("home_goals_ft", "away_goals_ft")
    return goals.withColumn(
        "goal_difference", F.abs(F.col("home_goals_ft") - F.col("away_goals_ft"))
    )


def decode_result_label(spark, sf_dir):
    codes = silver(spark, sf_dir).select("full_time_result")
    return codes.withColumn("match_result_label", classify.result_label(F.col("full_time_result")))


def classify_goal_timing(spark, sf_dir):
    goals = ["home_goals_ht", "away_goals_ht", "home_goals_ft", "away_goals_ft"]
    half_time = F.col("home_goals_ht") + F.col("away_goals_ht")
    full_time = F.col("home_goals_ft") + F.col("away_goals_ft")
    return silver(spark, sf_dir).select(
        *goals, classify.goal_timing(half_time, full_time).alias("goal_timing")
    )


def bucket_scoring_category(spark, sf_dir):
    total = F.col("home_goals_ft") + F.col("away_goals_ft")
    return silver(spark, sf_dir).select(
        total.alias("total_goals"), classify.scoring_category(total).alias("scoring_category")
    )


# --- filters and the join ---------------------------------------------------------------


def filter_required_cast(spark, sf_dir):
    return filters.required_cast(silver(spark, sf_dir)).select(
        "match_id", "match_date", "home_goals_ft", "away_goals_ft"
    )


def enrich_left_join(spark, sf_dir):
    raw = filters.required_raw(matches(spark, sf_dir))
    return with_league(cast_columns(raw, "match_id", "division"), leagues(spark))


# --- data tests ---------------------------------------------------------------------------


def models(spark, sf_dir):
    return [
        ("stg_matches", silver(spark, sf_dir), quality.SILVER_CHECKS),
        ("fct_european_matches", mart(spark, sf_dir), quality.MART_CHECKS),
    ]


def columns_of(checks, test: str) -> list[str]:
    return [c.column for c in checks if c.test == test]


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dq_not_null(spark, sf_dir):
    return union(
        [
            quality.null_counts(df, columns_of(checks, "not_null")).withColumn("model", F.lit(name))
            for name, df, checks in models(spark, sf_dir)
        ]
    )


def dq_unique(spark, sf_dir):
    return union(
        [
            quality.duplicates(df, [column]).withColumn("model", F.lit(name))
            for name, df, checks in models(spark, sf_dir)
            for column in columns_of(checks, "unique")
        ]
    )


def dq_accepted_values(spark, sf_dir):
    return union(
        [
            quality.unaccepted_values(df, [c for c in checks if c.test == "accepted_values"])
            .withColumn("model", F.lit(name))
            for name, df, checks in models(spark, sf_dir)
        ]
    )


def dq_relationships(spark, sf_dir):
    return quality.orphans(silver(spark, sf_dir), "division", leagues(spark), "code")


def dq_report(spark, sf_dir):
    parents = {"leagues": leagues(spark)}
    return union(
        [quality.run_suite(df, name, checks, parents) for name, df, checks in models(spark, sf_dir)]
    )


def dq_unique_lineitem(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.duplicates(lineitem, ["l_orderkey", "l_linenumber"])


def dq_relationships_orders_lineitem(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return quality.orphans(orders, "o_orderkey", lineitem, "l_orderkey")


def dq_relationships_lineitem_orders(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return quality.orphans(lineitem, "l_orderkey", orders, "o_orderkey")


# --- the optional training-data subpackage ------------------------------------------------


def training_data():
    """Its queries and the pipeline, or None where the subpackage was taken out."""
    try:
        import corpus_pipeline
        from matchlake.llm import queries as training_queries
    except ModuleNotFoundError as missing:
        if missing.name in ("matchlake.llm", "corpus_pipeline"):
            return None
        raise
    return training_queries, corpus_pipeline


def queries() -> dict[str, Query]:
    found = core_queries()
    if parts := training_data():
        training_queries, corpus_pipeline = parts
        found |= training_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = expected.statements()
    if parts := training_data():
        training_queries, corpus_pipeline = parts
        found |= training_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def core_queries() -> dict[str, Query]:
    return {
        "csv_scan_roundtrip": csv_scan_roundtrip,
        "csv_quoted_newline": csv_quoted_newline,
        "bronze_rebuild_idempotent": bronze_rebuild_idempotent,
        "seed_leagues": seed_leagues,
        "stg_matches": silver_view,
        "fct_matches": mart,
        "mart_write_readback": stored_mart,
        "mart_date_range_pruned": mart_date_range_pruned,
        "mart_date_filter_pruned": mart_date_filter_pruned,
        "mart_lookup_by_key": mart_lookup_by_key,
        "medallion_end_to_end": medallion_end_to_end,
        "medallion_test_report": medallion_test_report,
        "safe_cast_date": safe_cast_date,
        "safe_cast_date_forms": safe_cast_date_forms,
        "safe_cast_int_halves": safe_cast_int_halves,
        "safe_cast_int": casts_of("int"),
        "safe_cast_double": casts_of("double"),
        "surrogate_key": surrogate_key,
        "extract_year": lambda spark, sf_dir: silver(spark, sf_dir).select("match_date", "match_year"),
        "abs_difference": abs_difference,
        "decode_result_label": decode_result_label,
        "classify_goal_timing": classify_goal_timing,
        "bucket_scoring_category": bucket_scoring_category,
        "filter_required_raw": lambda spark, sf_dir: filters.required_raw(matches(spark, sf_dir)),
        "filter_division_in": lambda spark, sf_dir: filters.mart_divisions(
            matches(spark, sf_dir), "Division"
        ),
        "filter_required_cast": filter_required_cast,
        "enrich_left_join": enrich_left_join,
        **{
            name: lambda spark, sf_dir, kpi=kpi: kpi(published_mart(spark, sf_dir))
            for name, kpi in kpis.KPIS.items()
        },
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_accepted_values": dq_accepted_values,
        "dq_relationships": dq_relationships,
        "dq_report": dq_report,
        "dq_unique_lineitem": dq_unique_lineitem,
        "dq_relationships_lineitem_orders": dq_relationships_lineitem_orders,
        "dq_relationships_orders_lineitem": dq_relationships_orders_lineitem,
    }
