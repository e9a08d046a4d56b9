"""Silver, mart, layout, tests and the whole build on derived rows."""

import datetime
import glob
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchlake.fixtures import matches
from matchlake.operators import quality
from matchlake.operators.enrich import with_league
from matchlake.operators.quality import Check, QualityError, gate, run_suite
from matchlake.plans import staging
from matchlake.plans.build import BuildConfig, quality_report, run_build
from matchlake.plans.mart import build_mart
from matchlake.plans.staging import cast_columns, stage
from matchlake.schemas import BRONZE, MART_COLUMNS, SILVER_COLUMNS
from matchlake.session import scratch_path
from matchlake.sources import tables
from matchlake.sources.leagues import leagues

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bronze_row(spark, *changes):
    rows = [{**dict.fromkeys(BRONZE.fieldNames()), **change} for change in changes]
    return spark.createDataFrame([tuple(r[n] for n in BRONZE.fieldNames()) for r in rows], BRONZE)


GOOD = dict(Division="E0", MatchDate="2024-01-05", HomeTeam="A", AwayTeam="B", FTHome=2.0, FTAway=1.0)


def test_model_columns_and_types(spark):
    silver = stage(matches(spark, SF), leagues(spark))
    mart = build_mart(silver)
    assert silver.columns == SILVER_COLUMNS and len(silver.columns) == 42
    assert mart.columns == MART_COLUMNS and len(mart.columns) == 29
    types = [t for _, t in silver.dtypes]
    assert (types.count("bigint"), types.count("double"), types.count("date")) == (17, 16, 1)


def test_expected_counts(spark):
    silver = entry.silver(spark, SF)
    mart = entry.mart(spark, SF)
    assert silver.count() == 58193
    assert silver.select(F.count_distinct("match_id")).first()[0] == 58191
    ids = mart.agg(F.count("*"), F.min("match_id"), F.max("match_id"), F.sum("goal_difference")).first()
    assert tuple(ids) == (
        15193, "000448d3aecb4fa8374bf845e7a01bf3", "ffffe54014a921e61a260441eca540be", 21751,
    )


def test_same_date_written_two_ways_has_two_keys(spark):
    raw = bronze_row(spark, GOOD, {**GOOD, "MatchDate": "2024-1-5"})
    rows = cast_columns(raw, "match_id", "match_date").collect()
    assert rows[0].match_id != rows[1].match_id
    assert {r.match_date for r in rows} == {datetime.date(2024, 1, 5)}


def test_two_null_gates(spark):
    raw = bronze_row(
        spark,
        GOOD,
        {**GOOD, "MatchDate": "05/01/2024"},
        {**GOOD, "MatchDate": None},
        {**GOOD, "HomeTeam": None},
        {**GOOD, "AwayTeam": None},
        {**GOOD, "FTAway": None},
    )
    silver = stage(raw, leagues(spark))
    assert silver.count() == 3
    assert silver.where("match_date IS NULL").count() == 1
    assert build_mart(silver).count() == 1


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_left_join_keeps_unmatched_rows(spark, conf, threshold):
    conf(
        spark__sql__autoBroadcastJoinThreshold=threshold,
        spark__sql__adaptive__autoBroadcastJoinThreshold=threshold,
    )
    df = spark.createDataFrame([(1, "E0"), (2, None), (3, "ZZ9"), (4, "e0")], "i int, division string")
    joined = with_league(df, leagues(spark))
    assert ("BroadcastHashJoin" in plan_of(joined)) == (threshold != "-1")
    rows = {r.i: (r.country, r.league_name) for r in joined.collect()}
    assert rows == {1: ("England", "Premier League"), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_mart_filters_reach_the_scan(spark, tmp_path):
    matches(spark, SF).write.parquet(str(tmp_path / "bronze"))
    mart = build_mart(stage(spark.read.parquet(str(tmp_path / "bronze")), leagues(spark)))
    plan = plan_of(mart.groupBy("league_name").count())
    assert "In(Division, [B1,D1,DEN,E0,E1,F1,I1,P1,POL,SP1])" in plan
    assert "IsNotNull(HomeTeam)" in plan and "BroadcastHashJoin" in plan
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    names = {field.split(":")[0] for field in schema.split(",")}
    assert names == {"Division", "MatchDate", "HomeTeam", "AwayTeam", "FTHome", "FTAway"}


def stored(spark, mart, name):
    path = scratch_path(spark, name)
    table = f"default.{name}"
    tables.write_mart(mart, table, path)
    return path, tables.read_mart(spark, table)


def test_mart_layout(spark):
    path, mart = stored(spark, entry.mart(spark, SF), "layout_mart")
    assert mart.columns == MART_COLUMNS
    files = glob.glob(f"{path}/v-*/match_year=*/*.parquet")
    assert {f.split("match_year=")[1][:4] for f in files} == {str(y) for y in range(1995, 2002)}
    for f in files:
        divisions = pq.ParquetFile(f).read(columns=["division"])["division"].to_pylist()
        assert divisions == sorted(divisions)


def test_hot_year_is_split_over_tasks(spark, conf, tmp_path):
    """Two thirds of the rows in one year and division still give several files, all rows kept."""
    year = F.when(F.xxhash64("match_id") % 3 != 0, 1999).otherwise(F.col("match_year"))
    hot = entry.mart(spark, SF).withColumn("match_year", year).withColumn("division", F.lit("E0"))
    # Several input files: a hot partition is cut between the tasks that wrote to it.
    hot.repartition(16).write.parquet(str(tmp_path / "hot"))
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
        spark__sql__files__openCostInBytes="128m",
    )
    source = spark.read.parquet(str(tmp_path / "hot"))
    path, back = stored(spark, source, "hot_mart")
    files = glob.glob(f"{path}/v-*/match_year=1999/*.parquet")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert sum(sizes) == source.where("match_year = 1999").count() > 10000
    assert len(sizes) > 3 and max(sizes) < sum(sizes) / 2
    assert back.exceptAll(source).isEmpty() and source.exceptAll(back).isEmpty()


def test_date_range_opens_only_its_years(spark):
    _, mart = stored(spark, entry.mart(spark, SF), "pruned_mart")
    df = tables.match_date_between(mart, "1997-03-01", "1998-02-28")
    assert df.count() == entry.mart(spark, SF).where(
        "match_date BETWEEN date'1997-03-01' AND date'1998-02-28'"
    ).count()
    partitions = plan_of(df).split("PartitionFilters: [")[1].split("]")[0]
    assert "match_year" in partitions and "1997" in partitions and "1998" in partitions
    files = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("match_year=")[1][:4] for r in files} == {"1997", "1998"}


def report_rows(report):
    return {(r.model, r.column_name, r.test): r.failures for r in report.collect()}


def test_suite_reports_known_failures(spark):
    report = report_rows(entry.dq_report(spark, SF))
    assert len(report) == 21
    failing = {k: v for k, v in report.items() if v}
    assert failing == {
        ("stg_matches", "match_id", "unique"): 2,
        ("stg_matches", "division", "not_null"): 1223,
        ("stg_matches", "division", "relationships"): 1125,
        ("stg_matches", "match_date", "not_null"): 617,
        ("stg_matches", "full_time_result", "accepted_values"): 1,
        ("stg_matches", "league_name", "not_null"): 2348,
        ("fct_european_matches", "match_id", "unique"): 1,
    }


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_suite_semantics_and_single_wide_shuffle(spark, conf, threshold):
    conf(
        spark__sql__autoBroadcastJoinThreshold=threshold,
        spark__sql__adaptive__autoBroadcastJoinThreshold=threshold,
    )
    df = spark.createDataFrame(
        [("a", "x", 0.0), ("a", "y", -0.0), (None, None, None), (None, "z", None), ("b", "z", 1.0)],
        "k string, v string, d double",
    )
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "code string")
    checks = [
        Check("k", "unique"),
        Check("d", "unique"),
        Check("k", "not_null"),
        Check("v", "accepted_values", ("x", "y")),
        Check("k", "relationships", parent="p", field="code"),
        Check("v", "relationships", parent="p", field="code"),
    ]
    report = run_suite(df, "m", checks, {"p": parent})
    # The model is scanned once, the parent once per use.
    assert plan_of(report).count("ExistingRDD") == 3
    assert report_rows(report) == {
        ("m", "k", "unique"): 1,
        ("m", "d", "unique"): 1,
        ("m", "k", "not_null"): 2,
        ("m", "v", "accepted_values"): 1,
        ("m", "k", "relationships"): 1,
        ("m", "v", "relationships"): 4,
    }


def test_single_tests(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("c",)], "k string")
    parent = spark.createDataFrame([("a",)], "code string")
    assert [tuple(r) for r in quality.null_counts(df, ["k"]).collect()] == [("k", 2)]
    assert [tuple(r) for r in quality.duplicates(df, ["k"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.unaccepted(df, "k", ["c"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.orphans(df, "k", parent, "code").collect()] == [("c", 1)]


def build_config(spark, label, **settings):
    root = scratch_path(spark, label)
    names = tables.Namespaces(
        raw=f"{label}_raw", staging=f" {label}_staging ", mart=f"{label}_mart", root=root
    )
    return root, BuildConfig(f"{root}/landed", namespaces=names, **settings)


def clean(rows):
    """Derived rows without the deliberate test failures."""
    return (
        rows.where("Division IS NOT NULL AND Division <> 'ZZ9' AND MatchDate RLIKE '^[12]'")
        .withColumn("FTResult", F.expr("nullif(FTResult, 'X')"))
        .dropDuplicates(["Division", "MatchDate", "HomeTeam", "AwayTeam", "FTHome", "FTAway"])
    )


def test_build_runs_twice_with_the_same_result(spark):
    root, cfg = build_config(spark, "twice")
    entry.land_csv(clean(matches(spark, SF)), cfg.matches_csv)
    first = sorted(map(tuple, run_build(spark, cfg).collect()))
    second = sorted(map(tuple, run_build(spark, cfg).collect()), key=repr)
    assert sorted(first, key=repr) == second and len(first) > 10000
    assert spark.table("twice_staging.stg_matches").columns == SILVER_COLUMNS
    assert spark.table("twice_raw.leagues").count() == 38
    view = spark.table("twice_staging.stg_matches")
    frame = stage(spark.table("twice_raw.raw_matches"), leagues(spark))
    assert view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty()


@pytest.mark.parametrize("root", [True, False])
@pytest.mark.parametrize("layer", ["bronze", "mart"])
def test_failing_rebuild_leaves_the_published_layers(spark, monkeypatch, layer, root):
    label = f"gap_{layer}_{root}".lower()
    folder, cfg = build_config(spark, label)
    if not root:
        cfg = replace(cfg, namespaces=replace(cfg.namespaces, root=None))
    rows = clean(matches(spark, "/root/testdata/sf0.001"))
    entry.land_csv(rows, cfg.matches_csv)
    before = run_build(spark, cfg).collect()
    if layer == "bronze":
        entry.land_csv(rows.withColumn("C_PHB", F.lit("no number")), cfg.matches_csv)
    else:
        bad = F.raise_error(F.lit("a bad mart row")).cast("bigint")
        monkeypatch.setattr(
            "matchlake.plans.build.build_mart", lambda silver: build_mart(silver).withColumn("total_goals", bad)
        )
    with pytest.raises(Exception, match="(?i)malformed|a bad mart row"):
        run_build(spark, cfg)
    names = cfg.namespaces
    assert spark.table(names.table("raw", "raw_matches")).count() == rows.count()
    assert spark.table(names.table("staging", "stg_matches")).count() > len(before) > 0
    mart = tables.read_mart(spark, names.table("mart", "fct_european_matches"))
    assert sorted(mart.collect(), key=str) == sorted(before, key=str)
    for database in (names.database("raw"), names.database("mart")):
        assert not [t.name for t in spark.catalog.listTables(database) if "__" in t.name]
    if root:
        assert len(glob.glob(f"{folder.removeprefix('file:')}/*_mart/fct_european_matches/v-*")) == 1


def test_year_predicate_prunes_a_plain_date_filter_does_not(spark):
    """What the README says about SQL over the published mart."""
    table = entry.published(spark, SF)[1]
    by_date = f"SELECT count(*) FROM {table} WHERE match_date >= date'1997-01-01'"
    filters = [plan_of(spark.sql(q)).split("PartitionFilters: [")[1].split("]")[0] for q in (
        by_date, by_date + " AND match_year >= 1997"
    )]
    assert "match_year" not in filters[0] and "1997" in filters[1]


def test_kpis_read_only_their_columns(spark):
    needed = {"league_name", "scoring_category"}
    plan = plan_of(entry.core_queries()["kpi_scoring_share_by_league"](spark, SF))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {f.split(":")[0] for f in schema.split(",")} == needed and "lineitem" not in plan


def test_a_swapped_column_pair_is_noticed(spark, monkeypatch):
    wrong = dict(staging.STAGED_SQL)
    wrong["home_shots"], wrong["away_shots"] = wrong["away_shots"], wrong["home_shots"]
    monkeypatch.setattr(staging, "STAGED_SQL", wrong)
    sf_dir = "/root/testdata/sf0.001"
    assert differences(entry.silver(spark, sf_dir), duck(sf_dir), entry.oracle_sql()["stg_matches"])


def test_accepted_values_take_one_scan_per_model(spark):
    assert plan_of(entry.dq_accepted_values(spark, SF)).count("FileScan parquet") == 2


def test_rebuild_drops_years_that_are_gone(spark, conf):
    conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    root, cfg = build_config(spark, "shrink", stop_on_failed_tests=False)
    entry.land_csv(matches(spark, SF), cfg.matches_csv)
    assert run_build(spark, cfg).select("match_year").distinct().count() == 7
    entry.land_csv(matches(spark, SF).where("MatchDate < '1997'"), cfg.matches_csv)
    assert run_build(spark, cfg).select("match_year").distinct().count() == 2


def test_failed_tests_stop_the_build_after_publication(spark):
    root, cfg = build_config(spark, "failing")
    entry.land_csv(matches(spark, SF), cfg.matches_csv)
    with pytest.raises(QualityError, match="stg_matches.division relationships: 1125"):
        run_build(spark, cfg)
    assert spark.table("failing_mart.fct_european_matches").count() == 15193
    with pytest.raises(QualityError):
        gate(quality_report(spark, cfg))
