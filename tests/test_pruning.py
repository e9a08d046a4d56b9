"""What a query over the published mart does not read: years by the date alone, row groups by
key, division and league."""

import glob

import pytest
from pyspark.sql import functions as F
from test_models import build_config, clean, plan_of

import __spark_entry__ as entry
from matchlake.fixtures import matches
from matchlake.plans.build import build_models, open_layers, run_build
from matchlake.session import scratch_path
from matchlake.sources import tables

SF = "/root/testdata/sf0.01"


def scans(df):
    """Files and rows that each file scan of a plan has read."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "FileSourceScan" in kind:
            read = node.metrics()
            found.append((read.apply("numFiles").value(), read.apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def mart(spark):
    name = "default.pruned_by_date"
    tables.write_mart(entry.mart(spark, SF), name, scratch_path(spark, "pruned-by-date"))
    return name


def test_a_filter_on_the_date_alone_prunes_years(spark, mart):
    where = "WHERE match_date BETWEEN '1997-03-01' AND '1998-02-28'"
    df = spark.sql(f"SELECT * FROM {mart}_by_date {where}")
    plan = plan_of(df)
    partitions = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "dynamicpruningexpression(match_year" in partitions and "BroadcastHashJoin" in plan
    want = spark.sql(f"SELECT * FROM {mart} {where}")
    assert df.columns == want.columns and df.count() == want.count() > 1000
    assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
    files = spark.table(mart).inputFiles()
    for wanted, years in (
        (df, ("1997", "1998")),
        (spark.sql(f"SELECT * FROM {mart}_by_date WHERE match_date = '1999-05-01'"), ("1999",)),
        (spark.sql(f"SELECT * FROM {mart}_by_date WHERE year(match_date) = 1999"), ("1999",)),
    ):
        own = [f for f in files if f.split("match_year=")[1][:4] in years]
        assert max(n for n, _ in scans(wanted)) == len(own) < len(files)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_row_is_lost_without_a_filter(spark, conf, mart, threshold):
    conf(
        spark__sql__autoBroadcastJoinThreshold=threshold,
        spark__sql__adaptive__autoBroadcastJoinThreshold=threshold,
    )
    whole, by_date = spark.table(mart), spark.table(mart + "_by_date")
    assert whole.exceptAll(by_date).isEmpty() and by_date.exceptAll(whole).isEmpty()


def test_the_calendar_is_no_part_of_the_rows(spark, mart):
    folder = spark.table(mart).inputFiles()[0].split("/match_year")[0]
    days = spark.read.parquet(f"{folder}/{tables.CALENDAR}")
    rows = spark.table(mart)
    assert rows.count() == 15193 and days.count() == rows.select("match_date").distinct().count()
    assert days.where("match_year <> year(match_date)").isEmpty()


def test_a_rebuild_moves_both_names(spark):
    path, name = scratch_path(spark, "both-names"), "default.both_names"
    rows = entry.mart(spark, "/root/testdata/sf0.001")
    tables.write_mart(rows.where("match_year < 1997"), name, path)
    old = spark.table(name + "_by_date")
    size = old.count()
    tables.write_mart(rows, name, path)
    assert old.count() == size < spark.table(name + "_by_date").count() == rows.count()
    tables.write_mart(rows.limit(0), name, path)
    assert spark.table(name + "_by_date").count() == spark.table(name).count() == 0


def test_a_calendar_that_fails_leaves_the_old_rows(spark, monkeypatch):
    path, name = scratch_path(spark, "no-calendar"), "default.no_calendar"
    rows = entry.mart(spark, "/root/testdata/sf0.001")
    tables.write_mart(rows.where("match_year < 1997"), name, path)
    before = spark.table(name).count()

    def fails(spark, version):
        raise RuntimeError("no calendar")

    monkeypatch.setattr(tables, "_write_calendar", fails)
    with pytest.raises(RuntimeError, match="no calendar"):
        tables.write_mart(rows, name, path)
    assert spark.table(name).count() == spark.table(name + "_by_date").count() == before
    assert len(glob.glob(f"{path.removeprefix('file:')}/v-*")) == 1


def test_a_later_session_finds_the_name_by_date(spark):
    _, cfg = build_config(spark, "found_by_date")
    entry.land_csv(clean(matches(spark, "/root/testdata/sf0.001")), cfg.matches_csv)
    rows = run_build(spark, cfg).count()
    name = cfg.namespaces.table("mart", "fct_european_matches_by_date")
    spark.sql(f"DROP VIEW {name}")
    open_layers(spark, cfg)
    assert spark.table(name).count() == rows
    assert len(build_models(cfg)) == 5


def small_groups(spark, conf, label):
    """The mart in row groups of some hundred rows, each with several divisions and leagues, and
    with the smallest and largest of both in every group."""
    path, name = scratch_path(spark, label), f"default.{label}"
    spread = {"parquet.block.size": "30000", "parquet.block.size.row.check.min": "50", "parquet.page.size": "4096",
              "parquet.page.size.row.check.min": "50", "parquet.page.size.row.check.max": "50"}
    rows = entry.mart(spark, SF).withColumn("at", F.xxhash64("match_id")).where("division IN ('B1', 'E0', 'F1', 'SP1')")
    # one division in the middle of the order lies in one stretch of rows only
    rows = rows.withColumn("at", F.when(F.col("division") == "E0", F.lit(0)).otherwise(F.col("at")))
    tables.publish(
        rows.coalesce(1).sortWithinPartitions("at").drop("at"), name, path, options={**tables.MART_OPTIONS, **spread}
    )
    return spark.table(name)


def test_row_groups_without_the_value_are_skipped(spark, conf):
    stored = small_groups(spark, conf, "small_groups")
    total = stored.count()
    key = stored.where("division = 'F1' AND match_id > '8'").agg(F.min("match_id")).first()[0]
    looked_up = stored.where(F.col("match_id") == key)
    (_, read), = scans(looked_up)
    assert looked_up.count() == 1 and read < total / 4  # min and max hold the key in every group
    (_, read), = scans(stored.where("division = 'E0'"))
    assert stored.where("division = 'E0'").count() <= read < total / 2  # B1 < E0 < F1 < SP1
    (_, read), = scans(stored.where("league_name = 'no such league'"))
    assert read == 0
    off = {"parquet.filter.bloom.enabled": "false", "parquet.filter.dictionary.enabled": "false"}
    plain = spark.read.options(**off).parquet(*stored.inputFiles())
    (_, read), = scans(plain.where(F.col("match_id") == key))
    assert read > total / 2
