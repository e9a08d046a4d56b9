"""Publication in one step: readers, builds that die, versions that go."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchlake.session import scratch_path
from matchlake.sources import tables

SF = "/root/testdata/sf0.001"


def place(spark, label):
    path = scratch_path(spark, label)
    return path, "default." + label


def rows_of(spark, value, n=100):
    return spark.range(n).select(F.lit(value).cast("int").alias("build"), (F.col("id") % 3).alias("part"))


def seen(spark, name):
    return {(r.build, r["count"]) for r in spark.table(name).groupBy("build").count().collect()}


def test_a_reader_never_fails_during_rebuilds(spark):
    path, name = place(spark, "polled")
    tables.publish(rows_of(spark, 0), name, path, ["part"])
    stop, found, failed = threading.Event(), [], []

    def poll():
        while not stop.is_set():
            try:
                found.append(seen(spark, name))
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for build in range(1, 51):
        tables.publish(rows_of(spark, build), name, path, ["part"] if build % 2 else [])
    stop.set()
    reader.join()
    assert not failed and len(found) > 5
    assert all(len(rows) == 1 and next(iter(rows))[1] == 100 for rows in found), "a mix of builds"
    builds = [next(iter(rows))[0] for rows in found]
    assert builds == sorted(builds) and len(set(builds)) > 3
    assert seen(spark, name) == {(50, 100)}


class Killed(BaseException):
    """As if the driver had died: nothing catches it."""


@pytest.mark.parametrize("step", ["_write_version", "_record", "point", "_clear"])
@pytest.mark.parametrize("after", [False, True])
def test_a_build_killed_at_any_call_leaves_old_or_new_rows(spark, monkeypatch, step, after):
    path, name = place(spark, f"killed{step}_{after}".lower())
    tables.publish(rows_of(spark, 1), name, path)
    real = getattr(tables, step)

    def dies(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Killed

    monkeypatch.setattr(tables, step, dies)
    with pytest.raises(Killed):
        tables.publish(rows_of(spark, 2), name, path, grace=0)
    monkeypatch.undo()
    new_name = (step, after) in {("point", True), ("_clear", False), ("_clear", True)}
    new_root = new_name or (step, after) in {("_record", True), ("point", False)}
    assert seen(spark, name) == {(2 if new_name else 1, 100)}
    assert tables.current(spark, path) == tables.publications(spark, path)[-1][1]
    tables.point(spark, name + "_attached", tables.files_of(tables.current(spark, path)))
    assert seen(spark, name + "_attached") == {(2 if new_root else 1, 100)}
    tables.publish(rows_of(spark, 3), name, path, grace=0)  # and the next build clears up
    assert seen(spark, name) == {(3, 100)} and len(glob.glob(f"{path.removeprefix('file:')}/v-*")) == 1


def test_a_failing_switch_keeps_the_old_rows(spark, monkeypatch):
    path, name = place(spark, "no_switch")
    tables.publish(rows_of(spark, 1), name, path)

    def fails(*_):
        raise RuntimeError("catalog down")

    monkeypatch.setattr(tables, "point", fails)
    with pytest.raises(RuntimeError, match="catalog down"):
        tables.publish(rows_of(spark, 2), name, path)
    assert seen(spark, name) == {(1, 100)} and len(tables.publications(spark, path)) == 1


def test_versions_go_after_their_grace(spark):
    path, name = place(spark, "graced")
    folder = path.removeprefix("file:")
    for build in (1, 2):
        tables.publish(rows_of(spark, build), name, path)
    old = spark.table(name)
    tables.publish(rows_of(spark, 3), name, path)
    assert old.agg(F.max("build")).first()[0] == 2  # planned before the rebuild, still reads its version
    assert len(glob.glob(f"{folder}/v-*")) == len(tables.publications(spark, path)) == 3
    os.makedirs(f"{folder}/v-{1:020d}-never-published")
    tables.publish(rows_of(spark, 4), name, path, grace=0)
    assert len(glob.glob(f"{folder}/v-*")) == len(tables.publications(spark, path)) == 1
    assert seen(spark, name) == {(4, 100)}


def test_the_columns_may_change_and_rows_may_be_none(spark):
    path, name = place(spark, "changing")
    tables.publish(rows_of(spark, 1), name, path, ["part"])
    tables.publish(rows_of(spark, 1).withColumn("more", F.lit("x")), name, path, ["part"])
    assert sorted(spark.table(name).columns) == ["build", "more", "part"]
    tables.publish(rows_of(spark, 1, n=0), name, path, ["part"])
    assert sorted(spark.table(name).columns) == ["build", "part"] and spark.table(name).count() == 0


def test_a_table_of_that_name_is_taken_over(spark):
    path, name = place(spark, "was_a_table")
    rows_of(spark, 1).write.option("path", f"{path}/by-hand").saveAsTable(name)
    tables.publish(rows_of(spark, 2), name, path)
    assert seen(spark, name) == {(2, 100)}


def test_attach_takes_the_last_publication(spark):
    root = scratch_path(spark, "attached")
    names = tables.Namespaces(mart="attached_mart", raw="attached_raw", staging="attached_staging", root=root)
    names.create(spark)
    path, name = names.path("mart", "fct"), names.table("mart", "fct")
    with pytest.raises(FileNotFoundError, match="no published version"):
        names.attach(spark, "mart", "fct")
    tables.publish(rows_of(spark, 1), name, path)
    rows_of(spark, 9).write.parquet(f"{path}/v-{10**19 - 1:020d}-complete-but-never-published")
    spark.sql(f"DROP VIEW {name}")
    names.attach(spark, "mart", "fct")
    assert seen(spark, name) == {(1, 100)}


def test_the_view_prunes_and_pushes_down(spark):
    _, fact = entry.published(spark, SF)
    plan = spark.table(fact).where("match_year = 1997 AND division = 'E0'").select("match_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "1997" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(division,E0)" in text and text.split("ReadSchema: struct<")[1].count(":") == 2
