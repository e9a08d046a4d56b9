"""The order of a build from what its models read."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from test_models import build_config, clean

import __spark_entry__ as entry
from matchlake.fixtures import matches
from matchlake.plans.build import build_models, run_build
from matchlake.plans.models import Model, ModelError, make_models, names_in, sorter, sql_model
from matchlake.sources.tables import Namespaces

SF = "/root/testdata/sf0.001"
NAMES = Namespaces(raw="default", staging="default", mart="default")


def noted(name, seen, *reads):
    return Model(name, "mart", lambda step: seen.append(name) or name.upper(), reads)


def test_every_model_comes_after_what_it_reads():
    reads = {"a": (), "b": ("a", "out"), "c": ("a",), "d": ("b", "c"), "e": ("d", "a"), "f": ()}
    for seed in range(5):
        seen = []
        models = [noted(name, seen, *reads[name]) for name in random.Random(seed).sample("abcdef", 6)]
        results = make_models(None, NAMES, models, {"out": "x.y"})
        assert sorted(seen) == list("abcdef") and results == {n: n.upper() for n in seen}
        for name in seen:
            assert all(seen.index(r) < seen.index(name) for r in reads[name] if r != "out")


@pytest.mark.parametrize(
    "reads, message",
    [
        ({"a": ("c",), "b": ("a",), "c": ("b",)}, "read each other: .* -> "),
        ({"a": ("a",)}, "read each other: a -> a"),
        ({"a": (), "b": ("a", "nowhere")}, "b reads nowhere, which is no model"),
        ({"out": ()}, "out is declared more than once"),
    ],
)
def test_models_that_do_not_fit_are_errors_before_anything_is_made(reads, message):
    seen = []
    with pytest.raises(ModelError, match=message):
        make_models(None, NAMES, [noted(n, seen, *r) for n, r in reads.items()], {"out": "x.y"})
    with pytest.raises(ModelError, match="a is declared more than once"):
        sorter([noted("a", seen), noted("a", seen)])
    assert seen == []


def test_independent_models_are_made_side_by_side():
    both = threading.Barrier(2, timeout=30)  # breaks unless two wait for each other
    models = [Model(n, "mart", lambda step: both.wait()) for n in ("a", "b")]
    assert len(make_models(None, NAMES, models)) == 2


def test_a_failure_stops_what_depends_on_it():
    seen = []

    def broken(step):
        raise RuntimeError("no rows today")

    models = [Model("a", "mart", broken), noted("b", seen, "a"), noted("c", seen, "b")]
    with pytest.raises(RuntimeError, match="no rows today"):
        make_models(None, NAMES, models)
    assert seen == []


def test_a_model_reads_only_what_it_declares():
    models = [noted("a", []), Model("b", "mart", lambda step: step.ref("a"))]
    with pytest.raises(ModelError, match="b reads a without declaring it"):
        make_models(None, NAMES, models)


def test_names_in_sql():
    assert names_in("SELECT '{{x}}' FROM {a} JOIN {b} USING (k) JOIN {a} z") == ("a", "b")
    with pytest.raises(ModelError, match="view or table"):
        sql_model("a", "mart", "SELECT 1", "snapshot")


def test_the_layers_declare_their_order(spark):
    _, cfg = build_config(spark, "declared")
    order, rounds = sorter(build_models(cfg)), []
    while order.is_active():
        rounds.append(sorted(order.get_ready()))
        order.done(*rounds[-1])
    assert rounds == [
        ["leagues", "raw_matches"], ["stg_matches"], ["fct_european_matches"], ["test_report"],
    ]


def test_a_build_with_models_of_its_own(spark):
    """A table over the mart, a view over that table and a source outside the build."""
    goals = "SELECT division, sum(total_goals) AS goals FROM {fct_european_matches} GROUP BY division"
    ranked = """SELECT l.country, g.goals * w.weight AS goals
                FROM {goals_by_division} g JOIN {leagues} l ON l.code = g.division JOIN {weights} w"""
    spark.range(1).select(F.lit(2).alias("weight")).write.mode("overwrite").saveAsTable("default.own_weights")
    models = (
        sql_model("country_goals", "mart", ranked),  # named before what it reads
        sql_model("goals_by_division", "mart", goals, "table"),
    )
    _, cfg = build_config(spark, "own", models=models, sources={"weights": "default.own_weights"})
    entry.land_csv(clean(matches(spark, SF)), cfg.matches_csv)
    mart = run_build(spark, cfg)
    want = {r.country: 2 * r.n for r in mart.groupBy("country", "division").agg(F.sum("total_goals").alias("n")).collect()}
    assert {r.country: r.goals for r in spark.table("own_mart.country_goals").collect()} == want != {}
    assert spark.catalog.getTable("own_mart.goals_by_division").tableType == "VIEW"  # of a version
