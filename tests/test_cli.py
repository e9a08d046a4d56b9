"""The command line, over a small landed file."""

import pytest

import __spark_entry__ as entry
from matchlake.__main__ import arguments, main
from matchlake.fixtures import matches
from matchlake.operators.quality import QualityError
from matchlake.session import scratch_path


def test_build_test_and_kpi(spark, capsys, monkeypatch):
    monkeypatch.setattr("matchlake.__main__.build_session", lambda app: spark)
    root = scratch_path(spark, "cli")
    landed = entry.land_csv(matches(spark, "/root/testdata/sf0.001"), f"{root}/landed")
    layers = ("raw", "staging", "mart")
    names = ["--root", root, *[f"--{layer}-database=cli_{layer}" for layer in layers]]
    with pytest.raises(QualityError, match="match_date not_null"):
        main([*names, "build", "--matches", landed])
    # A session with an empty catalog finds the layers by their folder, and can rebuild them.
    spark.sql("DROP VIEW cli_staging.stg_matches")
    for table in ("cli_raw.raw_matches", "cli_raw.leagues", "cli_mart.fct_european_matches"):
        spark.sql(f"DROP VIEW {table}")
    with pytest.raises(QualityError):
        main([*names, "test"])
    assert "accepted_values" in capsys.readouterr().out
    main([*names, "kpi", "kpi_matches_by_league"])
    assert "Premier League" in capsys.readouterr().out
    with pytest.raises(QualityError):
        main([*names, "build", "--matches", landed])


def test_arguments():
    args = arguments(["build", "--matches", "a", "b"])
    assert (args.matches, args.leagues, args.mart_database) == (["a", "b"], None, "matchlake_mart")
