"""Registered queries that have a statement, against it."""

import pytest
from compare import differences, duck

from matchlake.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(queries.queries()[name](spark, sf_dir), duck(sf_dir), queries.oracle_sql()[name]) == []


def test_statement_finds_planted_links(spark, tmp_path):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.25], 1), (4, [1.0, 0.0], 2), (5, None, 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vectors.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duck(str(tmp_path / "none"))
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    query, sql = queries.queries()["op1_flat_graph"], queries.oracle_sql()["op1_flat_graph"]
    assert differences(query(spark, str(tmp_path)), con, sql) == []
    assert con.execute(f"select sum(n_links) from ({sql})").fetchone() == (4,)
