"""What keeps the build in proportion to its input: compiled stages, spread rows, unshuffled lines."""

import os

import pyarrow as pa
import pytest
from compare import differences, duck
from test_csv import SMALL, values, write
from test_models import plan_of

import __spark_entry__ as entry
from matchlake.fixtures import matches
from matchlake.session import METHOD_LIMIT, scratch_path
from matchlake.sources.matches_csv import _glued, read_matches_csv

SF = "/root/testdata/sf0.001"


def test_wide_stages_are_compiled_in_a_session_of_others(spark, conf):
    conf(**{METHOD_LIMIT.replace(".", "__"): "65535"})
    matches(spark, SF)
    assert spark.conf.get(METHOD_LIMIT) == "65535"  # a limit that was set stays
    spark.conf.unset(METHOD_LIMIT)
    assert "*(" in plan_of(matches(spark, SF)) and spark.conf.get(METHOD_LIMIT) == "8000"


def test_rows_to_be_written_are_derived_by_all_cores(spark):
    spread, plain = matches(spark, SF, spread=True), matches(spark, SF)
    assert len([1 for n in spread.rdd.glom().map(len).collect() if n]) == spark.sparkContext.defaultParallelism
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_lines_of_large_files_are_not_shuffled(spark, conf, tmp_path):
    conf(
        spark__sql__files__maxPartitionBytes="400",
        spark__sql__files__openCostInBytes="1",
        spark__sql__autoBroadcastJoinThreshold="-1",  # as for lists that are estimated too large
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    path = write(tmp_path / "m.csv", [(str(i), "a\nb" if i % 9 == 0 else "c", "d", "1") for i in range(300)])
    df = read_matches_csv(spark, path, schema=SMALL)
    assert len(values(df)) == 300 and "SortMergeJoin" not in plan_of(df)


def shuffled(df):
    """Rows that the shuffles of a plan that has run have written."""
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


@pytest.mark.parametrize("lines_a_batch", ["10000", "2"])
def test_only_records_that_leave_their_block_are_shuffled(spark, conf, tmp_path, lines_a_batch):
    conf(
        spark__sql__files__maxPartitionBytes="4000",
        spark__sql__files__openCostInBytes="1",
        spark__sql__execution__arrow__maxRecordsPerBatch=lines_a_batch,
    )
    rows = [(str(i), 'a "b",\nc', "\r\nd\n\n", str(i)) for i in range(2_000)]  # 5 lines each, with the row's own
    df = read_matches_csv(spark, write(tmp_path / "m.csv", rows), schema=SMALL)
    assert values(df) == sorted(((a, b, c, float(d)) for a, b, c, d in rows), key=repr)
    assert 10 < shuffled(df) < 500


def test_quoted_newlines_of_the_query_in_many_blocks(spark, conf):
    conf(spark__sql__files__maxPartitionBytes="20000", spark__sql__files__openCostInBytes="1")
    df = entry.csv_quoted_newline(spark, SF)
    assert differences(df, duck(SF), entry.oracle_sql()["csv_quoted_newline"]) == []
    assert 70 < shuffled(df) < 2_000  # of over 6,000 rows of two lines or more


def batches_of(*batches):
    """Lines as the tasks get them, the first of all marked as the header."""
    for k, lines in enumerate(batches):
        odd = [line.count('"') % 2 == 1 for line in lines]
        header = [k == 0 and i == 0 for i in range(len(lines))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.string()), pa.array(odd, pa.bool_()), pa.array(header, pa.bool_())],
            ["value", "odd", "header"],
        )


def test_records_are_put_together_over_batches():
    got = _glued(batches_of(['"h', 'h"', "a", '"b'], ["c"], [], ["", 'd","e'], ['f"', "g", ""], ['"', '"']))
    assert [(r["value"], r["header"]) for batch in got for r in batch.to_pylist()] == [
        ('"h\nh"', True), ("a", False), ('"b\nc\n\nd","e\nf"', False), ("g", False), ("", False), ('"\n"', False)
    ]
    assert list(_glued(batches_of())) == [] and list(_glued(batches_of([]))) == []
    with pytest.raises(ValueError, match="end within a record"):
        list(_glued(batches_of(["a", '"b'], ["c"])))


def test_bytes_that_are_no_text_are_read_alike_in_every_record(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(b'a,b,c,d\n1,"\xe9\nx",\xff,1\n2,"\xe9",\xff,2\n')
    (tmp_path / "n.csv").write_bytes(b'a,b,c,d\n3,"\xe9",\xff,3\n')
    got = values(read_matches_csv(spark, str(tmp_path), schema=SMALL))
    assert got == [(str(i), "\ufffd\nx" if i == 1 else "\ufffd", "\ufffd", float(i)) for i in (1, 2, 3)]


def test_landed_files_are_compressed_and_bounded(spark):
    path = entry.land_csv(matches(spark, SF), scratch_path(spark, "landed-test"), **entry.CSV_LZ4)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part")]
    assert files and all(f.endswith(".lz4") for f in files) and int(entry.CSV_LZ4["maxRecordsPerFile"]) <= 500_000
    back = read_matches_csv(spark, path)
    want = matches(spark, SF)
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
