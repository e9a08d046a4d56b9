"""Strict CSV scan: position, quoting, spanning fields over several blocks, rejected rows."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.schemas import BRONZE, BRONZE_COLUMNS
from matchlake.sources.leagues import leagues, read_seed_csv
from matchlake.sources.matches_csv import CSV_OPTIONS, read_matches_csv

SMALL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("other", T.StringType()),
        T.StructField("n", T.DoubleType()),
    ]
)


def write(path, rows, header=("a", "b", "c", "d"), newline="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=newline, quoting=quoting)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def match_row(**changes):
    row = ["1.5"] * 48
    for name, value in {"Division": "E0", "MatchDate": "2024-01-05", **changes}.items():
        row[BRONZE_COLUMNS.index(name)] = value
    return row


def test_columns_go_by_position(spark, tmp_path):
    path = write(tmp_path / "m.csv", [match_row(HomeTeam="Ajax")], header=[f"x{i}" for i in range(48)])
    df = read_matches_csv(spark, path)
    assert df.schema == BRONZE
    row = df.collect()[0]
    assert (row.Division, row.HomeTeam, row.C_PHB) == ("E0", "Ajax", 1.5)


def test_doubled_quote_newline_and_empty_field(spark, tmp_path):
    rows = [("1", 'q"uo', "new\nline", "1"), ("2", "", "x", ""), ("3", "a,b", "\n\n", "2")]
    got = values(read_matches_csv(spark, write(tmp_path / "m.csv", rows), schema=SMALL))
    assert got == [
        ("1", 'q"uo', "new\nline", 1.0),
        ("2", None, "x", None),
        ("3", "a,b", "\n\n", 2.0),
    ]


@pytest.mark.parametrize("size", [47, 49])
def test_short_and_long_rows_are_rejected(spark, tmp_path, size):
    path = write(tmp_path / "m.csv", [match_row(), ["1"] * size])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_matches_csv(spark, path).write.format("noop").mode("overwrite").save()


def test_short_row_next_to_a_spanning_field_is_rejected(spark, tmp_path):
    path = write(tmp_path / "m.csv", [("1", "a\nb", "c", "1"), ("2", "x", "y")])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_matches_csv(spark, path, schema=SMALL).collect()


def test_bad_number_is_rejected(spark, tmp_path):
    path = write(tmp_path / "m.csv", [match_row(C_PHB="abc")])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_matches_csv(spark, path).write.parquet(str(tmp_path / "bronze"))


def test_spanning_field_is_rejected_when_not_allowed(spark, tmp_path):
    path = write(tmp_path / "m.csv", [("1", "a\nb", "c", "1")])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_matches_csv(spark, path, allow_quoted_newlines=False, schema=SMALL).collect()


def test_unclosed_quote_is_reported(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b,c,d\n1,"open,x,1\n2,y,z,2\n')
    with pytest.raises(Exception, match="never closed"):
        read_matches_csv(spark, str(path), schema=SMALL).collect()


def test_blank_lines_are_skipped(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b,c,d\n1,"x\n\ny",c,1\n\n  \n2,x,y,2\n\n')
    got = values(read_matches_csv(spark, str(path), schema=SMALL))
    assert got == [("1", "x\n\ny", "c", 1.0), ("2", "x", "y", 2.0)]


@pytest.mark.parametrize("lines", ['1,5" x,a,1\n2,6" x,b,2\n', '1,"a\nb"c,d,1\n'])
def test_stray_quotes_never_lose_rows(spark, tmp_path, lines):
    path = tmp_path / "m.csv"
    path.write_text("a,b,c,d\n" + lines + "3,x,y,3\n")
    with pytest.raises(Exception, match="(?i)malformed|never closed"):
        read_matches_csv(spark, str(path), schema=SMALL).collect()


def noise(rng, spanning):
    pieces = ["ab", ",", '"', "é", " ", "\n" if spanning else "-", "\n\n" if spanning else "."]
    return "x" + "".join(rng.choice(pieces) for _ in range(rng.randrange(12))) + "y"


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_files_cut_into_many_blocks(spark, conf, tmp_path, newline):
    """Same rows as written, with plain, mixed and hot files and cuts inside fields."""
    conf(spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="1")
    rng = random.Random(7)
    written = []
    for name, size, share in [("plain 1+%.csv", 90, 0), ("hot[1].csv", 400, 0.3), ("rare.csv", 300, 0.01),
                              ("all.csv", 60, 1)]:
        rows = []
        for i in range(size):
            spans = rng.random() < share
            rows.append((f"{name}-{i}", noise(rng, spans), noise(rng, spans), str(i)))
        if share:
            rows.append((f"{name}-long", "x" + "\nlong line, \"quoted\"" * 200, "z", "0"))
        # A header that spans lines, within its block and beyond it.
        note = {"all.csv": "note\n" * 3, "rare.csv": "note\n" * 400}.get(name, "note")
        write(tmp_path / name, rows, header=("id", note, "other", "n"), newline=newline)
        written += [(a, b, c, float(d)) for a, b, c, d in rows]
    df = read_matches_csv(spark, str(tmp_path), schema=SMALL)
    assert values(df) == sorted(written, key=repr)


def test_same_rows_without_broadcasts(spark, conf, tmp_path):
    conf(
        spark__sql__files__maxPartitionBytes="300",
        spark__sql__files__openCostInBytes="1",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    rows = [(str(i), "a\nb" if i % 3 == 0 else "c", "d", str(i)) for i in range(200)]
    path = write(tmp_path / "m.csv", rows)
    got = values(read_matches_csv(spark, path, schema=SMALL))
    assert got == sorted(((a, b, c, float(d)) for a, b, c, d in rows), key=repr)
    whole_file = spark.read.schema(SMALL).options(header="true", multiLine="true", **CSV_OPTIONS)
    assert got == values(whole_file.csv(path))


def test_files_without_spanning_fields_stay_splittable(spark, conf, tmp_path):
    """Two reads of the text, the lines themselves unshuffled and parsed in many tasks."""
    conf(spark__sql__files__maxPartitionBytes="400", spark__sql__files__openCostInBytes="1")
    path = write(tmp_path / "m.csv", [(str(i), 'say ""hi""', "x", "1") for i in range(300)])
    df = read_matches_csv(spark, path, schema=SMALL).withColumn("p", F.spark_partition_id())
    assert len({r.p for r in df.collect()}) > 4
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 2 and "SortMergeJoin" not in plan


CASES = {
    "quoted carriage return": (b'a,b,c,d\n1,"x\ry",z,1\n', [("1", "x\ry", "z", 1.0)]),
    "quoted CRLF": (b'a,b,c,d\r\n1,"x\r\ny",z,1\r\n', [("1", "x\r\ny", "z", 1.0)]),
    "rows ended by bare CR": (b"a,b,c,d\r1,x,y,1\r2,x,y,2\n", [("1", "x", "y", 1.0), ("2", "x", "y", 2.0)]),
    "blank lines first": (b"\n\r\n  \na,b,c,d\n1,x,y,1\n", [("1", "x", "y", 1.0)]),
    "stray quotes": (b'a,b,c,d\n1,5" x 6" y,z,1\n', None),
    "header only": (b"a,b,c,d", []),
    "nothing": (b"", []),
}


@pytest.mark.parametrize("spanning", [False, True])
@pytest.mark.parametrize("case", CASES)
def test_a_spanning_row_changes_no_other_row(spark, tmp_path, case, spanning):
    text, want = CASES[case]
    if spanning and case in ("header only", "nothing"):
        text = b"a,b,c,d\n"
    (tmp_path / "m.csv").write_bytes(text + b'9,"s\np",q,9\n' * spanning)
    rows = read_matches_csv(spark, str(tmp_path), schema=SMALL)
    if want is None:
        with pytest.raises(Exception, match="stray quote"):
            rows.collect()
    else:
        assert values(rows) == want + [("9", "s\np", "q", 9.0)] * spanning


def test_record_over_too_many_blocks_is_an_error(spark, conf, tmp_path, monkeypatch):
    conf(spark__sql__files__maxPartitionBytes="500", spark__sql__files__openCostInBytes="1")
    path = write(tmp_path / "m.csv", [("1", "long\n" * 2_000, "c", "1"), ("2", "x", "y", "2")])
    assert len(values(read_matches_csv(spark, path, schema=SMALL))) == 2
    monkeypatch.setattr("matchlake.sources.matches_csv.MAX_RECORD_BYTES", 5_000)
    with pytest.raises(Exception, match="longer than the allowed"):
        read_matches_csv(spark, path, schema=SMALL).collect()


def test_seed_csv(spark, tmp_path):
    path = write(tmp_path / "seed.csv", [tuple(r) for r in leagues(spark).collect()],
                 header=("Code", "Country", "League_Name"))
    seed = read_seed_csv(spark, path)
    assert seed.columns == ["code", "country", "league_name"]
    assert values(seed) == values(leagues(spark))
    assert seed.count() == 38
    assert seed.where("code = 'T1'").first().league_name == "Süper Lig"
    assert seed.where("code = 'IRL'").first().league_name == "League of Ireland Men's Premier"
