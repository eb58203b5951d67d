"""Delimited text whose rows are found from the parity of quotes, against Python's own reader."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.keys import number_file_rows
from millrace.plans.pipelines import Columns, prepare
from millrace.sources.raw_csv import BLOCK, FILE, LINE, read_raw_csv


@pytest.fixture
def small_parts(spark):
    """Parts of files of 1,500 bytes, so that one file is read by many tasks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, rows, terminator="\n", tail=""):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, lineterminator=terminator)
        writer.writerow(["k", "some text", "z"])
        writer.writerows(rows)
        file.write(tail)


def odd_rows(seed, n=150):
    rng = random.Random(seed)
    signs = ["a", '"', "\n", "\r\n", ",", "é", " ", 'x"y', "\n\n", '",\n"']
    # Some cells are longer than several parts.
    return [
        [str(i), "".join(rng.choices(signs, k=rng.choice([0, 3, 8, 60, 60, 2500 if i % 50 == 7 else 1]))), rng.choice(["", "z", '"'])]
        for i in range(n)
    ]


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_rows_of_files_that_many_tasks_read(spark, tmp_path, small_parts, terminator, seed):
    files = [odd_rows(seed), odd_rows(seed + 10)]
    for i, rows in enumerate(files):
        write(tmp_path / f"{i}.csv", rows, terminator, tail=terminator * 2 * i)
    found = read_raw_csv(spark, str(tmp_path), multiline=True, with_position=True)
    assert found.columns == ["k", "some text", "z", FILE, BLOCK, LINE]
    assert found.select(FILE, BLOCK).distinct().count() > 10
    numbered = number_file_rows(found).orderBy("id").collect()
    # An empty cell is NULL, quoted or not.
    expected = [tuple(cell or None for cell in row) for rows in files for row in rows]
    assert [tuple(r)[:3] for r in numbered] == expected
    assert [r["id"] for r in numbered] == list(range(1, len(expected) + 1))


def test_a_row_that_fills_whole_parts(spark, tmp_path, small_parts):
    long = 'line, "quoted"\n' * 1000
    rows = [["1", "a", "b"], ["2", long, "c"], ["3", "d", "e"], ["4", long, ""], ["5", "f\ng", "h"]]
    write(tmp_path / "a.csv", rows)
    found = read_raw_csv(spark, str(tmp_path), multiline=True).collect()
    assert sorted(map(tuple, found)) == [tuple(c or None for c in row) for row in rows]


def test_another_separator_and_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x;"y ""z"""\n"1;2";"3\n4"\n')
    found = read_raw_csv(spark, str(tmp_path), sep=";", multiline=True)
    assert found.columns == ["x", 'y "z"'] and list(map(tuple, found.collect())) == [("1;2", "3\n4")]
    (tmp_path / "a.csv").write_text("x;y\n")
    assert read_raw_csv(spark, str(tmp_path), sep=";", multiline=True).count() == 0


USES = {"count": lambda df: df.count(), "one column": lambda df: df.select("a").collect(), "all": lambda df: df.collect()}


@pytest.mark.parametrize("multiline", [False, True])
@pytest.mark.parametrize("use", USES)
@pytest.mark.parametrize("bad", ["4,5,6,7\n8,9", "8,9", "4,5,6,7"])
def test_other_widths_are_refused_whatever_is_read(spark, tmp_path, multiline, use, bad):
    (tmp_path / "a.csv").write_text(f"a,b,c\n1,2,3\n{bad}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        USES[use](read_raw_csv(spark, str(tmp_path), multiline=multiline))


@pytest.mark.parametrize("bad", ['1,"x\n', '1,x"y\n2,"z\nq"\n'])
def test_quotes_that_do_not_pair_up_are_refused(spark, tmp_path, bad):
    (tmp_path / "a.csv").write_text("a,b\n" + bad)
    with pytest.raises(Exception, match="not closed"):
        read_raw_csv(spark, str(tmp_path), multiline=True).count()


@pytest.mark.parametrize("bad", ['1,x"y\n2,z"q\n', '1,"x"y\n', '1,x"y"\n', '1,x "y,z" q\n'])
def test_stray_quotes_that_pair_up_are_refused(spark, tmp_path, bad):
    (tmp_path / "a.csv").write_text("a,b\n" + bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(tmp_path), multiline=True).count()


def test_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="another header"):
        read_raw_csv(spark, str(tmp_path), multiline=True).count()


def test_a_ragged_file_with_an_unused_column_stops_the_job(spark, tmp_path, database):
    rows = [f"{i}.5,a,{i},unused" for i in range(20)]
    rows[7], rows[9] = "1.5,a,1,unused,2,3", "1.5,a,1"
    (tmp_path / "a.csv").write_text("alcohol,type,quality,other\n" + "\n".join(rows) + "\n")
    columns = Columns(num=["alcohol"], cat=["type"], target="quality")
    with pytest.raises(Exception, match="(?i)malformed"):
        prepare(spark, str(tmp_path / "a.csv"), columns, {}, f"{database}.train", f"{database}.test")


def test_lines_are_not_shuffled(spark, tmp_path, small_parts):
    """Both passes read the text in place; only counts, and rows over the ends of parts, move."""
    write(tmp_path / "a.csv", odd_rows(3))
    found = read_raw_csv(spark, str(tmp_path), multiline=True)
    plan = found.select("k").where(F.col("k") > "1")._jdf.queryExecution().executedPlan().toString()
    whole, pieces = plan.split("SortMergeJoin" if "SortMergeJoin" in plan else "BroadcastHashJoin", 1)
    assert "Union" in whole and "Scan parquet" in plan
