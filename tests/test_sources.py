"""Drop folder and report table."""

import os
import subprocess
import sys
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from suite import projection
from suite.queries import drop_snapshots
from tallymill.sources.folders import entries
from tallymill.sources.reports import read_reports
from tallymill.sources.snapshot import newest_snapshot, read_snapshot


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_reads_every_column_as_text(spark, tmp_path):
    put(tmp_path, "day.csv", 'INSTALACAO,STATUS,MUNICIPIO\n00123,ATIVO,"PORTO ""ALEGRE"""\n456,n/a,\n')
    got = read_snapshot(spark, str(tmp_path))
    assert got.columns == ["INSTALACAO", "STATUS", "MUNICIPIO"]
    assert set(dict(got.dtypes).values()) == {"string"}
    assert {tuple(r) for r in got.collect()} == {
        ("00123", "ATIVO", 'PORTO "ALEGRE"'), ("456", None, None),
    }


def test_words_for_missing_can_be_kept(spark, tmp_path):
    put(tmp_path, "day.csv", "A\nn/a\n")
    assert read_snapshot(spark, str(tmp_path), missing=[]).first()["A"] == "n/a"


def test_newest_name_wins_whatever_its_format(spark, tmp_path):
    put(tmp_path, "2026-01-01.csv", "A\n1\n")
    put(tmp_path / "2026-01-03.csv", "part-0.csv", "A\n3\n")
    put(tmp_path / "2026-01-03.csv", "_SUCCESS", "")
    put(tmp_path / "2026-01-08.csv", "part-0.csv", "A\n8\n")  # not finished
    put(tmp_path / "older" / "2026-02-01.csv", "part-0.csv", "A\n7\n")
    put(tmp_path, "2026-01-02.csv", "A\n2\n")
    put(tmp_path, "2026-01-09.txt", "A\n9\n")
    assert read_snapshot(spark, str(tmp_path)).first()["A"] == "3"
    spark.range(5, 6).withColumnRenamed("id", "A").write.parquet(str(tmp_path / "2026-01-04.parquet"))
    assert newest_snapshot(spark, str(tmp_path)).endswith("/2026-01-04.parquet")
    got = read_snapshot(spark, str(tmp_path))
    assert (got.first()["A"], got.dtypes) == ("5", [("A", "string")])


def test_folder_without_snapshot(spark, tmp_path):
    put(tmp_path, "notes.txt", "x")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, str(tmp_path / "nowhere"))


def parts(folder, *texts):
    for n, text in enumerate(texts):
        put(folder / "day.csv", f"part-{n}.csv", text)
    put(folder / "day.csv", "_SUCCESS", "")


def test_parts_with_another_header_stop_the_run(spark, tmp_path):
    parts(tmp_path, "A,B\n1,2\n", "B,A\n3,4\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="header does not conform"):
        read_snapshot(spark, str(tmp_path)).collect()


def test_parts_with_one_header_are_read_together(spark, tmp_path):
    parts(tmp_path, "A,B\n1,2\n", 'A,B\n"3",\n')
    assert {tuple(r) for r in read_snapshot(spark, str(tmp_path)).collect()} == {("1", "2"), ("3", None)}


@pytest.mark.parametrize("rows", ['1,"two\nlines"', "1", "1,2,3"])
def test_torn_rows_stop_the_run(spark, tmp_path, rows):
    put(tmp_path, "day.csv", f"A,B\n0,0\n{rows}\n")
    with pytest.raises(PySparkException, match="number of cells"):
        read_snapshot(spark, str(tmp_path)).select("A").collect()


def test_cells_with_line_breaks(spark, tmp_path):
    put(tmp_path, "day.csv", 'A,B\n1,"two\nlines"\n')
    assert read_snapshot(spark, str(tmp_path), multi_line=True).first() == ("1", "two\nlines")


def test_reports_from_table_and_path(spark, tmp_path):
    path = str(tmp_path / "reports")
    spark.sql(
        "SELECT '0012' `UC / MD`, '109' COD, '2026-01-02' DATA_EXECUCAO,"
        " string(null) `DATA BAIXADO`, 'T' EQUIPE, 'SUL' REGIONAL"
    ).write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW general_reports AS SELECT * FROM parquet.`{path}`")
    by_path, by_table = read_reports(spark, path=path), read_reports(spark, table="general_reports")
    assert by_path.collect() == by_table.collect()
    assert by_path.columns == [
        "instalacao", "irregularidade", "data_exec_rep", "data_baixa_rep", "equipe",
        "hora_exec_rep",
    ]
    assert "REGIONAL" not in by_path._jdf.queryExecution().executedPlan().toString()


SCRIPT = """
import sys
from pyspark.sql import SparkSession
from tallymill.sinks.shared import run_folder
conf = {"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
assert run_folder(spark) == run_folder(spark) and run_folder(spark).startswith(sys.argv[1])
spark.range(3).write.parquet(f"{run_folder(spark)}/a")
spark.range(3).write.parquet(f"{sys.argv[1]}/kept")
raise SystemExit(int(sys.argv[2]))
"""


@pytest.mark.parametrize("code", [0, 1])
def test_run_folder_goes_when_the_application_ends(tmp_path, code):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path), str(code)], cwd=root, capture_output=True
    )
    assert done.returncode == code, done.stderr
    for _ in range(100):  # the JVM ends a little later
        if not [*tmp_path.glob("run-*")]:
            assert (tmp_path / "kept").exists()
            return
        time.sleep(0.1)
    raise AssertionError([*tmp_path.rglob("*")])


def test_the_drop_folder_of_the_queries_is_compressed(spark, sf_dir):
    """And is read as it was written."""
    newest = newest_snapshot(spark, drop_snapshots(spark, sf_dir))
    parts = [path for path, _ in entries(spark, newest) if "part-" in path]
    assert parts and all(path.endswith(".csv.gz") for path in parts)
    read = read_snapshot(spark, newest.rsplit("/", 1)[0], missing=[""])
    raw = projection.raw_increments(spark, sf_dir)
    blank_as_null = raw.select([F.nullif(F.col(c), F.lit("")).alias(c) for c in raw.columns])
    assert read.exceptAll(blank_as_null).count() == 0
    assert blank_as_null.exceptAll(read).count() == 0
