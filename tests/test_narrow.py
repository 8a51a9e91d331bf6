"""Months side by side in one number: nothing is lost, and the shuffle has no others."""

import re

import pyarrow.parquet as pq
import pytest

from suite.queries import queries
from tallymill.operators.narrow import narrowed, widened
from tallymill.operators.reconcile import match
from tallymill.schema import MONTHS
from tallymill.session import RUN_SETTINGS, tune
from tests.frames import inc, increments, rep, reports

EDGES = [
    None, 0, 1, -1, 32767, -32767, 32768, -32768, 65535, 2**31, 2**63 - 1, -(2**63),
]


@pytest.fixture
def settings(spark):
    """Those a session had come back, as other tests share it."""
    before = {k: spark.conf.get(k) for k in RUN_SETTINGS}
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def months(spark, rows, kinds=("bigint",) * 12):
    columns = ", ".join(f"{c} {kind}" for c, kind in zip(MONTHS, kinds))
    return spark.createDataFrame(rows, f"id int, {columns}, rest string")


def test_numbers_come_back(spark):
    rows = [(0, *EDGES, "a"), (1, *[None] * 12, None)]
    rows += [(2 + i, *[EDGES[(i + m) % 5] for m in range(12)], "b") for i in range(5)]
    rows += [(9 + i, *[e] * 12, "c") for i, e in enumerate(EDGES)]
    frame = months(spark, rows)
    back = widened(narrowed(frame).repartition(3), frame)
    assert back.columns == frame.columns
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == rows


def test_other_kinds_and_missing_columns_stay(spark):
    kinds = ("int", "string", "double", *["bigint"] * 9)
    row = (0, 5, "x", 1.5, *range(9), "a")
    frame = months(spark, [row], kinds).drop("MES_12")
    back = widened(narrowed(frame), frame)
    assert back.dtypes == frame.dtypes
    assert [tuple(r) for r in back.collect()] == [(*row[:12], "a")]
    bare = frame.select("id", "rest")
    assert narrowed(bare) is bare and widened(bare, bare) is bare


def test_matched_rows_keep_large_months(spark):
    incs = increments(spark, inc() | {"MES_01": 2**40}, inc(2) | {"MES_12": -9})
    found = match(incs, reports(spark, rep())).select("MES_01", "MES_02", "MES_12").collect()
    assert sorted(map(tuple, found), key=str) == [(2**40, None, None), (None, None, -9)]


def test_wide_rows_are_shuffled_without_months(spark):
    plan = match(increments(spark, inc()), reports(spark, rep()))._jdf.queryExecution()
    below = plan.executedPlan().toString().split("Exchange hashpartitioning(xxhash64(_unit")[1]
    shuffled = re.search(r"Project \[(.*)\]", below).group(1)
    while (plain := re.sub(r"\([^()]*\)", "", shuffled)) != shuffled:
        shuffled = plain
    names = [re.sub(r"#\d+L?$", "", c.split(" AS ")[-1].strip()) for c in shuffled.split(",")]
    assert "_side_by_side0" in names and not {*names} & {*MONTHS}


def test_published_files_are_zstd(spark, sf_dir, settings):
    files = [f.removeprefix("file:") for f in queries()["publish_routing"](spark, sf_dir).inputFiles()]
    found = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert found == {"ZSTD"}


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = blocks.diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_shuffle_files_go_with_their_query(spark, settings):
    tune(spark)
    before = shuffle_files(spark)
    rows = spark.range(1000).repartition(7, "id")
    for _ in range(2):  # the second run finds none left of the first
        rows.write.format("noop").mode("overwrite").save()
        assert rows.count() == 1000
    assert shuffle_files(spark) <= before
