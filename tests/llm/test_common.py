"""Components, staging and samples."""

import random

import pytest
from pyspark.sql import functions as F

from tallymill.llm import common
from tests.llm import messy


def plain(links):
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {i: find(i) for i in root}


RANDOM = random.Random(1)
CASES = {
    "none": [],
    "loops": [(1, 1), (2, 2)],
    "chain": [(i, i + 1) for i in range(60)],
    "shuffled chain": [((7 * i) % 101, (7 * i + 7) % 101) for i in range(80)],
    "star": [(500, i) for i in range(400)],
    "random": [(RANDOM.randrange(300), RANDOM.randrange(300)) for _ in range(200)],
    "twice": [(5, 3), (3, 5), (5, 3), (9, 5)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = CASES[name]
    rows = common.components(spark.createDataFrame(links, "a long, b long")).collect()
    got = {r.id: r.root for r in rows}
    assert len(got) == len(rows)
    assert got == {i: root for i, root in plain(links).items() if i != root}


def test_staged_rows_and_their_release(spark):
    frame = common.staged(spark.range(5), "test")
    assert frame.count() == 5
    common.release(frame)
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        spark.read.parquet(frame.staged_at)


def test_sample_is_bounded_and_the_same_every_time(spark):
    """Also where one id has most of the rows."""
    rows = [(i, f"t{i}") for i in range(50)] + [(7, f"copy {i}") for i in range(200)]
    labels = [(i, i % 2, 0, "x") for i in range(60)] + [(3, None, None, "y")]
    draw = [
        common.labelled_sample(
            messy.documents(spark, order), messy.labels(spark, labels), "quality", F.lit(True), 20
        ).collect()
        for order in (rows, rows[::-1])
    ]
    assert sorted(draw[0]) == sorted(draw[1]) and 10 <= len(draw[0]) <= 20
    assert len({r.doc_id for r in draw[0]}) == len(draw[0])


def test_unused_names(spark):
    assert common.unused_name(messy.documents(spark), "Score".lower()) == "score_"
