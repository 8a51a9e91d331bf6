"""The rule ensemble: rules, lasso, compiled column, held-out accuracy."""

import math
import zlib

import numpy as np
import pytest

from tallymill.llm import quality, queries
from tests.llm import messy


def test_rules_are_paths():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(quality.STATISTICS)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    rules = quality.grown_rules(x, y)
    assert {len(r.terms) for r in rules} <= {1, 2, 3}
    model = quality.fit(x, y)
    assert 0 < len(model.rules) < len(rules)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.98


def test_tightest_bounds_are_kept():
    rule = quality.simplified([(1, True, 0.2), (1, True, 0.4), (1, False, 0.9), (1, False, 0.7)])
    assert rule.terms == ((1, False, 0.7), (1, True, 0.4))


def test_lasso_meets_the_conditions_of_its_optimum():
    rng = np.random.default_rng(3)
    hits = (rng.random((800, 12)) < 0.4).astype(float)
    y = (rng.random(800) < 1 / (1 + np.exp(-(2 * hits[:, 0] - 1)))).astype(float)
    w, b = quality.lasso(hits, y)
    gradient = hits.T @ (1 / (1 + np.exp(-(hits @ w + b))) - y) / len(y)
    on = w != 0
    assert np.allclose(gradient[on], -np.sign(w[on]) * quality.PENALTY, atol=2e-4)
    assert (np.abs(gradient[~on]) <= quality.PENALTY + 2e-4).all()


def test_column_equals_the_model(spark):
    rng = np.random.default_rng(4)
    x = rng.random((300, len(quality.STATISTICS)))
    model = quality.fit(x, (x[:, 0] + x[:, 3] > 1).astype(float))
    frame = spark.createDataFrame(x.tolist(), [*quality.STATISTICS]).selectExpr(
        f"struct({', '.join(quality.STATISTICS)}) AS stats"
    )
    got = [r[0] for r in frame.select(model.column()).collect()]
    assert got == pytest.approx(model.scores(x).tolist())


def test_statistics():
    values = dict(zip(quality.STATISTICS, quality.statistics("One two, two!\nOne two, two!\n")))
    assert values["words"] == 6 and values["distinct_words"] == pytest.approx(2 / 6)
    assert values["repeated_lines"] == 0.5 and values["words_per_line"] == 3
    assert set(quality.statistics("")) == {0.0}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = messy.table(spark, folder, "labels")
    rows = (
        quality.score(messy.table(spark, folder, "documents"), labels)
        .join(labels, "doc_id")
        .where("held_out")
        .collect()
    )
    poor, good = ([r.predicted for r in rows if r.quality == y] for y in (0, 1))
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.05 * len(poor)


def test_query_against_a_plain_version(spark):
    """From labels to scores, row by row, over the whole table."""
    folder = "/root/testdata/sf0.01"
    documents = messy.table(spark, folder, "documents").select("doc_id", "text").collect()
    turns = messy.table(spark, folder, "labels").selectExpr(
        "doc_id", "quality", "xxhash64(doc_id, 'quality') AS turn"
    )
    labels = {r.doc_id: (r.turn, r.quality) for r in turns.collect()}
    fold = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 for r in documents}
    stats = {r.doc_id: [float(v) for v in quality.statistics(r.text or "")] for r in documents}
    learn = sorted(
        (*labels[i], *stats[i], i) for i in stats if i in labels and fold[i] != 2 and labels[i][1] is not None
    )
    model = quality.fit(
        np.array([row[2:-1] for row in learn]), np.array([row[1] for row in learn], dtype=float)
    )
    want = {}
    for i, x in stats.items():
        logit = model.intercept
        for rule, weight in zip(model.rules, model.weights):
            if all(x[s] > bound if above else x[s] <= bound for s, above, bound in rule.terms):
                logit += weight
        want[i] = 1 / (1 + math.exp(-logit))
    rows = queries.QUERIES["op7_quality_rules"](spark, folder).collect()
    assert {r.doc_id: r.score for r in rows} == pytest.approx(want, abs=1e-9)
    assert all(r.held_out == (fold[r.doc_id] == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    assert len({*want.values()}) > 10


def test_awkward_documents(spark):
    documents = messy.documents(spark)
    rows = quality.score(documents, messy.labels(spark)).collect()
    assert {(r.score, r.predicted) for r in rows} == {(1.0, 1)} and len(rows) == len(messy.TEXTS)
    labels = messy.labels(spark, [(i, i % 2, 0, "") for i in range(1, 15)] + [(None, 1, 1, "")])
    scores = {}
    for r in quality.score(documents, labels).collect():
        assert 0 < r.score < 1 and r.predicted == (r.score >= 0.7)
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert scores[4] == scores[5] and scores[1] == scores[2]
    model = quality.train(documents, labels)
    assert quality.keep_good(documents, model).columns == documents.columns
    assert quality.score(messy.documents(spark, []), labels).count() == 0
