"""FTRL-proximal against a plain version, and accuracy on held-out rows."""

import math

import numpy as np
import pytest

from tallymill.llm import toxicity
from tallymill.llm.words import Words
from tests.llm import messy


def plain_fit(rows):
    """One coordinate at a time, in Python numbers."""
    z, n = {}, {}

    def weight(i):
        own, squares = z.get(i, 0.0), n.get(i, 0.0)
        bound = 0.0 if i == toxicity.PLACES else toxicity.L1
        if abs(own) <= bound:
            return 0.0
        return -(own - math.copysign(bound, own)) / (
            (toxicity.BETA + math.sqrt(squares)) / toxicity.ALPHA + toxicity.L2
        )

    for _ in range(toxicity.EPOCHS):
        for found, label in rows:
            at = [*found, toxicity.PLACES]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in at:
                grown = n.get(i, 0.0) + g * g
                z[i] = z.get(i, 0.0) + g - (
                    math.sqrt(grown) - math.sqrt(n.get(i, 0.0))
                ) / toxicity.ALPHA * w[i]
                n[i] = grown
    return {i: weight(i) for i in z if weight(i)}


def test_fit_equals_plain_version():
    rng = np.random.default_rng(2)
    rows = [(np.unique(rng.integers(0, 40, 8)), int(rng.random() < 0.4)) for _ in range(200)]
    model = toxicity.fit(rows)
    plain = plain_fit([(f.tolist(), y) for f, y in rows])
    intercept = plain.pop(toxicity.PLACES)
    assert dict(zip(model.place.tolist(), model.weight)) == pytest.approx(plain)
    assert model.intercept == pytest.approx(intercept)


def test_word_hashes_depend_on_the_word_alone():
    a, b = Words("Alpha beta, ALPHA").hashes(), Words("... çalpha x alpha").hashes()
    assert a[0] == a[2] == b[-1] and a[0] not in (a[1], b[0])
    assert Words("alphabet").hashes(5)[0] == Words("alpha").hashes(5)[0]
    assert len(Words("").hashes()) == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = messy.table(spark, folder, "labels")
    rows = (
        toxicity.score(messy.table(spark, folder, "documents"), labels)
        .join(labels, "doc_id")
        .where("held_out")
        .collect()
    )
    clean, toxic = ([r.predicted for r in rows if r.toxic == y] for y in (0, 1))
    assert sum(clean) <= 0.01 * len(clean) and sum(toxic) >= 0.8 * len(toxic)


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    documents = messy.table(spark, sf_dir, "documents")
    labels = messy.table(spark, sf_dir, "labels")
    other = labels.selectExpr(
        "doc_id", "quality",
        "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END toxic",
    )
    one, two = toxicity.train(documents, labels), toxicity.train(documents, other)
    assert np.array_equal(one.weight, two.weight) and one.intercept == two.intercept


def test_awkward_documents(spark):
    documents = messy.documents(spark)
    rows = toxicity.score(documents, messy.labels(spark)).collect()
    assert {r.score for r in rows} == {0.0} and len(rows) == len(messy.TEXTS)
    labels = messy.labels(spark, [(4, 1, 1, "x"), (10, 1, 0, "y"), (None, 1, 1, "z"), (7, None, None, "")])
    model = toxicity.train(documents, labels)
    scores = {}
    for r, text in [(r, dict(messy.TEXTS).get(r.doc_id)) for r in toxicity.score(documents, labels).collect()]:
        assert 0 < r.score < 1 and r.predicted == (r.score >= 0.5)
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert scores[4] == scores[5] == scores[6] and scores[1] == scores[2]
    kept = toxicity.keep_clean(documents, model)
    assert kept.columns == documents.columns
    assert toxicity.score(messy.documents(spark, []), labels).count() == 0
