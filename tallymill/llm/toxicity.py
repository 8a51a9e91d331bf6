"""Toxicity: FTRL-proximal logistic regression over hashed word features.

A document's features are the distinct hashes of its words, their first letters,
word pairs and skip pairs.  Learning rates are kept per coordinate, and L1 leaves
most weights at zero, so the model is a short list of (place, weight) that
every task gets.  It is learned from at most SAMPLE labelled documents, in one
task, in the order of a hash of their ids.

Defined results: a null or empty text scores by the intercept alone; without
any labelled row every score is 0; texts of any length are read whole; equal
texts score alike; an empty table gives no rows; further columns are ignored by
`score` and kept by `keep_clean`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import fold_of, labelled_sample, texts_of, unused_name
from tallymill.llm.words import Words, mixed

SAMPLE = 16_000
PLACES = 1 << 20
STEM_BYTES = (4, 5, 6, 7)
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.0
FOLDS, HELD_OUT = 5, 0
SALTS = [np.uint64(pow(0xA24BAED4963EE407, k, 1 << 64)) for k in range(1, 7)]
THRESHOLD = 0.5

SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def places(text: str) -> np.ndarray:
    """Where the features of a text lie; a place may occur more than once."""
    words = Words(text)
    one = words.hashes()
    found = [one]
    for salt, size in zip(SALTS, STEM_BYTES):
        found.append(words.hashes(size)[words.ends - words.starts > size] * salt)
    found.append(one[:-1] * SALTS[-2] + one[1:])
    found.append(one[:-2] * SALTS[-1] + one[2:])
    return (mixed(np.concatenate(found)) >> np.uint64(44)).astype(np.int64)


@dataclass
class Model:
    """Nonzero weights by place, sorted, and the intercept."""

    place: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        table = np.zeros(PLACES, dtype=np.float32)
        table[self.place] = self.weight
        return table


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[np.ndarray, int]]) -> Model:
    """FTRL-proximal over (distinct places, label), EPOCHS times in order.

    The weight of a coordinate follows from z, the sum of gradients shifted by
    what the weights moved, and n, the sum of squared gradients; it is zero
    while |z| stays within L1.  The intercept, at the last place, has no L1.
    """
    z, n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    penalty = np.array([L1])

    def weights(at: np.ndarray) -> np.ndarray:
        own, squares = z[at], n[at]
        bound = np.where(at == PLACES, 0.0, penalty)
        w = -(own - np.sign(own) * bound) / ((BETA + np.sqrt(squares)) / ALPHA + L2)
        return np.where(np.abs(own) <= bound, 0.0, w)

    for _ in range(EPOCHS):
        for found, label in rows:
            at = np.append(found, PLACES)
            w = weights(at)
            gradient = _sigmoid(w.sum()) - label
            squares = n[at]
            grown = squares + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares)) / ALPHA * w
            n[at] = grown
    kept = np.flatnonzero(np.abs(z[:PLACES]) > L1)
    return Model(kept, weights(kept), float(weights(np.array([PLACES]))[0]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(places(t)).astype(np.int32) for t in texts_of(batch)]
        if not found:
            continue
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("turn"), batch.column("label"), lists], names=["turn", "label", "found"]
        )


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        values, offsets = batch.column(2).values.to_numpy(), batch.column(2).offsets.to_numpy()
        rows += [
            (values[a:b].copy(), y)
            for a, b, y in zip(offsets[:-1], offsets[1:], batch.column(1).to_pylist())
        ]
    if rows:
        model = fit(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(model.place, PLACES), pa.int32()),
                pa.array(np.append(model.weight, model.intercept), pa.float64()),
            ],
            names=["place", "weight"],
        )


def train(documents: DataFrame, labels: DataFrame) -> Model | None:
    """The model has at most PLACES weights, which is what the driver gets."""
    sample = labelled_sample(
        documents, labels, "toxic", fold_of("doc_id", FOLDS) != HELD_OUT, SAMPLE
    )
    rows = (
        sample.select("turn", "label", "text")
        .mapInArrow(_features, "turn long, label int, found array<int>")
        .repartition(1)
        .sortWithinPartitions("turn", "label", "found")
        .mapInArrow(_fit_task, "place int, weight double")
        .orderBy("place")
        .toPandas()
    )
    if rows.empty:
        return None
    place, weight = rows["place"].to_numpy(), rows["weight"].to_numpy()
    return Model(place[:-1].copy(), weight[:-1].copy(), float(weight[-1]))


def scored(documents: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """The documents with their toxicity score in a column of this name."""
    if model is None:
        return documents.withColumn(name, F.lit(0.0))

    @F.pandas_udf("double")
    def of_texts(texts):
        import pandas as pd

        table = model.dense()
        out = []
        for text in texts:
            at = places(text or "")
            at = np.unique(at[table[at] != 0])
            out.append(model.intercept + float(table[at].sum(dtype=np.float64)))
        return pd.Series(_sigmoid(np.array(out, dtype=np.float64)))

    return documents.withColumn(name, of_texts("text"))


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(documents.select("doc_id", "text"), train(documents, labels))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, model: Model | None) -> DataFrame:
    """Rows and columns of the documents that are not predicted toxic."""
    name = unused_name(documents, "score")
    return scored(documents, model, name).where(F.col(name) < THRESHOLD).drop(name)
