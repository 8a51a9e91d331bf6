"""The corpus pipeline: raw documents in, packed token sequences out.

Toxic documents go, then poor ones, then all but one of each group of near
duplicates; secrets are replaced in what stays, and the rest is packed.  A
stage's rows are written to the folder that all executors share before the next
stage reads them, so a lost executor repeats a part of one stage at most.

Documents that cannot be judged stay: without labels no classifier rejects, and
rows without id are in no group of duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymill.llm import packing, quality, secret_scan, toxicity, weighted_minhash
from tallymill.llm.common import release, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weighted_minhash.keep_first(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("packing", pack),
]

# Learned scores, verified similarities and tokens are beyond SQL; the pipeline
# is tested against a plain version of each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
