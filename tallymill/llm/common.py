"""What several operators of this subpackage share."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.sinks.shared import run_folder
from tallymill.sources.folders import drop


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def staged(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Write df to the run's folder below spark.checkpoint.dir and read it again.

    Cuts the lineage in a place all executors reach: a lost executor costs the
    running tasks only, and what was expensive is not made twice.  What `release` does
    not remove, as a result still reads it or a run has failed, goes when the
    application ends.
    """
    spark = session_of(df)
    path = f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Remove what `staged` has written for these; nothing may read it again."""
    for frame in frames:
        drop(session_of(frame), frame.staged_at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_name(df: DataFrame, stem: str) -> str:
    """stem, made longer until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Python strings of a column; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def parts_of(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of batches in order, in batches of at most so many bytes or one row: what
    a task makes of a batch takes memory in proportion to it."""
    for batch in batches:
        if batch.nbytes > size and batch.num_rows > 1:
            half = batch.num_rows // 2
            yield from parts_of((batch.slice(0, half), batch.slice(half)), size)
        else:
            yield batch


def text_slices(texts: list[str], chars: int = 2_000_000) -> Iterator[slice]:
    """Consecutive slices of about so many characters, whatever a batch holds."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield slice(start, at + 1)
            start, held = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


@functools.cache
def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold_of(doc_id, folds: int) -> F.Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, may_learn: F.Column, rows: int
) -> DataFrame:
    """At most `rows` labelled documents as (doc_id, text, label, turn).

    The rows are those of the smallest hash of doc_id, in the order of turn, so
    the sample is the same wherever it is drawn.  Only ids and labels are
    sorted; the list that is broadcast has at most `rows` rows of 20 bytes.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & may_learn)
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id", F.lit(label)))
        .orderBy("turn", "doc_id")
        .limit(rows)
    )
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = narrow.join(F.broadcast(chosen), "doc_id")
    # Rows of one id are one document, or a single id could exceed the bound.
    return sample.groupBy("doc_id", "label", "turn").agg(F.min("text").alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest id reachable from each id of links(a, b); returns (id, root).

    Large-star and small-star rounds on the links alone, each round staged in
    the shared folder, until the links stop changing.  A round keeps one row
    per (node, smaller neighbour); every node ends linked to its root only.
    A hot node's neighbours are reduced to their minimum by partial
    aggregation and met again by a join that adaptive execution can split.
    """
    edges = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        purpose,
    )
    while True:
        # Large star: neighbours above a node are linked to its least neighbour.
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(
            edges.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        least = both.groupBy("n").agg(F.least("n", F.min("m")).alias("root"))
        large = (
            both.where("m > n")
            .join(least, "n")
            .select(F.col("m").alias("hi"), F.col("root").alias("lo"))
            .distinct()
        )
        # Small star: a node and its lower neighbours are linked to the least.
        low = large.groupBy("hi").agg(F.min("lo").alias("root"))
        small = large.join(low, "hi").select(
            F.explode(
                F.array(
                    F.struct(F.col("hi").alias("hi"), F.col("root").alias("lo")),
                    F.struct(F.col("lo").alias("hi"), F.col("root").alias("lo")),
                )
            ).alias("e")
        )
        after = staged(small.select("e.*").where("hi <> lo").distinct(), purpose)
        done = _print_of(after) == _print_of(edges)
        release(edges)
        if done:
            return after.select(F.col("hi").alias("id"), F.col("lo").alias("root"))
        edges = after


def _print_of(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo") % 1_000_000_007)
        ).first()
    )
