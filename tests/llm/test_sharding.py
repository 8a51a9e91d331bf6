"""Sharding: even counts, whole groups, gapless slots."""

import zlib
from collections import Counter, defaultdict

import pytest

from tallymill.llm import sharding
from tests.llm import messy


def check(rows, texts, shards=sharding.SHARDS):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    counts, slots = Counter(r.shard for r in rows), defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    full = [counts.get(s, 0) for s in range(shards)]
    assert max(full) - min(full) <= 1 and sum(full) == len(rows)
    assert all(sorted(v) == [*range(len(v))] for v in slots.values())


def cut(rows, texts):
    """Shards per text that occurs more than once."""
    by_crc, often = defaultdict(set), Counter(t for _, t in texts if t is not None)
    for r in rows:
        by_crc[r.text_crc32].add(r.shard)
    return {t: len(by_crc[zlib.crc32(t.encode())]) for t, n in often.items() if n > 1}


def test_whole_table(spark, sf_dir):
    documents = messy.table(spark, sf_dir, "documents")
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    rows = sharding.shard_report(documents).collect()
    check(rows, texts)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert set(cut(rows, texts).values()) == {1}


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_awkward_documents(spark, shards):
    rows = sharding.assign_shards(messy.documents(spark), shards).collect()
    check(rows, messy.TEXTS, shards)


def test_groups_of_all_sizes(spark):
    """A third of all rows are copies of one text; others fill up the rest."""
    texts = [(i, "hot") for i in range(400)] + [(400 + i, f"g{i // 9}") for i in range(540)]
    texts += [(1000 + i, f"single {i}") for i in range(260)]
    rows = sharding.assign_shards(messy.documents(spark, texts), 10).collect()
    check(rows, texts, 10)
    shards = cut(rows, texts)
    assert shards.pop("hot") == 4  # its parts fill three shards and some of a fourth
    assert set(shards.values()) == {1}


def test_results_do_not_depend_on_partitions(spark):
    texts = [(i, f"t{i % 70}") for i in range(300)]
    one, two = (
        {(r.doc_id, r.shard, r.slot) for r in sharding.assign_shards(frame, 7).collect()}
        for frame in (
            messy.documents(spark, texts).repartition(5),
            messy.documents(spark, texts[::-1]).coalesce(1),
        )
    )
    assert one == two


def test_ranks_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_CHUNK", 10)
    texts = [(i, f"t{i % 70}") for i in range(300)]
    check(sharding.assign_shards(messy.documents(spark, texts), 7).collect(), texts, 7)


def test_as_many_rounds_as_it_takes(spark, monkeypatch):
    """One unit a round: all groups are gathered, and none is scattered while it fits."""
    grant = sharding.granted
    monkeypatch.setattr(sharding, "granted", lambda *a: grant(*a).orderBy("link").limit(1))
    monkeypatch.setattr(sharding, "staged", lambda df, purpose: kept(df))
    monkeypatch.setattr(sharding, "release", lambda *frames: None)

    def kept(df):
        return df.sparkSession.createDataFrame(df.collect(), df.schema).coalesce(1)

    texts = [(i, f"g{i // 2}") for i in range(44)] + [(100 + i, f"single {i}") for i in range(8)]
    rows = sharding.assign_shards(messy.documents(spark, texts), 3).collect()
    check(rows, texts, 3)
    assert set(cut(rows, texts).values()) == {1}


def test_one_doc_id_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_CHUNK", 10)
    texts = [(7, f"t{i}") for i in range(300)]
    rows = sharding.described(messy.documents(spark, texts))
    sizes = sharding.ranked(rows, [], "rank", 300)
    assert sorted(r.rank for r in sizes.collect()) == [*range(300)]
    check(sharding.assign_shards(messy.documents(spark, texts), 7).collect(), texts, 7)


def test_empty_table(spark):
    assert sharding.assign_shards(messy.documents(spark, [])).count() == 0
