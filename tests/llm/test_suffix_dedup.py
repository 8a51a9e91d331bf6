"""Removal of repeated strings: against a table of all of them."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymill.llm import queries, suffix_dedup
from tallymill.sinks.shared import run_folder
from tests.llm import messy

SIZE = suffix_dedup.LENGTH


def plain(texts):
    """Rows of the digest, from a count of all strings of SIZE bytes."""
    raws = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(hash(r[p : p + SIZE]) for _, r in raws for p in range(len(r) - SIZE + 1))
    rows = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 2, dtype=bool)
        for p in range(len(raw) - SIZE + 1):
            if seen[hash(raw[p : p + SIZE])] > 1:
                gone[p + 1 : p + SIZE + 1] = True
        kept = bytes(b for b, g in zip(raw, gone[1:]) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum())
        rows.append((i, len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(rows)


def result(documents):
    kept = suffix_dedup.remove_repeats(documents)
    return Counter(tuple(r) for r in suffix_dedup.digest(kept).collect())


def letters(rng, n, alphabet="abcdefghij  "):
    return "".join(rng.choices(alphabet, k=n))


def overlapping(seed):
    """Documents that share pieces of all lengths about SIZE, at many places."""
    rng = random.Random(seed)
    shared = [letters(rng, rng.randint(150, 700)) for _ in range(6)]
    out = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(0, 4)):
            piece = rng.choice(shared)
            a = rng.randint(0, len(piece) - 120)
            text += letters(rng, rng.choice([0, 0, 3, 90, 300])) + piece[a : a + rng.randint(100, 650)]
        if rng.random() < 0.2:
            text += letters(rng, rng.randint(1, 80)) * rng.randint(2, 9)
        if rng.random() < 0.2 and out:
            text = rng.choice(out)[1]
        if rng.random() < 0.2 and len(text) > 300:
            k = rng.randrange(len(text))
            text = text[:k] + "é" + text[k + 1 :]
        out.append((i, text))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("large", [2000, 1])
def test_overlapping_pieces(spark, monkeypatch, seed, large):
    """Also where every group counts as large and is cut by further anchors."""
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    texts = overlapping(seed)
    assert result(messy.documents(spark, texts)) == plain(texts)


def test_whole_table(spark, sf_dir):
    documents = messy.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = queries.QUERIES["op11_suffix_dedup"](spark, sf_dir).collect()
    want = plain([tuple(r) for r in documents.collect()])
    assert Counter(tuple(r) for r in rows) == want
    assert sum(r[2] for r in want) > 1000


def test_awkward_documents(spark):
    """Also a passage that many documents share, and a group of copies."""
    rng = random.Random(3)
    line, copy = letters(rng, 230), letters(rng, 400)
    texts = [*messy.TEXTS, (20, "ab" * 400), (21, "ab" * 150 + "c" + "ab" * 150)]
    texts += [(100 + i, letters(rng, 150) + line + letters(rng, 150)) for i in range(60)]
    texts += [(200 + i, copy if i % 5 else copy + str(i)) for i in range(60)]
    texts += [(300 + i, line[:199] + str(i)) for i in range(30)]
    assert result(messy.documents(spark, texts)) == plain(texts)


def test_repeats_within_one_document(spark):
    rng = random.Random(9)
    line = letters(rng, 210)
    texts = [(1, line + "xy" + line), (2, "q" * 199), (3, "w" * 200), (4, "e" * 201), (5, "rt" * 120)]
    assert result(messy.documents(spark, texts)) == plain(texts)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(messy.documents(spark, texts)).collect()}
    assert bytes(got[1].kept) == b"xy" and [tuple(s) for s in got[1].spans] == [(0, 210), (212, 422)]


def test_empty_table(spark):
    assert result(messy.documents(spark, [])) == Counter()


@pytest.mark.parametrize("keep", [1, 2, 6])
def test_hash_collisions_are_found(monkeypatch, keep):
    """Hashes of a few bits agree by chance; the bytes decide."""
    window = letters(random.Random(keep), SIZE).encode()
    other = window[:-1] + b"#"
    windows = [other if i == 3 else window for i in range(12)]
    raw = np.frombuffer(b"".join(windows), dtype=np.uint8)
    anchor = suffix_dedup.mixed(suffix_dedup.Prefixes(raw).all_of(suffix_dedup.GRAM))[30]
    at, all_of = suffix_dedup.Prefixes.at, suffix_dedup.Prefixes.all_of
    few = np.uint64((1 << keep) - 1)
    monkeypatch.setattr(suffix_dedup.Prefixes, "at", lambda self, s, n: at(self, s, n) & few)
    monkeypatch.setattr(
        suffix_dedup.Prefixes,
        "all_of",
        lambda self, n: all_of(self, n) & few if n == SIZE else all_of(self, n),
    )
    chunk, place = suffix_dedup.repeated_windows(
        raw, np.arange(13) * SIZE, np.zeros(12, dtype=np.int64), np.full(12, anchor)
    )
    assert chunk.tolist() == [i for i in range(12) if i != 3]
    assert place.tolist() == [i * SIZE for i in range(12) if i != 3]


def test_order_of_suffixes():
    """The mergesort's order is that of the bytes."""
    rng = random.Random(2)
    text = letters(rng, 3000, "ab").encode() + b"ab" * 300
    raw = np.frombuffer(text, dtype=np.uint8)
    place = np.array(rng.sample(range(len(text) - SIZE), 1500))
    sizes = [1, 2, 3, 7, 64, 65, 500, 858]
    size = np.repeat(sizes, sizes)
    first = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
    got = suffix_dedup.Sorter(raw).sorted(place, first, size)
    low = 0
    for n in sizes:
        key = lambda p: text[p : p + SIZE]
        assert got[low : low + n].tolist() == sorted(place[low : low + n].tolist(), key=key)
        low += n


def test_nothing_is_left_behind(spark, sf_dir):
    folder = run_folder(spark)
    before = set(os.listdir(folder))
    suffix_dedup.remove_repeats(messy.table(spark, sf_dir, "documents")).agg(F.sum("n_bytes")).collect()
    left = {n.split("-")[1] for n in set(os.listdir(folder)) - before}
    assert left <= {"placed"}  # what the result reads


def test_blocks_of_the_sort_are_small(monkeypatch):
    """However rows come in batches, a block is little more than its least size or one
    key, keys stay whole and in order, and a step's memory is that of a block."""
    rng = random.Random(9)
    kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
    names = [c.split()[0] for c in suffix_dedup.PIECES.split(", ")]
    rows = [
        (key, 0, key, 0, True, bytes(rng.choices(b"abcd", k=rng.randint(200, 336))))
        for key in range(4000)
        for _ in range(rng.choice((2, 2, 2, 9)))
    ]
    table = pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    for rows_a_batch in (10_000, 700, 64):
        blocks = list(suffix_dedup.whole_keys(iter(table.to_batches(rows_a_batch))))
        assert max(b.nbytes for b in blocks) < 2.1 * suffix_dedup.BLOCK_BYTES < 1 << 20
        assert min(b.nbytes for b in blocks[:-1]) >= suffix_dedup.BLOCK_BYTES
        keys = [set(b.column(0).to_pylist()) for b in blocks]
        assert all(max(a) < min(b) for a, b in zip(keys, keys[1:]))
        assert pa.concat_tables(blocks).equals(table)

    texts = pa.array([f"{i} " + "the same words again " * 30 for i in range(60)] + [None])
    ids = pa.array(range(61), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, texts], names=["rid", "doc_id", "text"])
    whole = list(suffix_dedup._chunk_rows(iter([batch])))
    parts_of = suffix_dedup.parts_of
    monkeypatch.setattr(suffix_dedup, "parts_of", lambda batches: parts_of(batches, 4000))
    some = list(suffix_dedup._chunk_rows(iter([batch])))
    assert len(some) > 5 and pa.Table.from_batches(some).to_pylist() == pa.Table.from_batches(whole).to_pylist()
