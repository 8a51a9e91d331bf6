"""Packing along a space-filling curve.

A document's tokens are hashed into a vector, the vector is projected to a few
dimensions, and its place on a Hilbert curve through them is its sort key.  Rows
are range-sorted by that key, so neighbours on the curve share sequences.  Each
task fills sequences of SEQUENCE tokens one after the other, cutting documents
where a sequence ends; what is left at its end is cut into sequences whose
lengths are powers of two, so nothing is padded.

Equal keys are told apart by doc_id when ranges are made, so a large group of
copies is spread over as many tasks as its size asks for.

Defined results: a null or empty text is the closing token alone; repeated rows
are packed as often as they occur; a long document takes several sequences; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallymill.llm.common import (
    session_of,
    shuffle_partitions,
    staged,
    text_slices,
    texts_of,
    vocabulary_path,
)

LIBRARY_FILE = "byte_bpe_50k.json"
RANKS_FILE = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
CLOSING = 1
SEQUENCE = 2048

HASHED, DIMENSIONS, BITS = 4096, 3, 16
SEED = 20_480

TOKEN_SCHEMA = "doc_id long, curve long, tokens long, ids binary"
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, sequence_length long, curve long"
)

# Texts of these characters are cut alike by both libraries; any other text,
# such as one that spells a special token, is left to the library of the file.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ‐-‧]|<\\|")


class Tokens:
    """Ids as the tokenizers library gives them for LIBRARY_FILE.

    The faster rank encoder has the same vocabulary and merges.
    """

    def __init__(self, library_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.library_path = library_path

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.library_path)

    def encode(self, text: str) -> np.ndarray:
        if _PLAIN.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.plain.encode_ordinary(text)
        return np.array([*ids, CLOSING], dtype="<u2")


@functools.cache
def tokens(library_path: str, ranks_path: str) -> Tokens:
    return Tokens(library_path, ranks_path)


@functools.cache
def projection() -> np.ndarray:
    """A fixed random direction in DIMENSIONS for each hashed token."""
    return np.random.default_rng(SEED).standard_normal((HASHED, DIMENSIONS)).astype(np.float32)


def hashed_tokens(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20)


def curve_points(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Grid points, one row per document: the mean direction of its tokens,
    squashed so that the grid is filled about evenly."""
    sums = np.add.reduceat(projection()[hashed_tokens(flat)], starts, axis=0, dtype=np.float64)
    squashed = 1 / (1 + np.exp(-sums / counts[:, None] * 12))
    return np.minimum((squashed * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of grid points (one per row) on the Hilbert curve.

    Per bit from the highest down: where a coordinate's bit is set, the lower
    bits of the first coordinate are mirrored, else they are swapped with those
    of that coordinate; then the coordinates are Gray-coded and interleaved.
    """
    x = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for d in range(len(x)):
            mirrored = (x[d] & bit) != 0
            swapped = np.where(mirrored, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(mirrored, x[0] ^ low, x[0] ^ swapped)
            x[d] = x[d] ^ swapped
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> b) & 1, turn ^ ((1 << b) - 1), turn)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in x:
            key = (key << 1) | (((d ^ turn) >> b) & 1)
    return key


def tokenized(documents: DataFrame, library_path: str, ranks_path: str) -> DataFrame:
    """(doc_id, curve, tokens, ids as little-endian unsigned 16-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(library_path, ranks_path).encode
        for batch in batches:
            texts = texts_of(batch)
            for part in text_slices(texts):
                ids = [encode(t) for t in texts[part]]
                counts = np.array([len(i) for i in ids])
                starts = np.cumsum(counts) - counts
                keys = hilbert_key(curve_points(np.concatenate(ids), starts, counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, len(ids)),
                        pa.array(keys, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([i.tobytes() for i in ids], pa.binary()),
                    ],
                    names=["doc_id", "curve", "tokens", "ids"],
                )

    narrow = documents.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return narrow.mapInArrow(run, TOKEN_SCHEMA)


def powers(left: int) -> list[int]:
    """Powers of two, falling, with the sum left."""
    return [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


class _Filler:
    """Fills sequences with documents as they come.  Holds the pieces of the
    open sequence only."""

    def __init__(self, task: int, with_ids: bool):
        self.next_id, self.open, self.used, self.with_ids = task << 40, [], 0, with_ids
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, curve: int, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            length = min(SEQUENCE - self.used, len(ids) - at)
            self.open.append((doc_id, at, ids[at : at + length], len(ids), curve))
            at, self.used = at + length, self.used + length
            if self.used == SEQUENCE:
                self._close([SEQUENCE])

    def finish(self) -> None:
        self._close(powers(self.used))

    def _close(self, lengths: list[int]) -> None:
        """Deals the open pieces out to sequences of these lengths."""
        waiting = self.open[::-1]
        for sequence in lengths:
            offset = 0
            while offset < sequence:
                doc_id, start, ids, total, curve = waiting.pop()
                room = sequence - offset
                if len(ids) > room:
                    waiting.append((doc_id, start + room, ids[room:], total, curve))
                    ids = ids[:room]
                raw = ids.astype("<u4").tobytes()
                row = (doc_id, start, len(ids), zlib.crc32(raw), total, self.next_id, offset,
                       sequence, curve)
                self.rows.append(row + (raw,) if self.with_ids else row)
                offset += len(ids)
            self.next_id += 1
        self.open, self.used = [], 0


def _fill(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    filler = _Filler(TaskContext.get().partitionId(), with_ids)
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64()] * (len(names) - with_ids) + [pa.binary()] * with_ids

    def made() -> pa.RecordBatch:
        rows, filler.rows = filler.rows, []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
        )

    for batch in batches:
        for doc_id, curve, ids in zip(*(c.to_pylist() for c in batch.columns)):
            filler.add(doc_id, curve, np.frombuffer(ids, dtype="<u2"))
        if filler.rows:
            yield made()
    filler.finish()
    if filler.rows:
        yield made()


def pack(
    documents: DataFrame,
    library_path: str | None = None,
    ranks_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences; with_ids adds each piece's ids as
    little-endian unsigned 32-bit integers.

    Tokens are staged, since ranges are found by a look at the keys: the range
    sampling then reads one narrow column and tokenizes nothing twice.
    """
    library_path = library_path or vocabulary_path(LIBRARY_FILE)
    ranks_path = ranks_path or vocabulary_path(RANKS_FILE)
    rows = staged(tokenized(documents, library_path, ranks_path), "pack-tokens")
    parts = shuffle_partitions(session_of(documents))
    ranged = rows.repartitionByRange(parts, "curve", "doc_id").sortWithinPartitions(
        "curve", "doc_id", "tokens", "ids"
    )
    return ranged.select("doc_id", "curve", "ids").mapInArrow(
        lambda batches: _fill(batches, with_ids),
        PIECE_SCHEMA + ", ids binary" * with_ids,
    )
