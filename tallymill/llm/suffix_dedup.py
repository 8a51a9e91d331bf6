"""Removal of repeated byte strings, by a hash-compared suffix sort.

Every string of LENGTH bytes that starts at two places, of any documents, is
removed at all of them.  Suffixes are compared by prefix polynomial hashes: a
binary search over hashes of their beginnings finds how far they agree, so a
comparison takes logarithmic time, and a mergesort of the suffixes by such
comparisons puts equal beginnings side by side.  After the sort, bytes are
compared: that each suffix agrees with the next as far as the hashes said and is
in order there.  If a hash collision is found, the block is done by plain strings.

Only suffixes that can be equal meet.  The least hash among the GRAM-byte strings
of a window of LENGTH bytes is its anchor: equal windows have equal anchors, at
the same distance.  Consecutive windows with one anchor make a chunk.

1. Anchors are counted; chunks whose anchor is nowhere else have no repeated window.
2. Chunks with equal bytes (a digest of them) are counted.  Every window of a chunk
   that occurs twice is repeated, and one such chunk stands for all, so copies are
   never compared with each other.
3. Chunks that share an anchor and differ are sorted by anchor and their suffixes at
   the same distance of it are sorted in a task.  Where more than LARGE different
   chunks share an anchor, each is cut by further anchors of its windows, the more
   the larger the group, so no group must fit a task.

Documents are shuffled once to meet their repeated chunks, and those with chunks of
step 3 a second time to meet the sort's results.

Defined results: a null or empty text has no bytes; a text below LENGTH bytes is
kept whole; repeated rows are copies like any other; texts of any length are read
whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import parts_of, release, session_of, shuffle_partitions, staged, texts_of
from tallymill.llm.words import mixed

LENGTH = 200
GRAM = 64
WINDOW = LENGTH - GRAM + 1  # grams in a window
LARGE = 500
BLOCK_BYTES = 1 << 18  # least bytes that are sorted at a time

BASE = 0xD1342543DE82EF95
_powers = np.ones(1, dtype=np.uint64)
_unpowers = np.ones(1, dtype=np.uint64)

CHUNKS = "rid long, doc_id long, text binary, chunks array<struct<anchor:long,body:long>>"
PLACED = (
    "rid long, doc_id long, text binary, full array<struct<start:long,end:long>>,"
    " compare array<struct<anchor:long,start:long,end:long,cuts:int,wanted:boolean>>"
)
PIECES = "key long, anchor long, rid long, start long, wanted boolean, bytes binary"
KEPT = "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"


def _grown(powers: np.ndarray, base: int, size: int) -> np.ndarray:
    while len(powers) < size:
        powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), 1 << 64))])
    return powers


class Prefixes:
    """Polynomial hashes of a text's substrings, from those of its prefixes."""

    def __init__(self, raw: np.ndarray):
        global _powers, _unpowers
        n = len(raw)
        if len(_powers) <= n:
            _powers = _grown(_powers, BASE, n + 1)
            _unpowers = _grown(_unpowers, pow(BASE, -1, 1 << 64), n + 1)
        self.raw = raw
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(raw * _powers[:n], out=self.sums[1:])

    def all_of(self, length: int) -> np.ndarray:
        """Hashes of all substrings of this length, by their start."""
        places = max(len(self.raw) - length + 1, 0)
        return (self.sums[length : length + places] - self.sums[:places]) * _unpowers[:places]

    def at(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return (self.sums[starts + lengths] - self.sums[starts]) * _unpowers[starts]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes in which the suffixes at a and b agree, below LENGTH: a binary
        search for the longest prefixes with equal hashes."""
        low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), LENGTH)
        for _ in range(LENGTH.bit_length()):
            middle = (low + high) // 2
            same = self.at(a, middle) == self.at(b, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, np.maximum(middle, low + 1))
        return low


def least_in_windows(values: np.ndarray) -> np.ndarray:
    """The least of each WINDOW values in a row, from minima within blocks."""
    m = len(values)
    blocks = np.concatenate([values, np.full(-m % WINDOW, ~np.uint64(0))]).reshape(-1, WINDOW)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: m - WINDOW + 1], before[WINDOW - 1 : m])


class Chunks:
    """start: first window of each chunk; count: its windows; anchor: their anchor."""

    def __init__(self, raw: np.ndarray):
        if len(raw) < LENGTH:
            self.start = self.count = np.zeros(0, dtype=np.int64)
            self.anchor, self.grams = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
            return
        self.grams = mixed(Prefixes(raw).all_of(GRAM))
        least = least_in_windows(self.grams)
        self.start = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
        self.anchor = least[self.start]
        self.count = np.diff(np.r_[self.start, len(least)])

    def end(self) -> np.ndarray:
        return self.start + self.count + LENGTH - 1

    def twice(self) -> np.ndarray:
        """The chunks in which the anchor itself occurs at two places: the first
        window's first place is not the last window's last."""
        if not len(self.start):
            return self.start
        steps, out = np.arange(WINDOW), []
        for low in range(0, len(self.start), 1 << 14):
            start, anchor = self.start[low : low + (1 << 14)], self.anchor[low : low + (1 << 14), None]
            last = start + self.count[low : low + (1 << 14)] + WINDOW - 2
            first = start + (self.grams[start[:, None] + steps] == anchor).argmax(axis=1)
            final = last - (self.grams[last[:, None] - steps] == anchor).argmax(axis=1)
            out.append(np.flatnonzero(first != final) + low)
        return np.concatenate(out)


def _digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("anchor", pa.int64()), ("body", pa.int64())])
    for batch in parts_of(batches):
        raws = [t.encode() for t in texts_of(batch)]
        anchors, bodies, sizes = [], [], [0]
        for raw in raws:
            chunks = Chunks(np.frombuffer(raw, dtype=np.uint8))
            found = [
                _digest(raw[s:e]) for s, e in zip(chunks.start.tolist(), chunks.end().tolist())
            ]
            # A chunk that meets itself counts as two that differ.
            twice = chunks.twice()
            anchors += [chunks.anchor.view(np.int64), chunks.anchor[twice].view(np.int64)]
            bodies.append(np.array(found + [~found[i] for i in twice.tolist()], dtype=np.int64))
            sizes.append(len(found) + len(twice))
        both = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (anchors, bodies)
            ],
            fields=list(kind),
        )
        listed = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), both)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(raws, pa.binary()), listed],
            names=["rid", "doc_id", "text", "chunks"],
        )


def _place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks known by number become places in the text."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    piece = pa.struct(
        [("anchor", pa.int64()), *span, ("cuts", pa.int32()), ("wanted", pa.bool_())]
    )
    for batch in parts_of(batches):
        full, compare = [], []
        for raw, told in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            mine, theirs = [], []
            if told:
                chunks = Chunks(np.frombuffer(raw, dtype=np.uint8))
                start, end = chunks.start.tolist(), chunks.end().tolist()
                anchor = chunks.anchor.view(np.int64).tolist()
                for one in told:
                    if (n := one["number"]) >= len(start):
                        continue  # the second count of a chunk that meets itself
                    if one["repeated"]:
                        mine.append({"start": start[n], "end": end[n]})
                    if one["compare"]:
                        theirs.append(
                            {
                                "anchor": anchor[n],
                                "start": start[n],
                                "end": end[n],
                                "cuts": one["cuts"],
                                "wanted": not one["repeated"],
                            }
                        )
            full.append(mine)
            compare.append(theirs)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array(full, pa.list_(span)),
                pa.array(compare, pa.list_(piece)),
            ],
            names=["rid", "doc_id", "text", "full", "compare"],
        )


def cut(raw: bytes, anchor: int, cuts: int) -> list[tuple[int, int, int]]:
    """(key, start, end) of the parts of a chunk whose windows share all anchors,
    those of `cuts` further orders of the grams as well."""
    if not cuts:
        return [(anchor, 0, len(raw))]
    grams = mixed(Prefixes(np.frombuffer(raw, dtype=np.uint8)).all_of(GRAM))
    key = np.full(len(raw) - LENGTH + 1, np.int64(anchor)).view(np.uint64)
    for order in range(1, cuts + 1):
        key = mixed(key ^ least_in_windows(mixed(grams + np.uint64(order))))
    start = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1]
    end = np.r_[start[1:], len(key)] + LENGTH - 1
    return list(zip(key[start].view(np.int64).tolist(), start.tolist(), end.tolist()))


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PIECES.split(", ")]
    for batch in parts_of(batches):
        for rid, raw, compare in zip(*(c.to_pylist() for c in batch.columns)):
            rows = [
                (key, c["anchor"], rid, c["start"] + s, c["wanted"], chunk[s:e])
                for c in compare
                for chunk in [raw[c["start"] : c["end"]]]
                for key, s, e in cut(chunk, c["anchor"], c["cuts"])
            ]
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
            )


class Sorter:
    """Mergesort of suffixes in segments, all merges of a level at a time."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.hashes = raw, Prefixes(raw)
        self.whole = self.hashes.all_of(LENGTH)

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sign of the suffix at a against that at b; equal LENGTH bytes are 0."""
        out = np.zeros(len(a), dtype=np.int64)
        differ = np.flatnonzero(self.whole[a] != self.whole[b])
        a, b = a[differ], b[differ]
        common = self.hashes.common(a, b)
        out[differ] = np.sign(self.raw[a + common].astype(np.int64) - self.raw[b + common])
        return out

    def _ranks(self, place, item, low, high, equal_too) -> np.ndarray:
        """How many of place[low:high] go before each item, by binary search."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            before = self.compare(place[middle], item[open_]) < equal_too[open_]
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        return low

    def sorted(self, place: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """place, sorted within segments; first and size: the segment of each item."""
        width = 1
        while len(active := np.flatnonzero(size > width)):
            number = active - first[active]
            run = number // width
            end = first[active] + size[active]
            low = np.minimum(first[active] + (run ^ 1) * width, end)
            item = place[active]
            # Of equal suffixes, those of the earlier run come first.
            rank = self._ranks(place, item, low, np.minimum(low + width, end), run & 1) - low
            merged = place.copy()
            merged[first[active] + (run & ~1) * width + number % width + rank] = item
            place, width = merged, 2 * width
        return place

    def agrees(self, a: np.ndarray, b: np.ndarray, common: np.ndarray) -> bool:
        """Whether the bytes say what the hashes said: suffix a[i] agrees with b[i] in
        common[i] bytes and is then the lesser one."""
        short = common < LENGTH
        if (self.raw[(a + common)[short]] >= self.raw[(b + common)[short]]).any():
            return False
        # Neighbours at consecutive places agree in overlapping bytes; each is read once.
        order = np.lexsort((a, b - a))
        a, apart, common = a[order], (b - a)[order], common[order]
        fresh = np.r_[True, apart[1:] != apart[:-1]]
        family = np.cumsum(fresh) * (2 * len(self.raw) + 1)
        reach = np.r_[0, np.maximum.accumulate(a + common + family)[:-1]]
        start = np.maximum(a, np.where(fresh, 0, reach - family))
        size = np.maximum(a + common - start, 0)
        for some in np.array_split(np.arange(len(a)), 1 + int(size.sum()) // (1 << 22)):
            left = np.repeat(start[some] - np.cumsum(size[some]) + size[some], size[some])
            left += np.arange(len(left))
            if (self.raw[left] != self.raw[left + np.repeat(apart[some], size[some])]).any():
                return False
        return True


def _plainly(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Places whose LENGTH bytes are also at another of the places."""
    text, seen = raw.tobytes(), {}
    for p in place.tolist():
        seen.setdefault(text[p : p + LENGTH], []).append(p)
    return np.array([p for ps in seen.values() if len(ps) > 1 for p in ps], dtype=np.int64)


def repeated_windows(
    raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray, anchors: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Chunk and place of the windows that are also elsewhere among the chunks of
    their key.  Chunk i is raw[offsets[i] : offsets[i + 1]]."""
    lengths = np.diff(offsets)
    counts = lengths - LENGTH + 1
    chunk = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(chunk)) + np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts)
    sorter = Sorter(raw)
    grams = mixed(sorter.hashes.all_of(GRAM))
    anchored = np.flatnonzero(grams == np.repeat(anchors, lengths)[: len(grams)])
    distance = anchored[np.searchsorted(anchored, at)] - at
    segment = np.unique(keys, return_inverse=True)[1][chunk] * WINDOW + distance
    del grams, anchored, distance  # each as long as the block, in eight bytes a place
    order = np.argsort(segment, kind="stable")
    fresh = np.r_[True, segment[order][1:] != segment[order][:-1]]
    first = np.flatnonzero(fresh)
    size = np.repeat(np.diff(np.r_[first, len(order)]), np.diff(np.r_[first, len(order)]))
    order = order[size > 1]
    size = size[size > 1]
    place, again = at[order], np.zeros(len(raw), dtype=bool)
    if len(place):
        segment = segment[order]
        new = np.r_[True, segment[1:] != segment[:-1]]
        first = np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))
        placed = sorter.sorted(place, first, size)
        a, b = placed[:-1][~new[1:]], placed[1:][~new[1:]]
        common = np.full(len(a), LENGTH)
        differ = sorter.whole[a] != sorter.whole[b]
        common[differ] = sorter.hashes.common(a[differ], b[differ])
        if sorter.agrees(a, b, common):
            again[a[~differ]] = again[b[~differ]] = True
        else:
            for some in np.split(place, np.flatnonzero(new)[1:]):
                again[_plainly(raw, some)] = True
    found = again[at]
    return chunk[found], at[found]


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that divide no key, of BLOCK_BYTES to twice as much where no key needs more;
    the first column is the key."""
    held, size = [], 0
    for batch in parts_of(batches, BLOCK_BYTES):
        if size >= BLOCK_BYTES:
            key, last = batch.column(0).to_numpy(), held[-1].column(0)[-1].as_py()
            fresh = int((key != last).argmax())
            if key[fresh] != last:
                held.append(batch.slice(0, fresh))
                yield pa.Table.from_batches(held)
                held, size, batch = [], 0, batch.slice(fresh)
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _sort_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_keys(b for b in batches if b.num_rows):
        key, anchor, rid, start, wanted = (
            table.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in range(5)
        )
        texts = table.column(5).to_pylist()
        offsets = np.cumsum([0, *map(len, texts)])
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        chunk, at = repeated_windows(raw, offsets, key, anchor.view(np.uint64))
        mine = wanted[chunk]
        chunk, at = chunk[mine], at[mine]
        if not len(chunk):
            continue
        where = start[chunk] + at - offsets[chunk]
        fresh = np.r_[True, (chunk[1:] != chunk[:-1]) | (where[1:] > where[:-1] + LENGTH)]
        last = np.r_[np.flatnonzero(fresh)[1:], len(chunk)] - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (rid[chunk[fresh]], where[fresh], where[last] + LENGTH)],
            names=["rid", "start", "end"],
        )


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in parts_of(batches):
        raws, kept, spans = batch.column(1).to_pylist(), [], []
        for raw, *found in zip(raws, *(c.to_pylist() for c in batch.columns[2:])):
            joined: list[list[int]] = []
            for start, end in sorted(
                (s["start"], s["end"]) for some in found for s in some or ()
            ):
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(end, joined[-1][1])
                else:
                    joined.append([start, end])
            edges = [0, *(x for s in joined for x in s), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans.append([{"start": s, "end": e} for s, e in joined])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(map(len, raws), pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array(spans, pa.list_(span)),
            ],
            names=["doc_id", "n_bytes", "kept", "spans"],
        )


def repeated_chunks(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rid, number, repeated, compare, cuts of each chunk (rid, number, anchor, body)
    that is repeated as a whole or must be compared with others of its anchor; and the
    staged rows that this reads."""
    often = chunks.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = staged(chunks.join(often, "anchor"), "repeats-shared")
    bodies = shared.groupBy("anchor", "body").agg(
        F.count(F.lit(1)).alias("copies"), F.min("rid").alias("holder")
    )
    differing = bodies.groupBy("anchor").agg(F.count(F.lit(1)).alias("differing"))
    known = shared.join(bodies.join(differing, "anchor"), ["anchor", "body"])
    told = known.select(
        "rid",
        "number",
        (F.col("copies") > 1).alias("repeated"),
        F.expr("differing > 1 AND (copies = 1 OR rid = holder)").alias("compare"),
        F.expr(
            f"CASE WHEN differing <= {LARGE} THEN 0"
            f" ELSE 1 + floor(ln(differing / {LARGE}) / ln(8)) END"
        )
        .cast("int")
        .alias("cuts"),
    )
    return told.where("repeated OR compare"), shared


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, kept (the remaining bytes) and the removed spans of bytes."""
    numbered = documents.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text"
    )
    read = staged(
        numbered.select("rid", "doc_id", "text").mapInArrow(_chunk_rows, CHUNKS),
        "repeats-chunks",
        "zstd",
    )
    each = read.select("rid", F.posexplode("chunks").alias("number", "chunk")).select(
        "rid", "number", "chunk.anchor", "chunk.body"
    )
    told, shared = repeated_chunks(each)
    per_document = told.groupBy("rid").agg(
        F.collect_list(F.struct("number", "repeated", "compare", "cuts")).alias("told")
    )
    placed = staged(
        read.select("rid", "doc_id", "text")
        .join(per_document, "rid", "left")
        .mapInArrow(_place_rows, PLACED),
        "repeats-placed",
        "zstd",
    )
    release(read, shared)

    pieces = (
        placed.where("size(compare) > 0").select("rid", "text", "compare").mapInArrow(_piece_rows, PIECES)
    )
    spans = (
        # A given number, as adaptive execution would pack these few bytes, which take
        # long to sort, into few tasks.
        pieces.repartition(shuffle_partitions(session_of(documents)), "key")
        .sortWithinPartitions("key")
        .mapInArrow(_sort_rows, "rid long, start long, end long")
        .groupBy("rid")
        .agg(F.collect_list(F.struct("start", "end")).alias("sorted"))
    )
    undecided = F.expr("exists(compare, c -> c.wanted)")
    decided = placed.where(~undecided).select("doc_id", "text", "full")
    rest = placed.where(undecided).join(spans, "rid", "left")
    return decided.mapInArrow(_kept_rows, KEPT).unionAll(
        rest.select("doc_id", "text", "full", "sorted").mapInArrow(_kept_rows, KEPT)
    )


def digest(kept: DataFrame) -> DataFrame:
    """Per document: sizes, removed runs, and a digest of what remains."""
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
