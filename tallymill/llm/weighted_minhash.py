"""Near duplicates by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles: how often a shingle
occurs times its inverse document frequency.  Each of BANDS * ROWS samples picks
one shingle, such that two documents pick alike with the probability of their
weighted Jaccard similarity.  ROWS samples make a band; documents that share a
band are candidates, and a candidate is a link only if the weighted Jaccard
similarity of the whole texts is THRESHOLD or more.  Copying makes a passage
frequent and so lowers its weight, which would hide the copies of a text that
was copied most; a candidate is therefore a link as well if the similarity
reaches THRESHOLD with all weights equal.  Such links have bands of their own,
as many, whose samples are taken with equal weights: either test finds its
candidates whatever the other similarity is.

Documents of equal word sequences are one class from the start, so groups of
copies of any size are a single candidate.  A bucket of a band is compared in
tiles of at most 2 * BLOCK documents, each within one task, which reports no more
links than connect what is linked.  Members of a larger bucket first meet a few
pivots; those found connected to one another need not meet any more, so a large
group of near copies costs few tiles.  Where many members are left that nothing
connects, only those meet that have one of their rarest elements in common: in
whatever order both use, the first element that two texts of similarity THRESHOLD
share lies in the first fifth of the weight of the heavier one, and in the first
ninth of the other's.  A bucket is split so where that makes fewer rows than tiles
of the whole bucket; links are the same.

The document frequency of a shingle counts all documents.  It is told exactly
for shingles in more than a share FREQUENT of them, at most (shingles per
document) / FREQUENT in number; rarer ones count as if they were in that share.
Candidates for that list are counted LISTED at a time, however long texts are.

Defined results: a text of fewer than five words is one shingle; texts without
any word are alike only if equal, a null text is empty; rows of one id are one
document; a row without id is in no group; equal texts, ties and repeated rows
fall into one component, named by its least id; an empty table gives no rows;
further columns are ignored by `groups` and kept by `keep_first`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import components, release, session_of, staged, texts_of, unused_name
from tallymill.llm.words import Words, mixed, shingle_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3
FREQUENT = 1 / 500
SEED = 811
TABLE = 1 << 16
CHUNK = 1 << 22  # shingles that are counted at a time
LISTED = 1 << 22  # candidates for frequent shingles that a walk over the texts counts
SAMPLED = 1 << 15  # shingles that are sampled at a time
DOCUMENTS_PER_TASK = 8192
BLOCK = 512  # documents of a bucket that are compared in one task
PIVOTS = 4

SIGNED_SCHEMA = "doc_id long, print binary, bands array<long>"


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and how often each occurs."""
    return np.unique(shingle_hashes(Words(text).hashes(), SHINGLE), return_counts=True)


class Frequencies:
    """Inverse document frequencies: shingles that are frequent, and the rest."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, documents: int):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        share = np.maximum(counts[order] / max(1, documents), FREQUENT)
        self.own, self.rest = 1 - np.log(share), 1 - np.log(FREQUENT)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.rest)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.own[at[known]]
        return out


# Document frequencies ------------------------------------------------------


def _chunk_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that two documents of a chunk share; such a chunk also reports
    itself, with no shingle.  A chunk of few documents reports all its shingles,
    so that chunks of the first kind are at most half of FREQUENT of the documents."""
    held, size = [], 0

    def counted():
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        chunk = int(len(held) >= 2 / FREQUENT)
        if chunk:
            found, counts = found[counts > 1], counts[counts > 1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None, *found.view(np.int64).tolist()], pa.int64()),
                pa.array([chunk, *counts.tolist()], pa.int64()),
            ],
            names=["shingle", "n"],
        )

    for batch in batches:
        for text in texts_of(batch):
            held.append(shingles(text)[0])
            size += len(held[-1])
            if size >= CHUNK:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def frequencies(documents: DataFrame) -> Frequencies:
    """Exact frequencies of all shingles in more than FREQUENT of the documents.

    A first pass finds which shingles these can be: one that a chunk holds only
    once may not be reported by that chunk, so a total falls short by at most the
    number of chunks.  Further passes count those, LISTED at a time.  What is
    kept is bounded by the number of shingles that can be so frequent.
    """
    total = documents.count()
    texts = documents.select("text").coalesce(max(1, -(-total // DOCUMENTS_PER_TASK)))
    found = staged(
        texts.mapInArrow(_chunk_counts, "shingle long, n long").groupBy("shingle").agg(
            F.sum("n").alias("n")
        ),
        "shingle-counts",
    )
    chunks = found.where("shingle IS NULL").select("n").first()
    least = FREQUENT * total - (chunks.n if chunks else 0)
    maybe = found.where("shingle IS NOT NULL").where(F.col("n") >= least).select("shingle")
    walks = -(-maybe.count() // LISTED)
    share = F.pmod(F.xxhash64("shingle"), F.lit(walks))
    exact = [_counted(documents, maybe.where(share == w), total) for w in range(walks)]
    release(found)
    return Frequencies(
        np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in exact)]),
        np.concatenate([np.zeros(0, np.int64), *(n for _, n in exact)]),
        total,
    )


def _counted(documents: DataFrame, maybe: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the listed shingles those in more than FREQUENT of all documents, and
    in how many they are."""
    listed = np.sort(maybe.toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))
    if not len(listed):
        return listed, np.zeros(0, np.int64)
    known = session_of(documents).sparkContext.broadcast(listed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(known.value), dtype=np.int64)
        for batch in batches:
            for text in texts_of(batch):
                own = shingles(text)[0]
                at = np.minimum(np.searchsorted(known.value, own), len(known.value) - 1)
                counts[at[known.value[at] == own]] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(known.value[some].view(np.int64)), pa.array(counts[some])],
            names=["shingle", "n"],
        )

    exact = (
        documents.select("text").mapInArrow(count, "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n"))
        .where(F.col("n") > FREQUENT * total)
        .toPandas()
    )
    return exact["shingle"].to_numpy(np.int64).view(np.uint64), exact["n"].to_numpy(np.int64)


# Signatures ----------------------------------------------------------------


class Sampler:
    """Improved consistent weighted sampling in logarithms.

    For a shingle of weight w: t = floor(ln w / r + b), and the shingle with the
    least ln c - r (t - b + 1) is the sample, where r and c are Gamma(2, 1) and
    b is uniform, all three given by the hash of shingle and sample number.  The
    least value stands for the sample: it is the same only for the same shingle
    and t, but for accidents that the check of candidates settles.
    """

    def __init__(self):
        random = np.random.default_rng(SEED)
        self.r = random.gamma(2.0, 1.0, TABLE)
        self.per_r = 1 / self.r
        self.log_c = np.log(random.gamma(2.0, 1.0, TABLE))
        self.seeds = random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
        self.equal_seeds = random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)

    def samples(self, hashes: np.ndarray, log_w: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row per document, whose shingles begin at its start."""
        out = np.empty((len(starts), len(self.seeds)))
        for k, seed in enumerate(self.seeds):
            x = (hashes ^ seed) * np.uint64(0x9FB21C651E98DF25)
            x ^= x >> np.uint64(32)
            low = (x & np.uint64(TABLE - 1)).astype(np.int64)
            r = self.r[low]
            b = (x >> np.uint64(32)) * 2.0**-32
            t = np.floor(log_w * self.per_r[low] + b)
            at = ((x >> np.uint64(16)) & np.uint64(TABLE - 1)).astype(np.int64)
            out[:, k] = np.minimum.reduceat(self.log_c[at] - r * (t - b + 1), starts)
        return out

    def equal_samples(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The same with all weights equal, where the least hash is the sample."""
        out = np.empty((len(starts), len(self.equal_seeds)), dtype=np.uint64)
        for k, seed in enumerate(self.equal_seeds):
            out[:, k] = np.minimum.reduceat(mixed(hashes ^ seed), starts)
        return out

    def bands(self, samples: np.ndarray, first: int = 0) -> np.ndarray:
        """Hashes of ROWS samples each, for the bands numbered from first."""
        bits = np.ascontiguousarray(samples).view(np.uint64).reshape(len(samples), BANDS, ROWS)
        numbers = np.arange(first, first + BANDS, dtype=np.uint64)
        out = np.broadcast_to(numbers, bits.shape[:2]).copy()
        for row in range(ROWS):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, row])
        return out.view(np.int64)


def signed(documents: DataFrame, known: Frequencies) -> DataFrame:
    """(doc_id, print, bands): print tells equal word sequences; a text
    without words has no bands."""
    shared = session_of(documents).sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            prints, sets, bands = [], [], []

            def flush():
                full = [s for s in sets if len(s[0])]
                made = iter(())
                if full:
                    hashes = np.concatenate([s[0] for s in full])
                    counts = np.concatenate([s[1] for s in full])
                    starts = np.cumsum([0, *(len(s[0]) for s in full[:-1])])
                    log_w = np.log(counts * shared.value.of(hashes))
                    weighted = sampler.bands(sampler.samples(hashes, log_w, starts))
                    equal = sampler.bands(sampler.equal_samples(hashes, starts), BANDS)
                    made = iter(np.hstack([weighted, equal]).tolist())
                bands.extend(next(made) if len(s[0]) else [] for s in sets)
                sets.clear()

            size = 0
            for text in texts_of(batch):
                words = Words(text).hashes()
                told = words.tobytes() if len(words) else b"\0" + text.encode()
                prints.append(hashlib.md5(told).digest())
                sets.append(
                    np.unique(shingle_hashes(words, SHINGLE), return_counts=True)
                )
                size += len(sets[-1][0])
                if size >= SAMPLED:
                    flush()
                    size = 0
            flush()
            if prints:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(prints, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "print", "bands"],
                )

    return documents.mapInArrow(run, SIGNED_SCHEMA)


# Candidates and links ------------------------------------------------------


def elements(known: Frequencies, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's weighted set: hashes, weights, and which are first occurrences.

    The k-th occurrence of a shingle is an element of its own, so the weight two
    texts share is that of their common elements.
    """
    found, counts = shingles(text)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = np.repeat(found, counts)
    own = np.where(nth > 0, mixed(hashes + nth.astype(np.uint64)), hashes)
    return own, np.repeat(known.of(found), counts), nth == 0


class Tile:
    """Documents that are compared with each other, and what is linked so far."""

    def __init__(self, known: Frequencies, texts: list[str], labels: list):
        sets = [elements(known, t) for t in texts]
        self.n = len(sets)
        self.document = np.repeat(np.arange(self.n), [len(s[0]) for s in sets])
        hashes, weights, first = (np.concatenate(x) for x in zip(*sets))
        # A list of documents per element: those of element e stand at
        # listed[begin[e]:begin[e + 1]].
        distinct, element = np.unique(hashes, return_inverse=True)
        order = np.argsort(element, kind="stable")
        self.listed = self.document[order]
        self.begin = np.searchsorted(element[order], np.arange(len(distinct) + 1))
        self.element, self.weights, self.first = element, weights, first
        self.ends = np.searchsorted(self.document, np.arange(self.n + 1))
        self.weight = np.bincount(self.document, weights, self.n)
        self.size = np.bincount(self.document, first, self.n)
        _, self.root = np.unique(np.asarray(labels), return_inverse=True)

    def partners(self, i: int) -> np.ndarray:
        """Documents that reach THRESHOLD with document i, by either weight."""
        own = slice(self.ends[i], self.ends[i + 1])
        starts = self.begin[self.element[own]]
        lengths = self.begin[self.element[own] + 1] - starts
        within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        others = self.listed[np.repeat(starts, lengths) + within]
        shared = np.bincount(others, np.repeat(self.weights[own], lengths), self.n)
        alike = np.bincount(others, np.repeat(self.first[own], lengths), self.n)
        weighted = shared / (self.weight[i] + self.weight - shared)
        plain = alike / (self.size[i] + self.size - alike)
        return np.flatnonzero(np.maximum(weighted, plain) >= THRESHOLD)

    def spanning(self) -> list[tuple[int, int]]:
        """Links that connect all that any links connect.

        Documents are compared with all others one by one, until those left
        are all in one component: of two documents in different ones, one was
        compared then.
        """
        out, waiting = [], np.ones(self.n, dtype=bool)
        while True:
            sizes = np.bincount(self.root, minlength=self.n)
            open_ones = np.flatnonzero(waiting & (self.root != sizes.argmax()))
            if not len(open_ones):
                return out
            i = open_ones[0]
            waiting[i] = False
            for j in self.partners(i):
                if self.root[j] != self.root[i]:
                    out.append((i, j))
                    self.root[self.root == self.root[j]] = self.root[i]


def per_tile(
    tiles: DataFrame, texts: DataFrame, known: Frequencies, work: Callable, schema: str
) -> DataFrame:
    """Rows that work(known, rows) returns for the rows of each tile, which are
    the columns of tiles after the first one, by doc_id, and the text.

    A tile's rows come one after the other, so a task holds one tile.
    """
    shared = session_of(tiles).sparkContext.broadcast(known)
    columns = tiles.columns
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def made(out: list[tuple]) -> pa.RecordBatch:
            made_columns = zip(*out) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in made_columns], names=names
            )

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != now:
                    out += work(shared.value, rows) if rows else []
                    now, rows = row[0], []
                rows.append(row[1:])
            yield made(out)
        yield made(work(shared.value, rows) if rows else [])

    return (
        tiles.hint("merge").join(texts, "doc_id")
        .select(*columns, "text")
        .repartition("tile")
        .sortWithinPartitions("tile", "doc_id")
        .mapInArrow(run, schema)
    )


def _links_within(known: Frequencies, rows: list[tuple]) -> list[tuple]:
    tile = Tile(known, [r[3] for r in rows], [r[1] for r in rows])
    pivots = [i for i, r in enumerate(rows) if r[2]]
    pairs = [(i, j) for i in pivots for j in tile.partners(i) if i != j]
    if not pivots:
        pairs = tile.spanning()
    return [(rows[i][0], rows[j][0]) for i, j in pairs]


def tile_links(tiles: DataFrame, texts: DataFrame, known: Frequencies) -> DataFrame:
    """Links (a, b) within each tile of tiles(tile, doc_id, label, pivot).

    Where a tile has pivots, they are compared with all others; else the tile's
    documents with each other, as far as their labels do not say that they are
    connected.
    """
    told = tiles.select("tile", "doc_id", "label", "pivot")
    return per_tile(told, texts, known, _links_within, "a long, b long")


def chunk_of(chunks: str) -> F.Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col(chunks))


def each(count: str) -> str:
    """SQL for 0 .. count - 1; nothing for 0."""
    return f"if({count} > 0, sequence(0L, {count} - 1), array())"


def pivot_tiles(members: DataFrame) -> DataFrame:
    """Tiles of large buckets: a chunk of the members with PIVOTS of them all."""
    seat = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PIVOTS))
    large = members.where(F.col("n") > BLOCK).withColumn("chunks", F.ceil(F.col("n") / BLOCK))
    pivots = (
        large.groupBy("bucket", "chunks", seat.alias("seat"))
        .agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id")).alias("p"))
        .select(
            "bucket", F.col("p.doc_id").alias("doc_id"), F.explode(F.expr(each("chunks"))).alias("chunk"),
            F.lit(True).alias("pivot"),
        )
    )
    own = chunk_of("chunks").alias("chunk")
    rest = large.select("bucket", "doc_id", own, F.lit(False).alias("pivot"))
    return (
        pivots.unionByName(rest)
        .groupBy("bucket", "chunk", "doc_id")
        .agg(F.max("pivot").alias("pivot"), F.max(~F.col("pivot")).alias("own"))
        .select(
            F.xxhash64("bucket", "chunk").alias("tile"),
            "bucket",
            "doc_id",
            F.col("doc_id").alias("label"),
            "pivot",
            "own",
        )
    )


def outline(members: DataFrame) -> DataFrame:
    """Of each bucket whose members are on two sides: its most frequent side,
    into how many chunks the others and those of that side are cut, and how
    many rows its tiles have."""
    counts = members.groupBy("bucket", "n", "side").agg(F.count(F.lit(1)).alias("c"))
    return (
        counts.groupBy("bucket", "n")
        .agg(F.max(F.struct("c", "side")).alias("most"))
        .where("most.c < n")
        .select(
            "bucket",
            "n",
            F.col("most.c").alias("c"),
            F.col("most.side").alias("main"),
            F.expr(f"if(n <= {BLOCK}, 1L, ceil((n - most.c) / {BLOCK}))").alias("others"),
            F.expr(f"if(n <= {BLOCK}, 0L, ceil(most.c / {BLOCK}))").alias("mains"),
        )
        .withColumn("rows", F.expr("if(mains = 0, n, (n - c) * (others + mains) + c * others)"))
    )


def all_tiles(members: DataFrame) -> DataFrame:
    """Tiles in which any two members of a bucket meet that are on two sides.

    A bucket of at most BLOCK members is a tile.  In a larger one the members of
    the most frequent side need not meet each other: the others are cut into
    chunks, and so are they, and each chunk of the others meets every chunk.
    """
    placed = members.join(outline(members).drop("n", "c", "rows"), "bucket")
    is_main = "mains > 0 AND side <=> main"
    own = F.when(F.expr(is_main), chunk_of("mains")).otherwise(chunk_of("others"))
    others, mains = each("others"), each("mains")
    meets = F.expr(
        f"CASE WHEN {is_main} THEN transform({others}, k -> struct(k AS x, others + own AS y))"
        f" ELSE concat(transform({others}, k -> struct(least(k, own) AS x, greatest(k, own) AS y)),"
        f" transform({mains}, k -> struct(own AS x, others + k AS y))) END"
    )
    return (
        placed.withColumn("own", own)
        .select("bucket", "doc_id", "label", F.explode(meets).alias("at"))
        .select(
            F.xxhash64("bucket", "at.x", "at.y").alias("tile"), "doc_id", "label",
            F.lit(False).alias("pivot"),
        )
    )


def rarest(known: Frequencies, rows: list[tuple]) -> list[tuple]:
    """(bucket, doc_id, element, early) of rows(bucket, doc_id, pivot, own, text):
    the elements of each own document that come first, by how few pivots of the
    bucket hold them, then by weight.

    A text shares THRESHOLD of its weight with one of that similarity, and
    2 / (1 + 1 / THRESHOLD) of it with one that is no lighter.  All that the two
    share stands behind the first shared element, or is it: that element is given
    here for both, and is early in the lighter one.
    """
    sets = [elements(known, r[4]) for r in rows]
    held = [s[0] for s, r in zip(sets, rows) if r[2]]
    common, holders = np.unique(np.concatenate(held), return_counts=True)
    out, exact = [], 1 - 1e-9
    for (bucket, doc_id, _, own, _), (hashes, weights, first) in zip(rows, sets):
        if not own:
            continue
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        among = np.where(common[at] == hashes, holders[at], 0)
        order = np.lexsort((hashes, -weights, among))
        hashes = hashes[order]
        told, early = np.zeros((2, len(order)), dtype=bool)
        for w in (weights[order], first[order].astype(float)):
            rest = w.sum() - (np.cumsum(w) - w)  # from an element on
            told |= (w > 0) & (rest >= exact * THRESHOLD * w.sum())
            early |= (w > 0) & (rest >= exact * 2 / (1 + 1 / THRESHOLD) * w.sum())
        given = zip(hashes[told].view(np.int64).tolist(), early[told].astype(int).tolist())
        out += [(bucket, doc_id, element, is_early) for element, is_early in given]
    return out


def distinct_buckets(buckets: DataFrame) -> DataFrame:
    """Buckets of two or more, with n; those of the same members, of which
    alike documents have many, are one."""
    own = F.xxhash64("doc_id", F.lit(3))
    return (
        buckets.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(own).alias("x"),
            F.sum(own % 1_000_003).alias("s"),
        )
        .where("n > 1")
        .groupBy("n", "x", "s")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n")
    )


def distinct_parts(parts: DataFrame) -> DataFrame:
    """Parts in which two members must meet: they have two labels, and an early
    one.  Parts of the same members, as early, are one."""
    own = F.xxhash64("doc_id", "early")
    return (
        parts.groupBy("whole", "bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(own).alias("x"),
            F.sum(own % 1_000_003).alias("s"),
            F.min("label").alias("low"), F.max("label").alias("high"), F.max("early").alias("any"),
        )
        .where("low < high AND any = 1")
        .groupBy("n", "x", "s")
        .agg(F.min(F.struct("bucket", "whole")).alias("b"))
        .select("b.bucket", "b.whole", "n")
    )


def split_buckets(members: DataFrame, texts: DataFrame, known: Frequencies) -> DataFrame:
    """The members (bucket, n, doc_id, label) and their side, with buckets split
    by their rarest elements, where more than one chunk of them is not connected
    and the parts have fewer rows than tiles of the whole bucket.

    Members of one label are on one side; in a part, so are all that are not early.
    """
    members = members.withColumn("side", F.col("label"))
    wide = staged(outline(members).where("others > 1").select("bucket", "rows"), "wide-buckets")
    if wide.isEmpty():
        return members
    inside = members.join(wide.hint("merge"), "bucket").select("bucket", "n", "doc_id", "label")
    tiles = pivot_tiles(inside).select("tile", "bucket", "doc_id", "pivot", "own")
    found = per_tile(
        tiles, texts, known, rarest, "whole long, doc_id long, element long, early long"
    )
    labels = inside.select(F.col("bucket").alias("whole"), "doc_id", "label")
    parts = staged(
        found.join(labels.hint("merge"), ["whole", "doc_id"]).select(
            "whole", F.xxhash64("whole", "element").alias("bucket"), "doc_id", "label", "early"
        ),
        "bucket-parts",
    )
    part = staged(
        parts.join(distinct_parts(parts).hint("merge"), ["whole", "bucket"]).select(
            "whole", "bucket", "n", "doc_id", "label", F.expr("if(early = 1, label, null)").alias("side")
        ),
        "bucket-part-members",
    )
    of_part = part.select(F.col("bucket").alias("part"), "whole").distinct()
    cost = (
        outline(part).join(of_part.hint("merge"), F.col("bucket") == F.col("part"))
        .groupBy("whole").agg(F.sum("rows").alias("cost"))
    )
    chosen = staged(
        wide.join(cost, F.col("bucket") == F.col("whole"), "left")
        .where("coalesce(cost, 0) < rows")
        .select(F.col("bucket").alias("whole")),
        "split-buckets",
    )
    kept = members.join(chosen.hint("merge"), F.col("bucket") == F.col("whole"), "left_anti")
    split = part.join(chosen.hint("merge"), "whole", "left_semi").drop("whole")
    return staged(kept.unionByName(split), "bucket-split")


def class_links(documents: DataFrame, classes: DataFrame, known: Frequencies) -> DataFrame:
    """Links (a, b) between class representatives that connect every two
    candidates of one bucket that a chain of links connects."""
    buckets = classes.select("doc_id", F.explode("bands").alias("bucket"))
    members = staged(
        buckets.join(distinct_buckets(buckets), "bucket").select("bucket", "n", "doc_id"), "bucket-members"
    )
    texts = staged(
        # Both sides grow with the input, so the plan is the same at every size.
        documents.join(members.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
        .groupBy("doc_id").agg(F.min("text").alias("text")),
        "bucket-texts",
    )
    first = staged(tile_links(pivot_tiles(members), texts, known), "pivot-links")
    if first.isEmpty():
        labelled = members.withColumn("label", F.col("doc_id"))
    else:
        roots = components(first)
        labelled = members.join(roots, F.col("doc_id") == F.col("id"), "left").select(
            "bucket", "n", "doc_id", F.coalesce("root", "doc_id").alias("label")
        )
    labelled = staged(labelled, "bucket-labels")
    apart = split_buckets(labelled, texts, known)
    second = staged(tile_links(all_tiles(apart), texts, known), "bucket-links")
    release(members, texts, labelled)
    return first.unionByName(second)


def groups(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, component_id, kept), one row per row of documents.

    class_id is the least id of the documents of equal words, component_id the
    least id that links reach; the document of that id is kept.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = frequencies(rows)
    signatures = staged(signed(rows, known), "signatures")
    named = signatures.where("doc_id IS NOT NULL")
    classes = staged(
        named.groupBy("print").agg(
            F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    links = class_links(rows, classes, known)
    # Rows of one id are one document, whatever classes they are in.
    joined = classes.select("print", F.col("doc_id").alias("class_id"))
    member = named.select("doc_id", "print").join(joined, "print").select("doc_id", "class_id")
    same_id = (
        member.groupBy("doc_id")
        .agg(F.min("class_id").alias("a"), F.max("class_id").alias("b"))
        .where("a <> b")
        .select("a", "b")
    )
    roots = components(links.unionByName(same_id))
    found = member.join(roots, F.col("class_id") == F.col("id"), "left").select(
        "doc_id", "class_id", F.coalesce("root", "class_id").alias("component_id")
    )
    null = F.lit(None).cast("long")
    alone = signatures.where("doc_id IS NULL").select(
        "doc_id", null.alias("class_id"), null.alias("component_id")
    )
    return found.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """Rows and columns of the documents that stay: of each component the one
    of the least id, of rows of one id the first by text."""
    found = groups(documents).where("NOT kept")
    name = unused_name(documents, "id")
    key = F.col("doc_id").cast("long")
    gone = found.select(F.col("doc_id").alias(name)).distinct()
    stay = documents.join(gone, key == F.col(name), "left_anti")
    often = (
        documents.where("doc_id IS NOT NULL")
        .groupBy(key.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(name)
    )
    row = F.struct("*")
    single = (
        stay.join(often, key == F.col(name), "left_semi")
        .groupBy(key.alias(name))
        .agg(F.min_by(row, F.struct(F.coalesce("text", F.lit("")), F.to_json(row))).alias("row"))
        .select("row.*")
    )
    return stay.join(often, key == F.col(name), "left_anti").unionByName(single)
