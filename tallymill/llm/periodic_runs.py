"""Periodic runs of words, by an online sparse diagonal DP.

Words i and i-d that are equal lie on diagonal d; a run with period d is a
stretch of that diagonal.  Words are read in order.  The earlier occurrences of a
word, in the same context of CONTEXT words as no run has a shorter diagonal, open
diagonals or lengthen active ones, and a diagonal that ends with sufficient length
emits its run at once.  Only words whose context occurs twice are looked at, and a
diagonal is not opened where it cannot end with sufficient length:

- the text ends too early for its lag, or the context at its least end differs;
- a shorter active lag divides it and covers all it would cover: it would end with
  that lag, whose run is the one with the smallest period;
- it begins inside an active run that goes on for one period at least, with a
  longer lag that no multiple explains: two periods of so long a stretch would
  have their common divisor as period.

So a text that is one long run costs as much as its length, not its square.

Defined results: a null, empty or short text has no runs; texts of any length are
read whole; repeated rows are rows of their own; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymill.llm.common import texts_of

LEAST_WORDS = 6
LEAST_PERIODS = 4
CONTEXT = LEAST_WORDS - 1  # the shortest diagonal, that of lag 1
FEW = 24  # earlier occurrences that plain code compares faster than numpy

WORD = re.compile(r"[^\x20\x09-\x0D]+")

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)


def contexts(ids: np.ndarray) -> np.ndarray:
    """A number for each CONTEXT words in a row; equal for equal words."""
    width = max(int(ids.max()).bit_length(), 1)
    out, taken = ids.astype(np.int64), 1
    while taken < CONTEXT:
        step = min(CONTEXT - taken, (62 - int(out.max()).bit_length()) // width)
        for k in range(step):
            out = (out[:-1] << width) | ids[taken + k : taken + k + len(out) - 1]
        taken += step
        if taken < CONTEXT:
            out = np.unique(out, return_inverse=True)[1]
    return np.unique(out, return_inverse=True)[1]


def least_diagonal(lag: int) -> int:
    return max(LEAST_WORDS - lag, (LEAST_PERIODS - 1) * lag)


class Diagonals:
    """The active diagonals of one text, as lag -> place where it was opened.

    Places are those of a context's first word, so the last word of a diagonal
    that ends at place x is x + CONTEXT - 1.
    """

    def __init__(self, context: np.ndarray, words: int):
        self.array = context
        self.at = context.tolist()
        self.words = words
        self.opened: dict[int, int] = {}
        self.known_end: dict[int, int] = {}  # of lags that are runs already
        self.runs: dict[tuple[int, int], int] = {}

    def close(self, lag: int, last: int) -> None:
        start = self.opened.pop(lag) - lag
        self.known_end.pop(lag, None)
        end = last + CONTEXT
        if end - start >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            # One stretch may be met by several lags; its period is the smallest.
            found = self.runs.get((start, end), lag)
            self.runs[start, end] = min(found, lag)

    def close_all(self, last: int) -> None:
        for lag in list(self.opened):
            self.close(lag, last)

    def lengthen(self, x: int) -> None:
        """Each active diagonal goes on to place x, or ends before it."""
        at = self.at
        here = at[x]
        for lag, first in list(self.opened.items()):
            if at[x - lag] != here:
                self.close(lag, x - 1)
            elif lag not in self.known_end and x - first + CONTEXT >= least_diagonal(lag):
                self.known_end[lag] = self._end(lag, x)

    def _end(self, lag: int, x: int) -> int:
        """First place after x that this diagonal does not reach."""
        step, total = 64, len(self.array)
        while x < total:
            stop = min(x + step, total)
            differ = self.array[x:stop] != self.array[x - lag : stop - lag]
            if differ.any():
                return x + int(differ.argmax())
            x, step = stop, 2 * step
        return total

    def open(self, x: int, earlier: list[int]) -> None:
        """Open the diagonals that begin at x, given earlier places of its context."""
        if not earlier:
            return
        low = bisect_left(earlier, x - (self.words - x) // (LEAST_PERIODS - 1))
        ranges = [(low, len(earlier))]
        inside = [
            (self.opened[lag] - lag, lag) for lag, end in self.known_end.items() if x + lag <= end
        ]
        if inside:
            start, lag = min(inside)
            ranges = [
                (low, max(low, bisect_left(earlier, start))),
                (max(low, bisect_right(earlier, x - lag)), len(earlier)),
            ]
        at = self.at
        before = at[x - 1] if x else -1
        for first, stop in ranges:
            near = earlier[first:stop]
            if len(near) > FEW:
                near = self._fit(x, before, np.array(near))
            for y in near:
                lag = x - y
                if y and at[y - 1] == before:
                    continue  # it began before x
                reach = x + least_diagonal(lag) - CONTEXT
                if reach >= len(at) or at[reach] != at[reach - lag]:
                    continue
                if any(lag % q == 0 and o - q <= y for q, o in self.opened.items()):
                    continue
                self.opened[lag] = x

    def _fit(self, x: int, before: int, near: np.ndarray) -> list[int]:
        """Of many earlier places, those that pass the first two tests of `open`."""
        array = self.array
        lag = x - near
        reach = x - CONTEXT + np.maximum(LEAST_WORDS - lag, (LEAST_PERIODS - 1) * lag)
        fits = (reach < len(array)) & ((near == 0) | (array[near - 1] != before))
        near, lag, reach = near[fits], lag[fits], reach[fits]
        return near[array[reach] == array[reach - lag]].tolist()


def runs_of(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    context = contexts(ids)
    again = np.flatnonzero(np.bincount(context)[context] > 1).tolist()
    if not again:
        return []
    diagonals = Diagonals(context, len(words))
    occurrences: dict[int, list[int]] = {}
    last = -2
    for x in again:
        if x == last + 1:
            diagonals.lengthen(x)
        else:
            diagonals.close_all(last)
        earlier = occurrences.setdefault(diagonals.at[x], [])
        diagonals.open(x, earlier)
        earlier.append(x)
        last = x
    diagonals.close_all(last)
    return sorted((s, e - s, p) for (s, e), p in diagonals.runs.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without what follows the first period of a run."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words with a periodic end, for one document in ten; see the README."""
    n = len(words)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def find_runs(documents: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, all runs by start then period, and the text without repetitions.

    With `plant`, the words are first changed as `planted` says.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found, kept = [], []
            for doc_id, text in zip(ids, texts_of(batch)):
                words = WORD.findall(text)
                if plant:
                    words = planted(words, doc_id)
                runs = runs_of(words)
                found.append([dict(zip(RUN.names, r)) for r in runs])
                kept.append(" ".join(collapsed(words, runs)))
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind), pa.array(kept, pa.string())],
                names=FOUND.names,
            )

    narrow = documents.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return narrow.mapInArrow(run, FOUND)


def report(found: DataFrame) -> DataFrame:
    """Per document: the longest run, and digests of all runs and of what is kept."""
    longest = found.selectExpr(
        "doc_id",
        "runs",
        "collapsed",
        "array_min(transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period))) AS best",
    )
    return longest.selectExpr(
        "doc_id",
        "cast(size(runs) AS bigint) AS n_runs",
        "best.start AS start",
        "-best.less AS length",
        "best.period AS period",
        "(-1000 * best.less) div best.period AS exponent_milli",
        "sha2(cast(concat_ws('', transform(runs,"
        " r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))) AS binary), 256) AS runs_sha256",
        "sha2(cast(collapsed AS binary), 256) AS collapsed_sha256",
    )
