"""BPE encoding and decoding with a segment tree over the ranks of pairs.

The leaf of a symbol holds rank * width + position of the pair that begins
there, so the root is the leftmost pair of the lowest rank.  A merge changes
three leaves; their paths to the root are updated, and merging ends when the
root holds no mergeable pair.  Short words are merged many at a time, one tree
per row of an array; a long word has a tree of its own and takes
n log n steps.

What a letter is, its lower case and its normal form change with each edition of
Unicode.  Texts of common characters, for which all editions agree, are cut here; a word
with any other is cut by the normalizer and pre-tokenizer of the file's own library.
Merging is done here for both.

Defined results: a null or empty text has no tokens; texts of any length are
encoded whole; equal rows give equal rows; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallymill.llm.common import text_slices, texts_of, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
LONG = 256  # symbols from which a word has a tree of its own
CELLS = 1 << 18  # tree leaves that are merged at a time
CACHED = 64 << 20  # bytes of words a worker remembers; the memory is emptied when full
# Letters, digits, signs and white space up to Latin Extended-B, and punctuation.
UNCOMMON = re.compile("[^\x00-ɏ‐-‧]")
NO_RANK = 1 << 30

DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ENCODED_SCHEMA = "doc_id long, ids array<int>, decoded string"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 for
    itself, the others counted up from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _outside_spaces() -> re.Pattern:
    """Characters that str.split cuts at although they are no white space."""
    return re.compile("[\x1c-\x1f]")


class WordBpe:
    """A tokenizer file with byte letters, an end-of-word suffix and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.specials.values()]))
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], dtype=np.int64)
        self.width = len(self.tokens)
        pairs = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        # A pair that is listed twice keeps its later rank, as in a dictionary.
        by_pair = {int(p): (rank, int(m)) for rank, (p, m) in enumerate(zip(pairs, made))}
        self.by_pair = by_pair
        self.pairs = np.array(sorted(by_pair), dtype=np.int64)
        self.ranks = np.array([by_pair[p][0] for p in self.pairs.tolist()], dtype=np.int64)
        self.made = np.array([by_pair[p][1] for p in self.pairs.tolist()], dtype=np.int64)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.space = regex.compile(r"\p{White_Space}+")
        self.odd_space = _outside_spaces()
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.path = path
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(self.path)

    # One tree per word -------------------------------------------------

    def merge_long(self, symbols: list[int]) -> list[int]:
        """Ids of one word, by a segment tree in plain lists."""
        n = len(symbols)
        size = 1 << max(1, (n - 1).bit_length())
        none = NO_RANK * size
        by_pair, width = self.by_pair, self.width
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        made = [0] * size
        tree = [none] * (2 * size)

        def leaf(i: int) -> int:
            j = after[i]
            found = by_pair.get(symbols[i] * width + symbols[j]) if j < n else None
            if found is None:
                return none
            made[i] = found[1]
            return found[0] * size + i

        for i in range(n):
            tree[size + i] = leaf(i)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        alive = [True] * n
        while tree[1] < none:
            i = tree[1] % size
            j = after[i]
            symbols[i], alive[j] = made[i], False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            tree[size + j] = none
            changed = [i, j]
            tree[size + i] = leaf(i)
            if before[i] >= 0:
                tree[size + before[i]] = leaf(before[i])
                changed.append(before[i])
            for at in changed:
                k = (size + at) >> 1
                while k:
                    least = min(tree[2 * k], tree[2 * k + 1])
                    if tree[k] == least:
                        break
                    tree[k] = least
                    k >>= 1
        return [s for s, there in zip(symbols, alive) if there]

    # Many trees at a time ----------------------------------------------

    def _looked_up(self, left: np.ndarray, right: np.ndarray, there: np.ndarray):
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        hit = there & (self.pairs[at] == wanted)
        return np.where(hit, self.ranks[at], NO_RANK), self.made[at]

    def merge_rows(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """symbols: a word per row, padded to a power of two.  Ids of all words
        one after the other, and how many each word has."""
        rows, size = symbols.shape
        none = NO_RANK * size
        column = np.arange(size)
        alive = column < lengths[:, None]
        after = np.broadcast_to(column + 1, symbols.shape).copy()
        before = np.broadcast_to(column - 1, symbols.shape).copy()
        right = np.concatenate([symbols[:, 1:], symbols[:, :1]], axis=1)
        rank, made = self._looked_up(symbols, right, column + 1 < lengths[:, None])
        tree = np.full((rows, 2 * size), none, dtype=np.int64)
        tree[:, size:] = rank * size + np.where(rank < NO_RANK, column, 0)
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(
                tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2]
            )
            level //= 2
        r = np.flatnonzero(tree[:, 1] < none)
        while len(r):
            i = tree[r, 1] % size
            j = after[r, i]
            symbols[r, i] = made[r, i]
            alive[r, j] = False
            k = after[r, j]
            after[r, i] = k
            inside = k < lengths[r]
            before[r[inside], k[inside]] = i[inside]
            tree[r, size + j] = none
            self._set_leaf(tree, made, symbols, r, i, k, inside, size, none)
            p = before[r, i]
            has = p >= 0
            self._set_leaf(tree, made, symbols, r[has], p[has], i[has], has[has], size, none)
            touched = [size + i, size + j, size + np.where(has, p, i)]
            while touched[0][0] > 1:
                touched = [t >> 1 for t in touched]
                for t in touched:
                    tree[r, t] = np.minimum(tree[r, 2 * t], tree[r, 2 * t + 1])
            r = r[tree[r, 1] < none]
        return symbols[alive], alive.sum(axis=1)

    def _set_leaf(self, tree, made, symbols, r, at, right, there, size, none) -> None:
        rank, merged = self._looked_up(
            symbols[r, at], symbols[r, np.where(there, right, at)], there
        )
        made[r, at] = merged
        tree[r, size + at] = np.where(rank < NO_RANK, rank * size + at, none)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words])
        classes = np.maximum(1, np.ceil(np.log2(np.maximum(sizes, 1))).astype(int))
        for c in np.unique(classes):
            size, which = 1 << int(c), np.flatnonzero(classes == c)
            if size > LONG:
                for w in which:
                    ids = self.merge_long(self._symbols(words[w]))
                    out[w] = np.array(ids, dtype="<u4").tobytes()
                continue
            for part in np.array_split(which, -(-len(which) * size // CELLS)):
                padded = b"".join(words[w].ljust(size, b"\0") for w in part)
                raw = np.frombuffer(padded, dtype=np.uint8).reshape(len(part), size)
                symbols = self.inner[raw]
                ends = sizes[part] - 1
                row = np.arange(len(part))
                symbols[row, ends] = self.last[raw[row, ends]]
                ids, counts = self.merge_rows(symbols, sizes[part])
                flat, stop = ids.astype("<u4").tobytes(), np.cumsum(counts) * 4
                start = stop - counts * 4
                for w, a, b in zip(part.tolist(), start.tolist(), stop.tolist()):
                    out[w] = flat[a:b]
        return out

    def _symbols(self, word: bytes) -> list[int]:
        raw = np.frombuffer(word, dtype=np.uint8)
        return [*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]

    # Texts -------------------------------------------------------------

    def _parts(self, text: str) -> list[str]:
        """Cut at white space, which no word crosses; a special token's text
        is a part of its own, told by its leading white space."""
        out = []
        cut = self.special.split(text) if "<|" in text else [text]
        for n, piece in enumerate(cut):
            if n % 2:
                out.append(" " + piece)
            elif self.odd_space.search(piece):
                out += [p for p in self.space.split(piece) if p]
            else:
                out += piece.split()
        return out

    def _words(self, part: str) -> list[bytes]:
        if not UNCOMMON.search(part):
            return [w.encode() for w in self.words.findall(part.lower())]
        normal = self.library.normalizer.normalize_str(part)
        cut = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in cut]

    def _learn(self, parts: set[str]) -> None:
        known, words = self.known, {}
        cut = {}
        for part in parts:
            if part[0] == " ":
                known[part] = int(self.specials[part[1:]]).to_bytes(4, "little")
                continue
            cut[part] = found = self._words(part)
            for word in found:
                words[word] = b""
        for word, ids in zip(words, self.merge_words([*words])):
            words[word] = ids
        for part, found in cut.items():
            known[part] = ids = (
                words[found[0]] if len(found) == 1 else b"".join(words[w] for w in found)
            )
            self.held += 4 * len(part) + len(ids) + 200

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self._parts(t) for t in texts]
        if self.held > CACHED:
            self.known.clear()
            self.held = 0
        new = {p for ps in parts for p in ps if p not in self.known}
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, ps)) for ps in parts]

    def decode(self, ids: bytes) -> str:
        """The file names no decoder: tokens are joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.cache
def tokenizer(path: str) -> WordBpe:
    """One per worker and file."""
    return WordBpe(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple]:
    bpe = tokenizer(path)
    for batch in batches:
        texts = texts_of(batch)
        for part in text_slices(texts):
            ids = bpe.encode_batch(texts[part])
            length = part.stop - part.start
            yield batch.column(0).slice(part.start, length), ids, [bpe.decode(i) for i in ids]


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of each document."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        for doc_id, ids, decoded in _encoded(batches, path):
            flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
            offsets = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [doc_id, lists, pa.array(decoded)], names=["doc_id", "ids", "decoded"]
            )

    return _narrow(documents).mapInArrow(run, ENCODED_SCHEMA)


def encode_digest(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: how many tokens, and hashes of ids and of decoded text."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        for doc_id, ids, decoded in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays(
                [
                    doc_id,
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _narrow(documents).mapInArrow(run, DIGEST_SCHEMA)


def _narrow(documents: DataFrame) -> DataFrame:
    return documents.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
