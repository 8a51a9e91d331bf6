"""Secret scans through nested encodings.

A text is a layer.  Each layer is scanned for secrets, then unwrapped: URL and
Unicode escapes and entities are resolved over the whole layer, bytes that are no text
staying as they are; base64 runs, over line breaks as well, are decoded from each of
four letters on, streams that begin anywhere in them (gzip, zlib, bzip2; deflate without
a header where it fills the run) are inflated, and every printable stretch of what comes
out, of UTF-8 or UTF-16, is a layer, whatever bytes stand beside it.  What comes out is a
new layer on the worklist unless the same content from the same places was seen before,
so a text that unwraps to itself ends the loop, and equal blobs at two places are two
layers.
Every layer knows which code points of the document its own came from, and
spans are reported in the document's code points.

Defined results: a null or empty text has no spans; texts of any length are
scanned whole; repeated rows are scanned as rows of their own; an empty table
gives no rows; further columns are kept by `redact` and ignored by `scan`.  What a
stream inflates to is read to its end, whatever its size: in blocks of BLOCK bytes that
overlap by OVERLAP, so a secret, or a blob within of up to OVERLAP bytes, lies whole in
one of them, and memory stays bounded.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import texts_of

KINDS = ("assign", "access", "hex")
BLOCK, OVERLAP = 1 << 23, 1 << 22
PLACEHOLDER = "[secret]"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as those of any length would be
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};"
    r"|&[A-Za-z][A-Za-z0-9]{1,30};"
)
LEAST_LETTERS = 16  # of base64, which are the 12 bytes of the shortest secret
BASE64_RUN = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++"
    r"|[A-Za-z0-9+/_-]{16,}+)={0,2}"
)
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
PRINTABLE = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}"
    rb"|[\xf0-\xf4][\x80-\xbf]{3}){12,}"
)
PRINTABLE_16 = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]\x00){12,}|(?:\x00[\t\n\r\x20-\x7e]){12,}"
)
# The headers that a gzip, bzip2 or zlib stream can have; a zlib header is a number of
# two bytes that 31 divides, with method 8 and no dictionary.
ZLIB_HEADERS = [
    h.to_bytes(2, "big") for h in range(0, 1 << 16, 31) if h >> 8 & 15 == 8 and h >> 15 == 0 and not h & 32
]
STREAM = re.compile(
    b"|".join([rb"\x1f\x8b\x08", rb"BZh[1-9]1AY&SY", *map(re.escape, ZLIB_HEADERS)]), re.DOTALL
)
SURROGATE = re.compile("[\ud800-\udfff]")

SCAN_SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
)


def matches(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in this text alone, by kind and start."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6
        ]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


@dataclass
class Layer:
    """text, and for each of its runs where it came from.

    A run is (start in text, start, end in the document, whether letters
    correspond one to one); code points of a run without that correspondence
    stand for the run's whole range.
    """

    text: str
    runs: list[tuple[int, int, int, bool]]

    def key(self) -> bytes:
        """Equal for layers of the same text from the same places only."""
        told = hashlib.sha256(self.text.encode("utf-8", "surrogatepass"))
        told.update(b"\0" + repr(self.runs).encode())
        return told.digest()

    def outer(self, start: int, end: int) -> tuple[int, int]:
        def run_at(at):
            return self.runs[bisect_right(self.runs, at, key=lambda r: r[0]) - 1]

        here, first, _, even = run_at(start)
        begin = first + start - here if even else first
        here, first, last, even = run_at(end - 1)
        return begin, (first + end - here if even else last)


def _resolved(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with all matches decoded in place; None if nothing changes."""
    out, runs, at, size = [], [], 0, 0

    def keep(start: int, end: int) -> None:
        """Copies code points, run by run."""
        nonlocal size
        k = bisect_right(layer.runs, start, key=lambda r: r[0]) - 1
        while start < end:
            here, first, last, even = layer.runs[k]
            stop = min(end, layer.runs[k + 1][0] if k + 1 < len(layer.runs) else end)
            runs.append((size, first + start - here if even else first, last, even))
            out.append(layer.text[start:stop])
            size, start, k = size + stop - start, stop, k + 1

    changed = False
    for m in pattern.finditer(layer.text):
        plain = decode(m[0])
        if not plain or plain == m[0]:
            continue
        keep(at, m.start())
        runs.append((size, *layer.outer(*m.span()), False))
        out.append(plain)
        size, at, changed = size + len(plain), m.end(), True
    if not changed:
        return None
    keep(at, len(layer.text))
    return Layer("".join(out), runs)


def _url(run: str) -> str:
    """The run decoded, but for bytes that are not UTF-8."""
    text = bytes.fromhex(run.replace("%", "")).decode(errors="surrogateescape")
    return SURROGATE.sub(lambda m: f"%{ord(m[0]) - 0xDC00:02X}", text)


def _escape(run: str) -> str | None:
    try:
        if run[0] == "&" and run[1] != "#":
            return html5.get(run[1:])
        if run[0] == "&":
            code = int(run[3:-1], 16) if run[2] == "x" else int(run[2:-1])
        elif run[1] == "u":
            text = bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "surrogatepass")
            return SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)
        else:
            code = int(run[2:], 16)
        return None if 0xD800 <= code < 0xE000 else chr(code)
    except (ValueError, OverflowError):
        return None


def _opened(data: memoryview, raw: bool = False):
    if bytes(data[:3]) == b"BZh":
        return bz2.BZ2Decompressor()
    return zlib.decompressobj(-15 if raw else 47)


def _pieces(data: memoryview, size: int, raw: bool = False) -> Iterator[bytes]:
    """What a stream at the start of data inflates to, in pieces of at most `size`
    bytes; then how many bytes of data it takes, and whether it ends there."""
    opened = _opened(data, raw)
    given = data
    try:
        while True:
            piece = opened.decompress(given, size)
            if piece:
                yield piece
            if opened.eof:
                break
            if not piece:
                break
            given = getattr(opened, "unconsumed_tail", b"")  # bzip2 keeps its own
    except (zlib.error, OSError):
        pass
    yield len(data) - len(opened.unused_data) if opened.eof else len(data), opened.eof


def _blocks(data: memoryview, raw: bool) -> Iterator[bytes]:
    """The content of a stream in blocks that overlap."""
    held = b""
    for piece in _pieces(data, BLOCK - OVERLAP, raw):
        if isinstance(piece, bytes):
            yield held + piece
            held = (held + piece)[-OVERLAP:]


def _stream(data: memoryview, raw: bool = False) -> tuple[Iterator[bytes], int, bool] | None:
    """Blocks of the stream that data begins with, the bytes it takes, and whether it
    ends there; None if nothing comes of it."""
    first, more, used, ended = None, False, 0, False
    for piece in _pieces(data, BLOCK - OVERLAP, raw):
        if not isinstance(piece, bytes):
            used, ended = piece
        elif first is None:
            first = piece
        else:
            more = True  # too large to be held; it is inflated once more to be read
    if first is None or raw and not ended:
        return None
    return (_blocks(data, raw) if more else iter([first])), used, ended


def _contents(data: bytes, place: tuple[int, int] | None = None, seen: set | None = None, bare=False):
    """(text, start, end): printable stretches of data and of all streams in it, with
    the bytes of data they are from.  bare: data itself may be deflated."""
    seen = set() if seen is None else seen
    if (key := (hashlib.sha256(data).digest(), place)) in seen:
        return
    seen.add(key)
    for m in PRINTABLE.finditer(data):
        yield m[0].decode(errors="replace"), *(place or m.span())
    if b"\x00" in data:
        for m in PRINTABLE_16.finditer(data):
            text = m[0].replace(b"\x00", b"").decode("ascii")
            yield text, *(place or m.span())
    view, at = memoryview(data), 0
    if bare and (stream := _stream(view, raw=True)):
        for block in stream[0]:
            yield from _contents(block, place or (0, stream[1]), seen)
    while m := STREAM.search(data, at):
        begin, at = m.start(), m.start() + 1
        if stream := _stream(view[begin:]):
            blocks, used, ended = stream
            for block in blocks:
                yield from _contents(block, place or (begin, begin + used), seen)
            at = begin + used if ended else at


def _base64(layer: Layer) -> Iterator[Layer]:
    """What a run holds, read from each of its first four letters on, so a blob
    is found wherever it begins; lines of a wrapped run are read as one."""
    for m in BASE64_RUN.finditer(layer.text):
        lines, size = [], 0  # (first letter's number, its place in the text)
        for line in BASE64_LINE.finditer(m[0]):
            lines.append((size, m.start() + line.start()))
            size += len(line[0])
        if size < LEAST_LETTERS:
            continue
        letters = "".join(BASE64_LINE.findall(m[0])).replace("-", "+").replace("_", "/")
        if letters[0] * len(letters) == letters:
            continue  # one letter again and again: no text, no stream
        for shift in range(4):
            body = letters[shift:]
            body = body[: len(body) - (len(body) % 4 == 1)]  # no whole byte: not part of it
            data = base64.b64decode(body + "=" * (-len(body) % 4))

            def outer(start: int, end: int) -> tuple[int, int]:
                """Of bytes: the document's range of their letters."""
                first = shift + start * 8 // 6
                last = size - 1 if end == len(data) else shift + (end * 8 - 1) // 6
                a, b = (lines[bisect_right(lines, n, key=lambda x: x[0]) - 1] for n in (first, last))
                stop = m.end() if end == len(data) else b[1] + last - b[0] + 1
                return layer.outer(a[1] + first - a[0], stop)

            for text, start, end in _contents(data, bare=True):
                yield Layer(text, [(0, *outer(start, end), False)])


def unwrapped(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text and (next_one := _resolved(layer, URL_RUN, _url)):
        yield next_one
    if ("\\" in layer.text or "&" in layer.text) and (
        next_one := _resolved(layer, ESCAPE, _escape)
    ):
        yield next_one
    yield from _base64(layer)


def all_spans(text: str) -> tuple[list[tuple], list[tuple]]:
    """(start, kind number, end) of the text itself, and of all its layers."""
    if not text:
        return [], []
    base = sorted({(s, KINDS.index(k), e) for k, s, e in matches(text)})
    whole = Layer(text, [(0, 0, len(text), True)])
    found, seen, work = set(base), {whole.key()}, [whole]
    while work:
        layer = work.pop()
        if layer.text is not text:
            found |= {
                (start, KINDS.index(kind), end)
                for kind, s, e in matches(layer.text)
                for start, end in [layer.outer(s, e)]
            }
        for below in unwrapped(layer):
            if (key := below.key()) not in seen:
                seen.add(key)
                work.append(below)
    return base, sorted(found)


def written(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(documents: DataFrame) -> DataFrame:
    """Per document: base counts and their hash, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                base, spans = all_spans(text)
                count = [sum(k == n for _, k, _ in base) for n in range(3)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*count, digest, written(spans)))
            if rows:
                n = [pa.int64()] * 3 + [pa.string()] * 2
                made = [pa.array(c, k) for c, k in zip(zip(*rows), n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *made],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    narrow = documents.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return narrow.mapInArrow(run, SCAN_SCHEMA)


def redacted(text: str) -> str:
    """The text with every span, joined where they overlap, replaced."""
    out, at = [], 0
    for start, _, end in all_spans(text)[1]:
        if start >= at:
            out += [text[at:start], PLACEHOLDER]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(documents: DataFrame) -> DataFrame:
    """The same rows and columns with secrets replaced in text, and n_chars
    counted anew where there is such a column."""

    @F.pandas_udf("string")
    def without_secrets(texts):
        import pandas as pd

        return pd.Series([t if t is None else redacted(t) for t in texts], dtype=object)

    out = documents.withColumn("text", without_secrets("text"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
