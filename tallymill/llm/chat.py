"""Chat formatting: layouts are told by a hash of their field paths.

Prompt, instruction and message layouts are converted into canonical turns by
declarative mappings; turns are written with a template whose control strings
cannot occur inside a text, and can be read back exactly.  The hash of the paths
that a row fills selects its mapping: that of just these paths, or, as a null is
an empty text, the only one that has all of them among its own.

Defined results: a null text or role is the empty string; an empty or very long
text is one turn; equal turn numbers are ordered by role, then text, and
repeated rows are repeated turns; an empty table gives no rows; columns that no
mapping names are ignored.  A row whose layout is unknown stops the run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.llm.common import unused_name

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
    " loss_sha256 string, formatted_chars long"
)


@dataclass(frozen=True)
class Mapping:
    """paths: columns and nested fields that tell the layout; turns: SQL for
    array<struct<turn, role, text>>."""

    name: str
    paths: tuple[str, ...]
    turns: str

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _said(role: str, column: str) -> str:
    return f"named_struct('role', '{role}', 'text', {column})"


def _numbered(items: str) -> str:
    return (
        f"transform({items}, (m, i) -> named_struct("
        "'turn', cast(i as bigint), 'role', m.role, 'text', m.text))"
    )


_SPEAKER = (
    "CASE m.`from` WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.`from` END"
)

MAPPINGS = (
    Mapping(
        "turn_rows",
        ("turn", "role", "text"),
        "array(named_struct('turn', cast(turn as bigint), 'role', role, 'text', text))",
    ),
    Mapping(
        "messages",
        ("messages", "messages[].role", "messages[].content"),
        _numbered("transform(messages, m -> named_struct('role', m.role, 'text', m.content))"),
    ),
    Mapping(
        "speakers",
        ("conversations", "conversations[].from", "conversations[].value"),
        _numbered(
            f"transform(conversations, m -> named_struct('role', {_SPEAKER}, 'text', m.value))"
        ),
    ),
    Mapping(
        "prompt",
        ("prompt", "completion"),
        _numbered(f"array({_said('user', 'prompt')}, {_said('assistant', 'completion')})"),
    ),
    Mapping(
        "prompt_system",
        ("system", "prompt", "completion"),
        _numbered(
            f"array({_said('system', 'system')}, {_said('user', 'prompt')},"
            f" {_said('assistant', 'completion')})"
        ),
    ),
    Mapping(
        "instruction",
        ("instruction", "output"),
        _numbered(f"array({_said('user', 'instruction')}, {_said('assistant', 'output')})"),
    ),
    Mapping(
        "instruction_input",
        ("instruction", "input", "output"),
        _numbered(
            "array("
            + _said("user", "concat(instruction, '\\n\\n', input)")
            + f", {_said('assistant', 'output')})"
        ),
    ),
)


def field_paths(schema: T.StructType) -> set[str]:
    """Paths of all fields; array elements are marked by []."""
    found = set()

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.ArrayType):
            walk(kind.elementType, path + "[]")
        elif isinstance(kind, T.StructType):
            for field in kind.fields:
                below = f"{path}.{field.name}" if path else field.name
                found.add(below)
                walk(field.dataType, below)

    walk(schema, "")
    return found


def layouts(fitting: list[Mapping]) -> dict[str, str]:
    """Fingerprint of each set of filled paths that tells one mapping -> its name.

    Paths inside an array are filled with the array, so they come and go together.
    """
    found: dict[str, str | None] = {}
    for m in fitting:
        columns = sorted({_column(p) for p in m.paths})
        for filled in product([False, True], repeat=len(columns)):
            there = {c for c, is_filled in zip(columns, filled) if is_filled}
            told = fingerprint(p for p in m.paths if _column(p) in there)
            found[told] = None if told in found else m.name
    return {k: name for k, name in found.items() if name} | {m.fingerprint: m.name for m in fitting}


def _column(path: str) -> str:
    return path.split("[")[0]


def layout_fingerprint(schema: T.StructType, fitting: list[Mapping]) -> F.Column:
    """Per row: the hash of the layout paths that this row fills."""
    known = sorted({p for m in fitting for p in m.paths} & field_paths(schema))
    filled = [F.when(F.col(f"`{_column(p)}`").isNotNull(), F.lit(p)) for p in known]
    return F.sha2(F.concat_ws("\n", *filled), 256)


def canonical_turns(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows of any known layout as (conv_id, turn, role, text, layout)."""
    paths = field_paths(df.schema)
    fitting = [m for m in MAPPINGS if set(m.paths) <= paths]
    if not fitting:
        raise ValueError(f"no mapping fits the fields {sorted(paths)}")
    mark = unused_name(df, "_print")
    layout, turns = F.lit(None).cast("string"), F.lit(None)
    told_by = layouts(fitting)
    for m in fitting:
        same = F.col(mark).isin([k for k, name in told_by.items() if name == m.name])
        layout = F.when(same, F.lit(m.name)).otherwise(layout)
        turns = F.when(same, F.expr(m.turns)).otherwise(turns)
    known = df.withColumn(mark, layout_fingerprint(df.schema, fitting))
    unknown = F.raise_error(F.concat(F.lit("unknown layout of conversation "), F.col(key)))
    told = known.select(
        F.col(key).cast("long").alias("conv_id"),
        layout.alias("layout"),
        F.when(layout.isNull(), unknown).otherwise(turns).alias("_turns"),
    )
    said = told.select("conv_id", "layout", F.explode("_turns").alias("t"))
    return said.select(
        "conv_id",
        F.col("t.turn").alias("turn"),
        F.coalesce("t.role", F.lit("")).alias("role"),
        F.coalesce("t.text", F.lit("")).alias("text"),
        "layout",
    )


def escaped(column: F.Column) -> F.Column:
    """Doubles backslashes and parts '<|', so no control string is left."""
    return F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted piece per turn, and which code points of it are learned.

    The pieces of a conversation, joined in order, are its formatted text, so a
    conversation of any length needs no row of its own.  text_start, loss_start
    and loss_length are counted in the piece; a turn that is not learned has no loss.
    """
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    body = escaped(F.col("text"))
    learned = F.col("role") == LEARNED_ROLE
    return turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        F.char_length(head).alias("text_start"),
        F.when(learned, F.char_length(head)).otherwise(0).alias("loss_start"),
        F.when(learned, F.char_length(body)).otherwise(0).alias("loss_length"),
    )


def read_role(piece: str = "formatted", start: str = "text_start") -> F.Column:
    """The role of a piece whose text begins at start."""
    length = F.col(start) - F.lit(len(START) + 1)
    return unescaped(F.substring(F.col(piece), F.lit(len(START) + 1), length))


def read_text(piece: str = "formatted", start: str = "text_start") -> F.Column:
    """The text of a piece, which begins at start."""
    length = F.char_length(piece) - F.col(start) - F.lit(len(END) + 1)
    return unescaped(F.substring(F.col(piece), F.col(start) + F.lit(1), length))


def unescaped(column: F.Column) -> F.Column:
    """A backslash stands for the character after it."""
    return F.regexp_replace(column, r"(?s)\\(.)", "$1")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0:
        out += [text[at:found], text[found + 1 : found + 2]]
        at = found + 2
    return "".join([*out, text[at:]])


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted piece."""
    if not (piece.startswith(START) and piece.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    at = len(START)
    while piece[at] != "\n":
        at += 2 if piece[at] == "\\" else 1
    return unescape(piece[len(START) : at]), unescape(piece[at + 1 : -len(END) - 1])


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int, length: int) -> None:
        role, text = read_piece(piece)
        learned = unescape(piece[start : start + length])
        self.n_turns += 1
        self.chars += len(piece)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars,
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; only one digest is open at a time."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )
    now = None
    for batch in batches:
        done = []
        for conv_id, piece, start, length in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                done += [now.row()] if now else []
                now = _Digest(conv_id)
            now.add(piece, start, length)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema
            )
    if now:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c], f.type) for c, f in zip(now.row(), schema)], schema=schema
        )


def digest(pieces: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its formatted pieces.

    A digest is sequential by nature, so a conversation's pieces pass one task;
    they stream through it in sorted batches and are never held together.  A
    piece is all that is shuffled of a turn: what equal turn numbers are ordered
    by is read back from it after that.
    """
    dealt = pieces.select(
        "conv_id", "turn", "formatted", "text_start", "loss_start", "loss_length"
    ).repartition("conv_id")
    return (
        dealt.withColumn("role", read_role())
        .withColumn("text", read_text())
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "formatted", "loss_start", "loss_length")
        .mapInArrow(_digests, DIGEST_SCHEMA)
    )
