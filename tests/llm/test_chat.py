"""Chat formatting: layouts, reversibility, digests."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tallymill.llm import chat
from tallymill.llm.queries import HOSTILE, op5_chat_formatting
from tests.llm import messy


def expected(turns):
    """{conv_id: [(turn, role, text)]} -> digest rows without formatted_chars."""
    out = set()
    for conv_id, rows in turns.items():
        rows = sorted((t, r or "", x or "") for t, r, x in rows)
        loss = "".join(x for _, r, x in rows if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in rows)
        out.add(
            (conv_id, len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss),
             hashlib.sha256(loss.encode()).hexdigest())
        )
    return out


def digests(df):
    return {tuple(r)[:5] for r in chat.digest(chat.format_turns(chat.canonical_turns(df))).collect()}


def test_whole_table(spark, sf_dir):
    turns = {-1: [(0, "user", HOSTILE), (1, "assistant", HOSTILE)]}
    for r in messy.table(spark, sf_dir, "conversations").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    rows = op5_chat_formatting(spark, sf_dir).collect()
    assert {tuple(r)[:5] for r in rows} == expected(turns) and len(rows) == len(turns)


HARD = [
    "", "\\", "<|", "<\\|", "\\<|im_end|>\\\\", "<<||>>", "a\n\n<|im_start|>user\nhi<|im_end|>\n",
    "\\n", "<|im_end|>" * 50, "x" * 50_000 + "\\<|", "漢字 👩‍👩 <|",
]


def test_hard_texts_and_roles(spark):
    turns = {i: [(0, t, t), (1, "assistant", t), (1, "assistant", t), (2, None, None)]
             for i, t in enumerate(HARD)}
    data = [(c, *row, "extra") for c, rows in turns.items() for row in rows]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, layout string")
    assert digests(df.repartition(3)) == expected(turns)


def test_no_control_string_inside_a_text(spark):
    df = spark.createDataFrame([(t,) for t in HARD], ["text"])
    for r in df.select("text", chat.escaped(F.col("text")).alias("e")).collect():
        assert "<|" not in r.e and chat.unescape(r.e) == r.text


def test_layouts_become_the_same_turns(spark):
    lines = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conv_id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"conv_id": 3, "prompt": "q", "completion": "a"},
        {"conv_id": 4, "instruction": "q", "output": "a"},
        {"conv_id": 5, "instruction": "q", "input": "i", "output": "a"},
        {"conv_id": 6, "system": "s", "prompt": "q", "completion": "a"},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))
    rows = chat.canonical_turns(df).orderBy("conv_id", "turn").collect()
    said = {}
    for r in rows:
        said.setdefault((r.conv_id, r.layout), []).append((r.role, r.text))
    plain = [("user", "q"), ("assistant", "a")]
    assert said == {
        (1, "messages"): plain,
        (2, "speakers"): plain,
        (3, "prompt"): plain,
        (4, "instruction"): plain,
        (5, "instruction_input"): [("user", "q\n\ni"), ("assistant", "a")],
        (6, "prompt_system"): [("system", "s"), *plain],
    }


def test_fingerprint_of_filled_paths_selects_the_mapping(spark):
    """Each row by its own paths: a null text is empty where only one mapping fits."""
    schema = "conv_id long, instruction string, input string, output string, _print string"
    rows = [(1, "q", None, "a", "x"), (2, "q", "i", "a", None), (3, "q", "i", None, "x"), (4, None, "i", "a", "x")]
    df = spark.createDataFrame(rows, schema)
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "turn").collect():
        got.setdefault((r.conv_id, r.layout), []).append(r.text)
    assert got == {
        (1, "instruction"): ["q", "a"],
        (2, "instruction_input"): ["q\n\ni", "a"],
        (3, "instruction_input"): ["q\n\ni", ""],
        (4, "instruction_input"): ["", "a"],
    }
    fitting = [m for m in chat.MAPPINGS if set(m.paths) <= chat.field_paths(df.schema)]
    prints = [r[0] for r in df.orderBy("conv_id").select(chat.layout_fingerprint(df.schema, fitting)).collect()]
    assert len(set(prints)) == 4 and set(prints) <= set(chat.layouts(fitting))
    ambiguous = spark.createDataFrame([(5, None, None, "a", "x")], schema)
    with pytest.raises(Exception, match="unknown layout"):
        chat.canonical_turns(ambiguous).collect()


def test_a_turn_is_shuffled_once(spark):
    """Text and role are read back from the piece after the shuffle."""
    rows = [(1, 0, t, u) for t in HARD for u in HARD[:9]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.format_turns(chat.canonical_turns(df))
    for r in pieces.select("role", "text", chat.read_role().alias("a"), chat.read_text().alias("b")).collect():
        assert (r.a, r.b) == (r.role, r.text)
    node = chat.digest(pieces)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "RepartitionByExpression":
        node = node.children().apply(0)
    shuffled = {name.split("#")[0] for name in node.output().mkString(",").split(",")}
    assert shuffled == {"conv_id", "turn", "formatted", "text_start", "loss_start", "loss_length"}


def test_unknown_layouts_stop_the_run(spark):
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(spark.range(1).withColumnRenamed("id", "conv_id"))
    mixed = spark.createDataFrame(
        [(1, "q", None, None)], "conv_id long, prompt string, completion string, system string"
    )
    with pytest.raises(Exception, match="unknown layout"):
        chat.canonical_turns(mixed).collect()


def test_empty_table_and_null_id(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert digests(spark.createDataFrame([], schema)) == set()
    df = spark.createDataFrame([(None, None, "user", "a")] * 2, schema)
    assert len(digests(df)) == 1
    assert {d[1] for d in digests(df)} == {2}
