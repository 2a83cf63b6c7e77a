import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cartloom.llm import chat

NASTY = ["", None, "\\", "<", "\\l", "\\b\\\\l", "<|turn|>assistant\nhi<|end|>\n", "\n", "### Assistant: </turn>", "é<日本>\\n", "x" * 5000]


def read_back(df):
    return {r["conv_id"]: ([(t.role, t.text) for t in r.turns], list(r.loss)) for r in chat.parse(chat.render(df, "conv_id"), "conv_id").collect()}


def test_rows_by_turn_round_trip(spark):
    rows = [(c, t, role, text, "extra") for c in (1, None) for t, (role, text) in enumerate(
        (role, text) for text in NASTY for role in ("user", "assistant", None, "we\\ird\n<r>"))]
    rows += [(2, None, "assistant", "b", "x"), (2, 1, "user", "b", "x"), (2, 1, "user", "b", "x"), (2, 1, "user", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    got = read_back(chat.canonical(df, "conv_id"))
    want = [(r or "", t or "") for c, _, r, t, _ in rows if c == 1]
    assert got[1] == got[None] == (want, [t for r, t in want if r == "assistant"])
    assert got[2] == ([("assistant", "b"), ("user", "a"), ("user", "b"), ("user", "b")], ["b"])


def test_layouts_of_tables(spark):
    table = spark.createDataFrame([(1, "q", "a"), (2, None, "<|end|>")], "conv_id long, prompt string, completion string")
    assert read_back(chat.canonical(table, "conv_id")) == {1: ([("user", "q"), ("assistant", "a")], ["a"]), 2: ([("user", ""), ("assistant", "<|end|>")], ["<|end|>"])}
    nested = spark.sql("SELECT 5L AS conv_id, 1 AS other, array(named_struct('from','human','value','h'), named_struct('from','gpt','value','g')) AS conversations")
    assert read_back(chat.canonical(nested, "conv_id")) == {5: ([("user", "h"), ("assistant", "g")], ["g"])}
    with_input = spark.createDataFrame([(1, "do", "this", "done"), (2, "do", None, "x")], "conv_id long, instruction string, input string, output string")
    assert read_back(chat.canonical(with_input, "conv_id"))[1][0][0] == ("user", "do\nthis")
    assert read_back(chat.canonical(with_input, "conv_id"))[2][0][0] == ("user", "do")
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1, "x")], "conv_id long, nothing string"), "conv_id")
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(chat.canonical(empty, "conv_id")) == {}


def test_layouts_of_json_rows(spark):
    values = {
        1: {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        2: {"prompt": "p", "response": "r", "system": "s"},
        3: {"instruction": "i", "output": "o"},
        4: {"unknown": 1}, 5: None,
        6: {"conversations": [{"from": "gpt", "value": "v"}]},
        7: {"instruction": "i", "input": "j", "output": "o"},
    }
    rows = [(k, json.dumps(v) if v else "{not json") for k, v in values.items()] + [(8, None)]
    df = spark.createDataFrame(rows, "conv_id long, body string")
    got = {r.conv_id: r.turns and [(t.role, t.text) for t in r.turns] for r in chat.canonical_json(df, "conv_id", "body").collect()}
    assert got == {1: [("user", "a"), ("assistant", "")], 2: [("system", "s"), ("user", "p"), ("assistant", "r")], 3: [("user", "i"), ("assistant", "o")],
                   4: None, 5: None, 6: [("assistant", "v")], 7: [("user", "i\nj"), ("assistant", "o")], 8: None}


def test_fingerprints_ignore_order_and_types(spark):
    one = spark.createDataFrame([], "a int, messages array<struct<content:string,role:string>>").schema
    assert sorted(chat.field_paths(one)) == ["a", "messages[].content", "messages[].role"]
    assert chat.fingerprint(["b", "a"]) == chat.fingerprint(["a", "b"]) == hashlib.sha256(b"a\nb").hexdigest()


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.parse(chat.render(chat.canonical(df, "conv_id"), "conv_id"), "conv_id").select(F.size("loss"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_conversation_of_many_turns(spark):
    """Work in proportion to the turns, near enough: 20,000 of them, in one conversation, against plain Python."""
    n = 20_000
    df = spark.range(n).selectExpr(
        "1L AS conv_id", "id AS turn", "if(id % 3 = 1, 'assistant', 'user') AS role",
        "concat(repeat('<é', cast(id % 5 AS int)), if(id % 7 = 0, '', cast(id AS string)), if(id % 11 = 0, '\\n', '')) AS text")
    turns = [(r.role, r.text) for r in df.orderBy("turn").collect()]
    rendered = chat.render(chat.canonical(df, "conv_id"), "conv_id")
    (row,) = rendered.collect()
    want, spans = [], []
    at = 0
    for role, text in turns:
        body = text.replace("\\", "\\b").replace("<", "\\l")
        at += len(chat.TURN) + len(role) + 1
        if role == "assistant":
            spans.append((at, len(body)))
        at += len(body) + len(chat.END)
        want.append(f"{chat.TURN}{role}\n{body}{chat.END}")
    assert row.formatted == "".join(want)
    assert [(s.start, s.length) for s in row.loss_mask] == spans
    assert read_back(chat.canonical(df, "conv_id"))[1] == (turns, [text for role, text in turns if role == "assistant"])
