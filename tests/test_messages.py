"""Rows to chat messages, through the Spark path."""

import json

import pytest

from loomset import format_examples, quarantined, scan_jsonl, template_renderer, to_chat_messages
from loomset.functions import PYTHON_WHITESPACE
from verify.queries import margin_text


def chat(*turns):
    return {"messages": [{"role": r, "content": c} for r, c in turns]}


def run(df, system_prompt=None):
    """One (code, index, [(role, content)]) per row, in row order."""
    out = []
    for row in to_chat_messages(df, system_prompt).orderBy("row_id").collect():
        turns = row.messages and [(m.role, m.content) for m in row.messages]
        out.append((row.error.code, row.error["index"], turns))
    return out


GOOD = {
    "chat": (
        chat(("user", "which way is north"), ("assistant", "past the mill")),
        [("user", "which way is north"), ("assistant", "past the mill")],
    ),
    "instruction with context": (
        {"instruction": "Count the boats.", "context": "two boats, one raft", "response": "two"},
        [("user", "Count the boats.\n\ntwo boats, one raft"), ("assistant", "two")],
    ),
    "output alias": ({"instruction": "spell tin", "output": "t i n"}, [("user", "spell tin"), ("assistant", "t i n")]),
    "prompt completion": (
        {"prompt": "P", "completion": "C"}, [("user", "P"), ("assistant", "C")],
    ),
    "messages win": (
        {**chat(("user", "m")), "prompt": "p", "completion": "c", "instruction": "i"},
        [("user", "m")],
    ),
    "instruction beats prompt": (
        {"instruction": "i", "response": "r", "prompt": "p", "completion": "c"},
        [("user", "i"), ("assistant", "r")],
    ),
    "empty context": (
        {"instruction": "i", "context": "", "response": "r"}, [("user", "i"), ("assistant", "r")],
    ),
    "null context": (
        {"instruction": "i", "context": None, "response": "r"}, [("user", "i"), ("assistant", "r")],
    ),
    "blank context counts": (
        {"instruction": "i", "context": " ", "response": "r"},
        [("user", "i\n\n "), ("assistant", "r")],
    ),
    "empty response": ({"instruction": "i", "response": ""}, [("user", "i"), ("assistant", "")]),
    "response wins over output": (
        {"instruction": "i", "response": "r", "output": "o"}, [("user", "i"), ("assistant", "r")],
    ),
    "null output is not read": (
        {"instruction": "i", "response": "r", "output": None}, [("user", "i"), ("assistant", "r")],
    ),
    "role stripped": (chat((" user\t", "x")), [("user", "x")]),
    "role stripped of all Python whitespace": (
        chat((PYTHON_WHITESPACE + "tool" + PYTHON_WHITESPACE, "x")), [("tool", "x")],
    ),
    "content not stripped": (chat(("user", "  a ")), [("user", "  a ")]),
    "extra key dropped": (
        {"messages": [{"role": "user", "content": "a", "x": 1}]}, [("user", "a")],
    ),
    "extra row keys ignored": ({"prompt": "P", "completion": "C", "id": 7}, [("user", "P"), ("assistant", "C")]),
    "all roles": (
        chat(("system", "s"), ("user", "u"), ("assistant", "a"), ("tool", "t")),
        [("system", "s"), ("user", "u"), ("assistant", "a"), ("tool", "t")],
    ),
    "repeated roles": (chat(("user", "1"), ("user", "2")), [("user", "1"), ("user", "2")]),
    "longest number": (
        '{"prompt": -0.%s1, "completion": "c"}' % ("0" * 3 + "1" * 34),
        [("user", "-0.%s1" % ("0" * 3 + "1" * 34)), ("assistant", "c")],
    ),
    "text that looks like JSON": (
        {"prompt": '{"a": 1}', "completion": "[]"}, [("user", '{"a": 1}'), ("assistant", "[]")],
    ),
    "content that looks like JSON": (
        chat(("user", "true"), ("assistant", '{"a": 1}'), ("tool", "1.0")),
        [("user", "true"), ("assistant", '{"a": 1}'), ("tool", "1.0")],
    ),
    "leading digit": (
        {"prompt": "1. do", "completion": "-12"}, [("user", "1. do"), ("assistant", "-12")],
    ),
    "unicode": ({"prompt": "é世 𝄞", "completion": "\u0000"}, [("user", "é世 𝄞"), ("assistant", "\u0000")]),
}




BAD = {
    "unknown": ({"foo": "bar"}, "UNKNOWN_SCHEMA", None),
    "empty object": ({}, "UNKNOWN_SCHEMA", None),
    "prompt only": ({"prompt": "p"}, "UNKNOWN_SCHEMA", None),
    "completion only": ({"completion": "p"}, "UNKNOWN_SCHEMA", None),
    "no response": ({"instruction": "x"}, "MISSING_RESPONSE", None),
    "no response despite prompt and completion": (
        {"instruction": "x", "prompt": "p", "completion": "c"}, "MISSING_RESPONSE", None,
    ),
    "null response with output": (
        {"instruction": "x", "response": None, "output": "B"}, "MISSING_RESPONSE", None,
    ),
    "null output": ({"instruction": "x", "output": None}, "MISSING_RESPONSE", None),
    "null instruction": ({"instruction": None, "output": "a"}, "NULL_FIELD", None),
    "null prompt": ({"prompt": None, "completion": "c"}, "NULL_FIELD", None),
    "strange role": (chat(("narrator", "x")), "INVALID_ROLE", 0),
    "upper case role": (chat(("User", "x")), "INVALID_ROLE", 0),
    "null role": (chat((None, "x")), "INVALID_ROLE", 0),
    "number role": (chat((5, "x")), "INVALID_ROLE", 0),
    "empty list": ({"messages": []}, "MESSAGES_EMPTY", None),
    "string": ({"messages": "str"}, "MESSAGES_EMPTY", None),
    "string with a list": ({"messages": '[{"role":"user","content":"x"}]'}, "MESSAGES_EMPTY", None),
    "null": ({"messages": None}, "MESSAGES_EMPTY", None),
    "object": ({"messages": {"role": "user", "content": "x"}}, "MESSAGES_EMPTY", None),
    "null messages beside a prompt": (
        {"messages": None, "prompt": "a", "completion": "b"}, "MESSAGES_EMPTY", None,
    ),
    "text element": (
        {"messages": ["x", {"role": "user", "content": "c"}]}, "MESSAGE_KEYS", 0,
    ),
    "element that looks like JSON": (
        {"messages": ['{"role":"user","content":"c"}']}, "MESSAGE_KEYS", 0,
    ),
    "null element": ({"messages": [{"role": "user", "content": "c"}, None]}, "MESSAGE_KEYS", 1),
    "no content": ({"messages": [{"role": "user"}]}, "MESSAGE_KEYS", 0),
    "first bad turn: role": (
        {"messages": [{"role": "x", "content": "c"}, {"role": "user"}]}, "INVALID_ROLE", 0,
    ),
    "first bad turn: keys": (
        {"messages": [{"role": "user", "content": "c"}, {"role": "user"}, {"role": "x", "content": ""}]},
        "MESSAGE_KEYS", 1,
    ),
    "null content": (chat(("user", "a"), ("assistant", None)), "NULL_FIELD", 1),
    "array": ([1], "NOT_A_MAPPING", None),
    "array of rows": ([{"prompt": "p", "completion": "c"}], "NOT_A_MAPPING", None),
    "number": ("5", "NOT_A_MAPPING", None),
    "null line": ("null", "NOT_A_MAPPING", None),
    "text line": ('"x"', "NOT_A_MAPPING", None),
    "broken": ('{"prompt": ', "BAD_JSON", None),
    "no JSON": ("hello", "BAD_JSON", None),
    "two rows in a line": ('{"prompt":"p","completion":"c"} {"prompt":"p","completion":"c"}', "BAD_JSON", None),
    "two rows in a line, comma": ('{"prompt":"p","completion":"c"},{"prompt":"p","completion":"c"}', "BAD_JSON", None),
    "trailing text": ('{"prompt":"p","completion":"c"} x', "BAD_JSON", None),
    "trailing brace": ('{"prompt":"p","completion":"c"}} x', "BAD_JSON", None),
    "trailing bracket": ('{"prompt":"p","completion":"c"}]', "BAD_JSON", None),
    "single quotes": ("{'prompt':'p','completion':'c'}", "BAD_JSON", None),
    "NaN": ('{"prompt":NaN,"completion":"c"}', "BAD_JSON", None),
    "duplicate key": ('{"prompt":"a","prompt":"b","completion":"c"}', "BAD_JSON", None),
}


EXPECTED = {
    **{f"good: {name}": (row, (None, None, turns)) for name, (row, turns) in GOOD.items()},
    **{f"bad: {name}": (row, (code, index, None)) for name, (row, code, index) in BAD.items()},
}


@pytest.fixture(scope="module")
def results(spark):
    """All rows in one mixed table, so that each must keep its own schema."""
    lines = [r if isinstance(r, str) else json.dumps(r) for r, _ in EXPECTED.values()]
    df = spark.createDataFrame(list(enumerate(lines)), "row_id bigint, value string")
    return dict(zip(EXPECTED, run(df)))


@pytest.mark.parametrize("name", EXPECTED)
def test_row(results, name):
    assert results[name] == EXPECTED[name][1]


SCALARS = {"True": True, "False": False, "5": 5, "-3": -3, "1.0": 1.0, "1.5": 1.5, "100.0": 100.0, "-0.25": -0.25, "12345678901234567890": 12345678901234567890}


def test_scalars_read_as_in_python(json_rows):
    pairs = [{"prompt": v, "completion": v} for v in SCALARS.values()]
    chats = [chat(("user", v), ("assistant", v)) for v in SCALARS.values()]
    assert all(text == str(v) for text, v in SCALARS.items())
    want = [(None, None, [("user", t), ("assistant", t)]) for t in SCALARS]
    assert run(json_rows(*pairs, *chats)) == want + want


def test_context_counts_when_python_calls_it_true(json_rows):
    false = [0, 0.0, False, [], {}, None, ""]
    true = ["0", "False", "[]", " ", 1, True]
    rows = [{"instruction": "i", "context": c, "response": "r"} for c in false + true]
    users = [turns[0][1] for _, _, turns in run(json_rows(*rows))]
    assert users == ["i"] * len(false) + [f"i\n\n{c}" for c in true]


def test_system_prompt(json_rows):
    pc = {"prompt": "P", "completion": "C"}
    own = chat(("system", "sys"), ("user", "u"))
    later = chat(("user", "u"), ("system", "late"))
    rows = json_rows(pc, own, later, {"foo": 1})
    first = [turns and turns[0] for _, _, turns in run(rows, "Answer in verse.")]
    assert first == [("system", "Answer in verse."), ("system", "sys"), ("system", "Answer in verse."), None]
    assert [t and len(t) for _, _, t in run(rows, "Answer in verse.")] == [3, 2, 3, None]
    assert run(rows, "") == run(rows, None)


def test_typed_table_counts_a_column_as_present_when_not_null(spark):
    df = spark.createDataFrame(
        [
            (0, None, "spell tin", None, None, "t i n", None, None),
            (1, None, None, None, None, None, "P", "C"),
            (2, [("user", "north")], "spell", None, None, None, None, None),
            (3, [], None, None, None, None, None, None),
            (4, [(None, "x")], None, None, None, None, None, None),
            (5, [("user", None)], None, None, None, None, None, None),
            (6, None, None, None, None, None, "P", None),
            (7, None, "spell", "tin", "t i n", "no", None, None),
        ],
        "row_id bigint, messages array<struct<role:string,content:string>>, instruction string,"
        "context string, response string, output string, prompt string, completion string",
    )
    assert run(df) == [
        (None, None, [("user", "spell tin"), ("assistant", "t i n")]),
        (None, None, [("user", "P"), ("assistant", "C")]),
        (None, None, [("user", "north")]),
        ("MESSAGES_EMPTY", None, None),
        ("MESSAGE_KEYS", 0, None),
        ("MESSAGE_KEYS", 0, None),
        ("UNKNOWN_SCHEMA", None, None),
        (None, None, [("user", "spell\n\ntin"), ("assistant", "t i n")]),
    ]


def test_typed_table_with_other_column_types(spark):
    numbers = spark.createDataFrame([(0, 5, True)], "row_id bigint, prompt int, completion boolean")
    assert run(numbers) == [(None, None, [("user", "5"), ("assistant", "True")])]
    maps = spark.createDataFrame(
        [(0, [{"role": "user ", "content": "c", "x": "y"}]), (1, [{"role": "user"}])],
        "row_id bigint, messages array<map<string,string>>",
    )
    assert run(maps) == [(None, None, [("user", "c")]), ("MESSAGE_KEYS", 0, None)]
    text = spark.createDataFrame([(0, "x"), (1, None)], "row_id bigint, messages string")
    assert run(text) == [("MESSAGES_EMPTY", None, None), ("UNKNOWN_SCHEMA", None, None)]
    no_content = spark.createDataFrame([(0, [("user",)])], "row_id bigint, messages array<struct<role:string>>")
    assert run(no_content) == [("MESSAGE_KEYS", 0, None)]


def texts(df, **kwargs):
    return [row.text for row in format_examples(df, **kwargs).orderBy("row_id").collect()]


def test_chatml_text(json_rows):
    rows = json_rows({"prompt": "P", "completion": "C"}, {"foo": 1})
    text = "<|im_start|>user\nP<|im_end|>\n<|im_start|>assistant\nC<|im_end|>"
    assert texts(rows) == [text, None]
    assert texts(rows, add_generation_prompt=True) == [text + "\n<|im_start|>assistant\n", None]
    system = "<|im_start|>system\nS<|im_end|>\n"
    assert texts(rows, system_prompt="S") == [system + text, None]


def test_own_renderer(json_rows):
    rows = json_rows({"prompt": " P\n", "completion": "C"})
    assert texts(rows, renderer=margin_text) == ["     user > P\nassistant > C"]


def test_a_template_that_refuses_a_row(json_rows):
    def template(messages, tokenize=False, add_generation_prompt=False):
        if messages[0]["content"] == "no":
            raise RuntimeError("not this one")
        return messages[0]["content"]

    rows = json_rows({"prompt": "yes", "completion": "C"}, {"prompt": "no", "completion": "C"}, {"foo": 1})
    done = format_examples(rows, renderer=template_renderer(template)).orderBy("row_id").collect()
    assert [(r.error.code, r.text) for r in done] == [
        (None, "yes"), ("TEMPLATE_FAILED", None), ("UNKNOWN_SCHEMA", None),
    ]


SPLIT_LINES = [
    '{"prompt":"p","completion":"c"},"x":1',
    '{"prompt":"p","completion":"c"},"end":5} garbage',
    '{"text":"a"},"end":0}{"text":"b"}',
    '{"prompt":"p","completion":"c"},31',
    '{"prompt":"p","completion":"c"}],[1',
    '{"prompt":"p","completion":"c"},34]',
]


@pytest.mark.parametrize("line", SPLIT_LINES)
def test_lines_that_close_the_wrapper(json_rows, line):
    assert [r.error_code for r in quarantined(to_chat_messages(json_rows(line))).collect()] == ["BAD_JSON"]


def test_a_line_can_not_state_its_own_length(json_rows):
    """Of all lengths that a line could claim, none makes it two values."""
    head = '{"prompt":"p","completion":"c"},'
    rows = json_rows(*[f"{head}{n}" for n in range(20, 60)])
    assert quarantined(to_chat_messages(rows)).count() == 40


def test_deep_rows(json_rows):
    def nested(n):
        return '{"prompt":"p","completion":"c","x":%s%s}' % ("[" * n, "]" * n)

    found = run(json_rows(nested(1200), nested(5000), nested(100_000)))
    assert [code for code, _, _ in found] == [None, "ROW_TOO_LARGE", "ROW_TOO_LARGE"]


@pytest.mark.parametrize(
    ("size", "end", "code"),
    [
        (21_000_000, '","completion":"c"}', None),
        # a VARIANT ends at 128 MiB; valid rows beyond it are told from broken ones
        (140_000_000, '","completion":"c"}', "ROW_TOO_LARGE"),
        (140_000_000, '"', "BAD_JSON"),
    ],
)
def test_very_long_texts(spark, tmp_path, size, end, code):
    path = tmp_path / "long.jsonl"
    path.write_text('{"prompt":"' + "x" * size + end + "\n")
    rows = to_chat_messages(scan_jsonl(spark, str(path)))
    found = rows.selectExpr("error.code", "length(messages[0].content) as n").collect()
    assert [(r.code, r.n) for r in found] == [(code, None if code else size)]


VALUES = [True, False, 0, 5, -3, 1.0, 1.5, -0.25, 1e7, 123456789.25, 1e-4, 2.5e-5, 1e16, 1.5e300, -1e-7]


def test_typed_values_read_like_those_of_json(spark, json_rows):
    """The same values, from JSON text and from typed columns."""
    lines = [{"instruction": "i", "context": v, "output": v} for v in VALUES]
    lines += [{"messages": [{"role": "user", "content": v}]} for v in VALUES]
    raw = [turns for _, _, turns in run(json_rows(*lines))]
    assert [t[-1][1] for t in raw] == [str(v) for v in VALUES] * 2
    kinds = {bool: "boolean", int: "bigint", float: "double"}
    for i, v in enumerate(VALUES):
        kind = kinds[type(v)]
        table = spark.createDataFrame(
            [(0, None, "i", v, v), (1, [("user", v)], None, None, None)],
            f"row_id bigint, messages array<struct<role:string,content:{kind}>>,"
            f"instruction string, context {kind}, output {kind}",
        )
        assert [turns for _, _, turns in run(table)] == [raw[i], raw[i + len(VALUES)]]


def test_typed_nested_values(spark):
    table = spark.createDataFrame([(0, "p", (1, ["a"]))], "row_id bigint, prompt string, completion struct<a:int,b:array<string>>")
    assert run(table)[0][2][1] == ("assistant", '{"a":1,"b":["a"]}')


def test_integers_of_more_than_38_digits_are_floats(json_rows):
    line = '{"prompt": %s, "completion": "c"}' % ("1" * 45)
    role, text = run(json_rows(line))[0][2][0]
    assert text.endswith("e+44") and float(text) == pytest.approx(float("1" * 45), rel=1e-15)


def test_a_typed_table_may_have_a_column_value(spark):
    table = spark.createDataFrame([(0, "p", "c", "v")], "row_id bigint, prompt string, completion string, value string")
    assert run(table) == [(None, None, [("user", "p"), ("assistant", "c")])]
    only = spark.createDataFrame([(0, '{"prompt":"p","completion":"c"}')], "row_id bigint, value string")
    assert [r.error.code for r in to_chat_messages(only, value=None).collect()] == ["UNKNOWN_SCHEMA"]


def test_long_text_is_kept_whole(json_rows):
    long = "word " * 400_000
    (text,) = texts(json_rows({"prompt": long, "completion": "C"}))
    assert f"user\n{long}<|im_end|>" in text
