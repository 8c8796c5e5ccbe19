"""Preference rows."""

import pytest

from loomset import template_renderer, to_preference_examples
from verify.queries import margin_text


def run(df, **kwargs):
    out = to_preference_examples(df, **kwargs).orderBy("row_id").collect()
    return [(r.error.code, r.error["index"], r.prompt, r.chosen, r.rejected) for r in out]


PAIR = {"chosen": "good", "rejected": "bad"}


def turns(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


def test_prompts(json_rows):
    rows = json_rows(
        {"prompt": "How tall is it?", **PAIR},
        {"messages": turns(("user", "m"), ("assistant", "a")), "prompt": "p", **PAIR},
        {"prompt": "p", "instruction": "i", **PAIR},
        {"instruction": "Sort these.", "context": "b a", **PAIR},
        {"instruction": "Sort these.", "context": "", **PAIR},
        {"messages": turns(("system", "own"), ("user", "u")), **PAIR},
    )
    got = [prompt for _, _, prompt, _, _ in run(rows, renderer=margin_text)]
    assert got == [
        "     user > How tall is it?\nassistant > ",
        "     user > m\nassistant > a\nassistant > ",
        "     user > p\nassistant > ",
        "     user > Sort these.\n\nb a\nassistant > ",
        "     user > Sort these.\nassistant > ",
        "   system > own\n     user > u\nassistant > ",
    ]
    with_system = [p for _, _, p, _, _ in run(rows, renderer=margin_text, system_prompt="S")]
    assert with_system == [p if p.startswith("   system") else "   system > S\n" + p for p in got]
    chatml = run(rows)[3]
    assert chatml[2] == "<|im_start|>user\nSort these.\n\nb a<|im_end|>\n<|im_start|>assistant\n"
    assert chatml[3:] == ("good", "bad")


def test_python_template(json_rows):
    def template(messages, tokenize=False, add_generation_prompt=False):
        assert not tokenize and add_generation_prompt
        return "|".join(m["content"] for m in messages)

    rows = json_rows({"prompt": "p", **PAIR}, {"foo": 1})
    got = run(rows, renderer=template_renderer(template), system_prompt="S")
    assert [r[2] for r in got] == ["S|p", None]


def test_a_template_that_refuses_a_row(json_rows):
    def template(messages, tokenize=False, add_generation_prompt=False):
        raise ValueError("never")

    got = run(json_rows({"prompt": "p", **PAIR}), renderer=template_renderer(template))
    assert got == [("TEMPLATE_FAILED", None, None, None, None)]


BAD = [
    ({"prompt": "p", "chosen": "c"}, "PREF_MISSING_FIELDS", None),
    ({"prompt": "p", "rejected": "c"}, "PREF_MISSING_FIELDS", None),
    ({"foo": 1, "chosen": "c"}, "PREF_MISSING_FIELDS", None),
    ({"messages": [], "chosen": "c"}, "PREF_MISSING_FIELDS", None),
    (PAIR, "UNKNOWN_SCHEMA", None),
    ({"completion": "c", **PAIR}, "UNKNOWN_SCHEMA", None),
    ({"messages": [], **PAIR}, "MESSAGES_EMPTY", None),
    ({"messages": turns(("user", "a"), ("Narrator", "b")), **PAIR}, "INVALID_ROLE", 1),
    ({"messages": ["x"], **PAIR}, "MESSAGE_KEYS", 0),
    ({"messages": None, "prompt": "p", **PAIR}, "MESSAGES_EMPTY", None),
    ({"prompt": None, **PAIR}, "NULL_FIELD", None),
    ({"instruction": None, **PAIR}, "NULL_FIELD", None),
    ({"prompt": "p", "chosen": None, "rejected": "r"}, "NULL_FIELD", None),
    ([1], "NOT_A_MAPPING", None),
    ("{", "BAD_JSON", None),
]


def test_errors(json_rows):
    got = run(json_rows(*[row for row, _, _ in BAD]))
    assert got == [(code, index, None, None, None) for _, code, index in BAD]


def test_answers_are_text(json_rows):
    rows = json_rows({"prompt": "p", "chosen": True, "rejected": 1.0}, {"prompt": "", "chosen": "", "rejected": ""})
    assert [r[3:] for r in run(rows)] == [("True", "1.0"), ("", "")]


def test_typed_table(spark):
    df = spark.createDataFrame(
        [(0, "p", None, "c", "r"), (1, None, "i", "c", "r"), (2, "p", None, None, "r"), (3, None, None, "c", "r")],
        "row_id bigint, prompt string, instruction string, chosen string, rejected string",
    )
    got = run(df, renderer=margin_text)
    assert [(r[0], r[2]) for r in got] == [
        (None, "     user > p\nassistant > "),
        (None, "     user > i\nassistant > "),
        ("PREF_MISSING_FIELDS", None),
        ("UNKNOWN_SCHEMA", None),
    ]
