"""Rows to chat messages.

The functions that take ``fields`` build the expressions of one row out of the
columns in :class:`loomset.operators.rows.RowFields`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import bind, evaluate_once, message, prepend_system_prompt
from loomset.operators import codes
from loomset.operators.rows import RESERVED, SFT_KEYS, RowFields, open_rows


# Columns that the row operators replace where a table has them already.
REPLACED = ("messages", "schema_kind", "error")


def kept(df: DataFrame, *replaced: str) -> list[str]:
    """The columns that stay, quoted; names are compared as Spark does, in any case."""
    low = {name.lower() for name in replaced}
    return ["`" + c.replace("`", "``") + "`" for c in df.columns if c.lower() not in low]


def outcome(
    kind: str | None,
    row_error: Column,
    messages: Column | None = None,
    finish: Callable[[Column], Column] | None = None,
) -> Column:
    """``struct<schema_kind, error, result>`` of one row."""
    result = F.lit(None) if messages is None else finish(messages)
    return F.struct(
        F.lit(kind).alias("schema_kind"), row_error.alias("error"), result.alias("result")
    )


def error(code: Column | str | None, index: Column | None = None) -> Column:
    """One error value; NULL code for a good row."""
    code = F.lit(code) if code is None or isinstance(code, str) else code
    index = F.lit(None) if index is None else index
    return F.struct(code.cast("string").alias("code"), index.cast("int").alias("index"))


def turns_error(turns: Column) -> Column:
    """Error of the row's own turns; the first bad turn counts."""
    bad = F.filter(turns, lambda t: t["problem"].isNotNull())
    return F.when(
        turns.isNull() | (F.size(turns) == 0), error(codes.MESSAGES_EMPTY)
    ).otherwise(
        bind(F.get(bad, F.lit(0)), lambda first: error(first["problem"], first["index"]))
    )


def normalized_turns(turns: Column) -> Column:
    """The row's own turns with stripped roles and without extra keys."""
    return F.transform(turns, lambda t: message(t["role"], t["content"]))


def instruction_text(fields: RowFields) -> Column:
    """The instruction, followed by the context when there is one."""
    instruction, context = fields.text("instruction"), fields.text("context")
    return F.when(
        context.isNotNull(), F.concat(instruction, F.lit("\n\n"), context)
    ).otherwise(instruction)


def response_text(fields: RowFields) -> Column:
    """``response`` when the row has that key, else ``output``."""
    return F.when(fields.present("response"), fields.text("response")).otherwise(
        fields.text("output")
    )


def null_error(*texts: Column) -> Column:
    """``NULL_FIELD`` when one of the texts is NULL."""
    some_null = F.lit(False)
    for text in texts:
        some_null |= text.isNull()
    return error(F.when(some_null, codes.NULL_FIELD))


def two_turns(user: Column, assistant: Column) -> Column:
    return F.array(message("user", user), message("assistant", assistant))


def sft_outcome(fields: RowFields, finish: Callable[[Column], Column]) -> Column:
    """``struct<schema_kind, error, result>`` of an SFT row.

    The schema is found by the keys that the row carries: ``messages`` goes before
    ``instruction``, and that before ``prompt`` with ``completion``.  ``finish``
    makes the result out of the messages.
    """

    prompt, completion = fields.text("prompt"), fields.text("completion")
    answer_error = F.when(
        response_text(fields).isNull(), error(codes.MISSING_RESPONSE)
    ).otherwise(null_error(fields.text("instruction")))
    return (
        F.when(fields.row_error.isNotNull(), outcome(None, error(fields.row_error)))
        .when(
            fields.has_messages,
            bind(
                fields.turns,
                lambda turns: bind(
                    normalized_turns(turns),
                    lambda messages: outcome("messages", turns_error(turns), messages, finish),
                ),
            ),
        )
        .when(
            fields.present("instruction"),
            outcome(
                "instruction",
                answer_error,
                two_turns(instruction_text(fields), response_text(fields)),
                finish,
            ),
        )
        .when(
            fields.present("prompt") & fields.present("completion"),
            outcome(
                "prompt_completion",
                null_error(prompt, completion),
                two_turns(prompt, completion),
                finish,
            ),
        )
        .otherwise(outcome(None, error(codes.UNKNOWN_SCHEMA)))
    )


def sft_rows(
    df: DataFrame, finish: Callable[[Column], Column], result: str, value: str | None = "value"
) -> DataFrame:
    """Add ``schema_kind``, ``error`` and the result, NULL where ``error`` is set."""
    opened, fields = open_rows(df, SFT_KEYS, value)
    keep = kept(df, *REPLACED, result)
    found = F.col(RESERVED + "outcome")
    return evaluate_once(
        opened.select(*keep, sft_outcome(fields, finish).alias(RESERVED + "outcome")),
        keep,
        {
            "schema_kind": found["schema_kind"],
            "error": found["error"],
            result: F.when(found["error"]["code"].isNull(), found["result"]),
        },
    )


def to_chat_messages(
    df: DataFrame, system_prompt: str | None = None, value: str | None = "value"
) -> DataFrame:
    """Add ``schema_kind``, ``error`` and ``messages`` to raw or typed SFT rows.

    ``messages`` is NULL exactly where ``error.code`` is set.  Rows are kept, so
    that the caller can set the bad ones aside.
    """
    return sft_rows(
        df, lambda messages: prepend_system_prompt(messages, system_prompt), "messages", value
    )
