"""Preference rows to ``prompt``, ``chosen`` and ``rejected`` texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import (
    Renderer,
    bind,
    evaluate_once,
    message,
    prepend_system_prompt,
    render_chatml,
)
from loomset.operators import codes
from loomset.operators.messages import (
    REPLACED,
    error,
    instruction_text,
    kept,
    normalized_turns,
    null_error,
    outcome,
    turns_error,
)
from loomset.operators.render import rendered
from loomset.operators.rows import PREFERENCE_KEYS, RESERVED, RowFields, open_rows


def preference_outcome(fields: RowFields, finish: Callable[[Column], Column]) -> Column:
    """``struct<schema_kind, error, result>`` of a preference row.

    The two answers are required before the prompt's schema is looked at.  The
    order differs from the SFT one: ``messages``, ``prompt``, ``instruction``.
    """

    def user(text: Column) -> Column:
        return F.array(message("user", text))

    answers = fields.text("chosen"), fields.text("rejected")

    def messages_error(turns: Column) -> Column:
        return bind(
            turns_error(turns),
            lambda own: F.when(own["code"].isNotNull(), own).otherwise(null_error(*answers)),
        )

    return (
        F.when(fields.row_error.isNotNull(), outcome(None, error(fields.row_error)))
        .when(
            fields.has_messages,
            bind(
                fields.turns,
                lambda turns: bind(
                    normalized_turns(turns),
                    lambda messages: outcome(
                        "messages", messages_error(turns), messages, finish
                    ),
                ),
            ),
        )
        .when(
            fields.present("prompt"),
            outcome(
                "prompt",
                null_error(fields.text("prompt"), *answers),
                user(fields.text("prompt")),
                finish,
            ),
        )
        .when(
            fields.present("instruction"),
            outcome(
                "instruction",
                null_error(fields.text("instruction"), *answers),
                user(instruction_text(fields)),
                finish,
            ),
        )
        .otherwise(outcome(None, error(codes.UNKNOWN_SCHEMA)))
    )


def to_preference_examples(
    df: DataFrame,
    renderer: Renderer = render_chatml,
    system_prompt: str | None = None,
    value: str | None = "value",
) -> DataFrame:
    """Add ``schema_kind``, ``error``, ``prompt``, ``chosen`` and ``rejected``.

    The prompt always ends with a generation prompt; the answers stay raw text.
    The three texts are NULL exactly where ``error.code`` is set.
    """
    keep = kept(df, *REPLACED, "prompt", "chosen", "rejected")
    in_python = getattr(renderer, "in_python", False)

    def finish(messages: Column) -> Column:
        messages = prepend_system_prompt(messages, system_prompt)
        return messages if in_python else renderer(messages, True)

    opened, fields = open_rows(df, PREFERENCE_KEYS, value)
    read = opened.select(
        *keep,
        preference_outcome(fields, finish).alias(RESERVED + "outcome"),
        (fields.present("chosen") & fields.present("rejected")).alias(RESERVED + "answered"),
        fields.text("chosen").alias(RESERVED + "chosen"),
        fields.text("rejected").alias(RESERVED + "rejected"),
    )
    found = F.col(RESERVED + "outcome")
    # A row that is no object, or was not read, has no answers either, but that is not its error.
    unanswered = ~F.col(RESERVED + "answered") & (
        F.coalesce(found["error"]["code"], F.lit("")).isin(
            codes.BAD_JSON, codes.NOT_A_MAPPING, codes.ROW_TOO_LARGE
        )
        == F.lit(False)
    )
    row_error = F.when(unanswered, error(codes.PREF_MISSING_FIELDS)).otherwise(
        found["error"]
    )
    good = row_error["code"].isNull()
    rows = evaluate_once(
        read,
        keep,
        {
            "schema_kind": found["schema_kind"],
            "error": row_error,
            "prompt": F.when(good, found["result"]),
            "chosen": F.when(good, F.col(RESERVED + "chosen")),
            "rejected": F.when(good, F.col(RESERVED + "rejected")),
        },
    )
    return rendered(rows, renderer, "prompt", True) if in_python else rows
