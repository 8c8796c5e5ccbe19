"""SFT rows to training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import Renderer, prepend_system_prompt, render_chatml, render_template
from loomset.operators import codes
from loomset.operators.messages import error, sft_rows
from loomset.operators.rows import RESERVED


def rendered(
    rows: DataFrame, renderer: Renderer, column: str, add_generation_prompt: bool
) -> DataFrame:
    """``rows`` with the messages in ``column`` rendered by a Python template.

    A row that the template refuses gets an error and no text at all.
    """
    done = RESERVED + "rendered"
    problem = F.col(f"{done}.problem")
    failed = F.when(problem.isNotNull(), error(codes.TEMPLATE_FAILED)).otherwise(F.col("error"))
    texts = {column: F.col(f"{done}.text"), "error": failed}
    for other in {"chosen", "rejected"} & set(rows.columns):
        texts[other] = F.when(problem.isNull(), F.col(other))
    messages = F.col("`" + column.replace("`", "``") + "`")
    read = rows.withColumn(done, render_template(renderer, messages, add_generation_prompt))
    return read.withColumns(texts).drop(done)


def format_examples(
    df: DataFrame,
    renderer: Renderer = render_chatml,
    system_prompt: str | None = None,
    add_generation_prompt: bool = False,
    text_field: str = "text",
    value: str | None = "value",
) -> DataFrame:
    """Add the training text to raw or typed SFT rows; NULL where ``error`` is set."""
    if text_field.lower() in ("error", "schema_kind"):
        raise ValueError(f"text_field={text_field!r} is a column of the result")
    in_python = getattr(renderer, "in_python", False)

    def finish(messages: Column) -> Column:
        messages = prepend_system_prompt(messages, system_prompt)
        return messages if in_python else renderer(messages, add_generation_prompt)

    rows = sft_rows(df, finish, text_field, value)
    return rendered(rows, renderer, text_field, add_generation_prompt) if in_python else rows
