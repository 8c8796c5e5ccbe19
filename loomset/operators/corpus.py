"""Raw-text corpus rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import evaluate_once, may_not_be_string
from loomset.operators import codes
from loomset.operators.messages import error, kept
from loomset.operators.rows import RESERVED, raw_column, read_json

_CODE, _TEXT = RESERVED + "code", RESERVED + "text"


def corpus_text(
    df: DataFrame,
    text_field: str = "text",
    value: str | None = "value",
    into: str | None = None,
) -> DataFrame:
    """Add ``error`` and the one text column of raw or typed corpus rows.

    The text is taken as it is; a value that is not a string is an error rather
    than being converted.  The new column is called ``into``, or like the field; a
    field called ``error`` needs another name there.
    """
    into = text_field if into is None else into
    if into.lower() == "error":
        raise ValueError("a text column can't be called 'error'; give another name in into")
    keep = kept(df, "error", into)
    raw = raw_column(df, value, () if text_field.lower() == "value" else (text_field,))
    if raw is None:
        return _typed_corpus_text(df, keep, text_field, into)
    read, row = read_json(df, {text_field: "string"}, raw)
    text = row.text(text_field)
    is_string = F.when(
        may_not_be_string(text), F.schema_of_variant(row.json(text_field)) == "STRING"
    ).otherwise(text.isNotNull())
    code = F.coalesce(row.error(), F.when(~is_string, codes.CORPUS_TEXT))
    read = read.select(*keep, code.alias(_CODE), text.alias(_TEXT))
    return evaluate_once(
        read,
        keep,
        {"error": error(F.col(_CODE)), into: F.when(F.col(_CODE).isNull(), F.col(_TEXT))},
    )


def _typed_corpus_text(df: DataFrame, keep: list[str], text_field: str, into: str) -> DataFrame:
    """A plain projection, so that filters still reach the table's scan."""
    if text_field in df.columns and isinstance(
        df.schema[text_field].dataType, T.StringType
    ):
        text = F.col("`" + text_field.replace("`", "``") + "`")
    else:
        text = F.lit(None).cast("string")
    code = F.when(text.isNull(), codes.CORPUS_TEXT)
    return df.select(*keep, error(code).alias("error"), text.alias(into))
