"""Empty texts, bad rows and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_empty_text(df: DataFrame, text_field: str = "text") -> DataFrame:
    """Keep texts of at least one character; blanks count as characters."""
    return df.where(F.length(text_field) > 0)


def accepted(df: DataFrame) -> DataFrame:
    """The rows without an error."""
    return df.where(F.col("error.code").isNull())


def quarantined(df: DataFrame) -> DataFrame:
    """The rows with an error, as ``error_code`` and ``error_index``."""
    keep = [name for name in ("row_id", "value") if name in df.columns]
    return df.where(F.col("error.code").isNotNull()).select(
        *keep,
        F.col("error.code").alias("error_code"),
        F.col("error.index").alias("error_index"),
    )


def fail_on_error(df: DataFrame) -> DataFrame:
    """The same rows, but the job fails at the first row with an error.

    The check is a filter: the optimizer removes a failing column that nothing
    reads, but never a filter.
    """
    code, index = F.col("error.code"), F.col("error.index").cast("string")
    text = F.concat_ws(" at message ", code, index)
    return df.where(
        F.when(code.isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("unusable row: "), text)).cast("boolean")
        )
    )


def error_summary(df: DataFrame) -> DataFrame:
    """Row count per error code; good rows count under the empty code."""
    return df.groupBy(
        F.coalesce(F.col("error.code"), F.lit("")).alias("error_code")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def dataset_ready_count(df: DataFrame) -> DataFrame:
    """Row count per ``split``."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def profile_keys(df: DataFrame, value: str = "value", preview: str | None = None) -> DataFrame:
    """Row count and an example per sorted set of top-level JSON keys.

    ``value`` is JSON text or VARIANT.  ``keys`` is an array, and NULL counts what is
    no JSON object.  The example is the row with the smallest text; ``preview`` names a
    column, such as the rendered text, that is shown of it instead of the row.
    """
    text = F.col(value)
    if isinstance(df.schema[value].dataType, T.VariantType):
        text = F.to_json(text)
    keys = F.array_sort(F.json_object_keys(text))
    example = F.min(text) if preview is None else F.min_by(preview, text)
    return df.groupBy(keys.alias("keys")).agg(
        F.count(F.lit(1)).alias("n_rows"), example.alias("example")
    )
