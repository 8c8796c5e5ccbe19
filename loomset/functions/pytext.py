"""Python's ``str()`` and ``str.strip()`` as Spark expressions.

Row values arrive as JSON, but the text that is trained on is what Python makes
of them.  These helpers give that text without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# How a false, zero or empty non-string reads after variant_text().
FALSY_TEXTS = ("False", "0", "0.0", "-0.0", "[]", "{}")

BIGINT_DIGITS = 19
# The longest text of a number: a DECIMAL's sign, "0." and 38 digits.
LONGEST_NUMBER = 41


def py_strip(text: Column) -> Column:
    """``str.strip()``: Spark's own ``trim`` removes only U+0020."""
    return F.btrim(text, F.lit(PYTHON_WHITESPACE))


def variant_text(value: Column) -> Column:
    """Text of one JSON value; NULL when the value is absent or a JSON null.

    Strings, booleans and numbers read as in Python.  Nested values are compact
    JSON, and an integer of more than 38 digits is read as a float.
    """
    # The common case comes first: reading a long string is the costly part, and
    # this way it happens once.
    return F.when(_is_string(value), _text(value)).otherwise(_other_text(value))


def truthy_variant_text(value: Column) -> Column:
    """Like :func:`variant_text`, but NULL for a value that Python calls false."""
    other = _other_text(value)
    return F.when(_is_string(value), F.when(_text(value) != "", _text(value))).when(
        ~other.isin(*FALSY_TEXTS), other
    )


def _is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _other_text(value: Column) -> Column:
    kind, text = F.schema_of_variant(value), _text(value)
    return (
        F.when(kind == "BOOLEAN", F.initcap(text))
        # A float without fraction; integers too long for BIGINT are DECIMAL too.
        .when(
            kind.startswith("DECIMAL")
            & ~F.contains(text, F.lit("."))
            & (F.length(text) < BIGINT_DIGITS),
            F.concat(text, F.lit(".0")),
        )
        .when(F.contains(text, F.lit("E")) & (kind != "OBJECT") & ~kind.startswith("ARRAY"), float_text(text))
        .otherwise(text)
    )


def float_text(text: Column) -> Column:
    """Python's text of a number from Java's, which has an exponent sooner."""
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.regexp_replace(text, r"(?:\.0)?E.*$", "")
    # 17 digits at most before the point, and 21 after it
    plain = F.regexp_replace(text.cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.lpad(F.abs(exponent).cast("string"), 2, "0")
    size = F.when(F.abs(exponent) > 99, F.abs(exponent).cast("string")).otherwise(size)
    sign = F.when(exponent < 0, "e-").otherwise("e+")
    return (
        F.when(text == "NaN", "nan")
        .when(text.endswith("Infinity"), F.regexp_replace(text, "Infinity", "inf"))
        .when(~F.contains(text, F.lit("E")), text)
        .when((exponent >= -4) & (exponent < 16), plain)
        .otherwise(F.concat(digits, sign, size))
    )


def may_not_be_string(text: Column) -> Column:
    """Could this text, cast from JSON, stem from something else than a string?

    False for nearly all texts, after a look at their size and first character.
    """
    return F.when(
        F.octet_length(text) <= LONGEST_NUMBER,
        text.rlike(r"^(?:[\[{]|true$|false$|-?[0-9][0-9.E-]*$)"),
    ).otherwise(text.startswith("[") | text.startswith("{"))


def typed_text(value: Column, data_type: T.DataType) -> Column:
    """Text of a typed value, as the same value has it that is read from JSON."""
    text = value.cast("string")
    if isinstance(data_type, T.BooleanType):
        return F.initcap(text)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return float_text(text)
    if isinstance(data_type, T.VariantType):
        return variant_text(value)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return text


def truthy_typed_text(value: Column, data_type: T.DataType) -> Column:
    """Like :func:`typed_text`, but NULL for a value that Python calls false."""
    text = typed_text(value, data_type)
    if isinstance(data_type, T.StringType):
        return F.when(text != "", text)
    if isinstance(data_type, T.VariantType):
        return truthy_variant_text(value)
    if isinstance(data_type, T.DecimalType):
        return F.when(value != 0, text)
    return F.when(~text.isin(*FALSY_TEXTS), text)
