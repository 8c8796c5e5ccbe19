"""Open raw rows: which known fields does a row carry, and what do they say?

Raw JSON lines and typed tables are opened into the same :class:`RowFields`, so
all of the logic behind it is shared.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import (
    JSON_PARSER,
    MAX_DEPTH,
    bind,
    may_not_be_string,
    parse_json,
    py_strip,
    truthy_typed_text,
    truthy_variant_text,
    typed_text,
    valid_role,
    variant_text,
    with_length,
)
from loomset.operators import codes

SFT_KEYS = ("instruction", "context", "response", "output", "prompt", "completion")
PREFERENCE_KEYS = ("prompt", "instruction", "context", "chosen", "rejected")

# The keys whose value counts only when Python calls it true.
_TRUTHY_KEYS = ("context",)

# Names of internal columns start like this; tables must not use it.
RESERVED = "__loomset_"

# Internal columns: the parsed line and its known fields as text.
_JSON, _FIELDS = RESERVED + "json", RESERVED + "fields"

# A VARIANT ends at 128 MiB.  Small numbers take up to eight times their text in it.
_SURELY_FITS = 16 << 20

_TURNS_TYPE = "array<struct<role:string,content:string>>"


class RowFields(NamedTuple):
    """Columns that describe one row.

    They are expressions rather than stored columns: Catalyst sees through them,
    and a field that no branch asks for is never computed.
    """

    # BAD_JSON, NOT_A_MAPPING or NULL.
    row_error: Column
    # Per scalar key: is it there, and its text; NULL when absent or null.
    scalars: dict[str, tuple[Column, Column]]
    has_messages: Column
    # array<struct<role, content, problem, index>>, NULL when not a list.  The
    # problem is the error code of a bad turn.
    turns: Column

    def present(self, key: str) -> Column:
        return self.scalars[key][0]

    def text(self, key: str) -> Column:
        return self.scalars[key][1]


class JsonRow:
    """The columns that :func:`read_json` adds, and what can be asked of them."""

    def __init__(self, root: str, line: str | None = None):
        self.root, self._line = root, line

    def text(self, key: str) -> Column:
        """The field cast to text; NULL for an absent key and for a JSON null."""
        return F.col(f"{_FIELDS}.{_quoted(key)}")

    def json(self, key: str, as_type: str = "variant") -> Column:
        """The field itself.  Reading it costs a copy, so ask for it lazily."""
        return F.try_variant_get(_JSON, f"{self.root}[{_path_key(key)}]", as_type)

    def error(self) -> Column:
        """Why the row is not one JSON object, or NULL."""
        return F.coalesce(
            self.refusal(), F.when(F.col(_FIELDS).isNull(), codes.NOT_A_MAPPING)
        )

    def refusal(self) -> Column:
        """Why the row is not one JSON value, or NULL."""
        if self._line is None:
            refused, broken = F.lit(codes.BAD_JSON), F.lit(False)
        else:
            refused = bind(F.col(self._line), _refusal)
            # Exactly two elements, the second of which is the line's own length.
            length = F.octet_length(self._line).cast("bigint")
            broken = F.coalesce(
                F.try_variant_get(_JSON, "$[1]", "bigint") != length, F.lit(True)
            ) | F.try_variant_get(_JSON, "$[2]", "variant").isNotNull()
        return F.when(F.col(_JSON).isNull(), refused).when(broken, codes.BAD_JSON)


def _refusal(line: Column) -> Column:
    """Why a line could not be parsed: it is too large for a VARIANT, or no JSON."""
    size = F.octet_length(line)
    parts = F.from_json(with_length(line), "array<string>", JSON_PARSER)
    valid = (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == size.cast("string"))
    brackets = F.length(line) - F.length(F.translate(line, "[{", ""))
    too_large = F.when(size > _SURELY_FITS, valid).otherwise(F.lit(False))
    return F.when(F.coalesce(too_large, F.lit(False)) | (brackets > MAX_DEPTH), codes.ROW_TOO_LARGE).otherwise(
        codes.BAD_JSON
    )


def read_json(
    df: DataFrame, field_types: dict[str, str], value: str
) -> tuple[DataFrame, JsonRow]:
    """Parse the JSON text or VARIANT ``value`` once and cast the known fields."""
    if isinstance(df.schema[value].dataType, T.StringType):
        row, parsed = JsonRow("$[0]", value), parse_json(F.col(value))
    else:
        row, parsed = JsonRow("$"), F.col(value)
    wanted = ",".join(f"{_quoted(key)}:{name}" for key, name in field_types.items())
    read = df.select("*", parsed.alias(_JSON)).select(
        "*", F.try_variant_get(_JSON, row.root, f"struct<{wanted}>").alias(_FIELDS)
    )
    return read, row


def open_json_rows(
    df: DataFrame, keys: tuple[str, ...], value: str = "value"
) -> tuple[DataFrame, RowFields]:
    """Open rows that hold one JSON text (or VARIANT) each.

    A key that is present with a JSON null is told apart from a key that is
    absent.  Nearly all values are plain strings, which the one cast in
    :func:`read_json` reads; only where its text could come from another JSON type
    is the field looked at again.
    """
    types = {"messages": _TURNS_TYPE, **dict.fromkeys(keys, "string")}
    read, row = read_json(df, types, value)

    # Everything without a lambda goes into generated stages of its own: what a
    # lambda is applied to is interpreted node by node.  Two stages, because one
    # method for all of it would be too long for the JIT compiler.
    opened = read.select(
        *df.columns,
        _JSON,
        row.error().alias(RESERVED + "error"),
        *[row.text(key).alias(f"{RESERVED}text_{key}") for key in ("messages", *keys)],
    ).select(
        "*",
        *[
            may_not_be_string(F.col(f"{RESERVED}text_{key}")).alias(f"{RESERVED}check_{key}")
            for key in keys
        ],
    )

    def present(key: str) -> Column:
        # Only a key without text needs to be looked up.  Not an "or": its second
        # half would count as always needed.
        return F.when(F.col(f"{RESERVED}text_{key}").isNotNull(), F.lit(True)).otherwise(
            row.json(key).isNotNull()
        )

    # One lambda for all keys: it runs for few rows, and a plan with a copy of it
    # per key takes noticeably longer to build.
    checks = {key: F.col(f"{RESERVED}check_{key}") for key in keys}
    exact_texts = F.transform(
        F.array(*[F.when(checks[key], row.json(key)) for key in keys]), variant_text
    )

    def text(index: int, key: str) -> Column:
        plain_text, exact = F.col(f"{RESERVED}text_{key}"), F.get(exact_texts, F.lit(index))
        if key in _TRUTHY_KEYS:
            plain_text = F.when(plain_text != "", plain_text)
            exact = bind(row.json(key), truthy_variant_text)
        return F.when(checks[key], exact).otherwise(plain_text)

    turns = F.col(RESERVED + "text_messages")
    plain = F.forall(
        turns,
        lambda t: valid_role(py_strip(t["role"]))
        & t["content"].isNotNull()
        & ~may_not_be_string(t["content"]),
    )
    plain_turns = F.transform(
        turns, lambda t, i: _turn(F.lit(True), t["role"], t["content"], F.lit(False), i)
    )
    # An element that is not an object reads as NULL.
    exact_turns = F.transform(
        row.json("messages", "array<struct<role:variant,content:variant>>"), _json_turn
    )
    return opened, RowFields(
        F.col(RESERVED + "error"),
        {key: (present(key), text(i, key)) for i, key in enumerate(keys)},
        present("messages"),
        F.when(plain, plain_turns).otherwise(exact_turns),
    )


def open_table_rows(
    df: DataFrame, keys: tuple[str, ...]
) -> tuple[DataFrame, RowFields]:
    """Open rows of a typed table; a key is present when it is not NULL.

    ``messages`` may be an array of structs or of string maps.
    """
    types = {field.name: field.dataType for field in df.schema.fields}

    def scalar(key: str) -> tuple[Column, Column]:
        if key not in types:
            return F.lit(False), F.lit(None).cast("string")
        read = truthy_typed_text if key in _TRUTHY_KEYS else typed_text
        return F.col(key).isNotNull(), read(F.col(key), types[key])

    has_messages = F.col("messages").isNotNull() if "messages" in types else F.lit(False)
    return df, RowFields(
        F.lit(None).cast("string"),
        {key: scalar(key) for key in keys},
        has_messages,
        _table_turns(types.get("messages")),
    )


def open_rows(
    df: DataFrame, keys: tuple[str, ...], value: str | None = "value"
) -> tuple[DataFrame, RowFields]:
    """Raw rows or a typed table; see :func:`raw_column`."""
    raw = raw_column(df, value, ("messages", *keys))
    return open_json_rows(df, keys, raw) if raw else open_table_rows(df, keys)


def raw_column(df: DataFrame, value: str | None, keys: tuple[str, ...]) -> str | None:
    """Which column holds raw rows; None for a typed table.

    ``value`` names it, and None says that there is none.  Left at its default, the
    column ``value`` is meant if there is one and the table has no column of a known
    key beside it, so that a typed table may have a column ``value`` too.
    """
    if value is None or value not in df.columns:
        return None
    if value == "value" and set(keys) & set(df.columns):
        return None
    return value


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parsed_rows(df: DataFrame, line: str, into: str, refused: str) -> DataFrame:
    """Add the VARIANT of each line, and the error code of a line that is not one value.

    Row operators take the VARIANT as it is, so that a line is parsed once whatever is
    read of it.
    """
    read = df.select("*", parse_json(F.col(line)).alias(_JSON))
    code = JsonRow("$[0]", line).refusal()
    row = F.try_variant_get(_JSON, "$[0]", "variant")
    read = read.select("*", code.alias(refused))
    return read.select(*df.columns, F.when(F.col(refused).isNull(), row).alias(into), refused)


def path_of(key: str) -> str:
    """The step of a VARIANT path that leads to ``key``."""
    return f"[{_path_key(key)}]"


def _path_key(key: str) -> str:
    return '"' + key + '"' if "'" in key else "'" + key + "'"


def _json_turn(turn: Column, index: Column) -> Column:
    role, content = turn["role"], turn["content"]
    return _turn(
        role.isNotNull() & content.isNotNull(),
        F.try_variant_get(role, "$", "string"),
        variant_text(content),
        F.is_variant_null(content),
        index,
    )


def _table_turns(data_type: T.DataType | None) -> Column:
    if not isinstance(data_type, T.ArrayType):
        return F.lit(None).cast(
            "array<struct<role:string,content:string,problem:string,index:int>>"
        )
    element = data_type.elementType
    if isinstance(element, T.MapType):
        role_type = content_type = element.valueType
    elif isinstance(element, T.StructType) and {"role", "content"} <= set(element.fieldNames()):
        role_type, content_type = element["role"].dataType, element["content"].dataType
    else:
        role_type = None

    def turn(item: Column, index: Column) -> Column:
        if role_type is None:
            nothing = F.lit(None).cast("string")
            return _turn(F.lit(False), nothing, nothing, F.lit(False), index)
        role = typed_text(item["role"], role_type)
        content = typed_text(item["content"], content_type)
        has_keys = role.isNotNull() & content.isNotNull()
        return _turn(has_keys, role, content, F.lit(False), index)

    return F.transform(F.col("messages"), turn)


def _turn(
    has_keys: Column, role: Column, content: Column, null_content: Column, index: Column
) -> Column:
    role = py_strip(role)
    problem = (
        F.when(~has_keys, codes.MESSAGE_KEYS)
        .when(~valid_role(role), codes.INVALID_ROLE)
        .when(null_content, codes.NULL_FIELD)
    )
    return F.struct(
        role.alias("role"),
        content.alias("content"),
        problem.alias("problem"),
        index.alias("index"),
    )
