"""JSON text to VARIANT, one value per text and nothing besides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How deep a row may be nested.  The parser is recursive: much deeper rows overflow
#: the stack of the executor's threads, which ends the executor.
MAX_DEPTH = 2000
#: Without the first two a string ends at 20 million characters and a row at 1,000
#: levels; without the others the parser takes what is no JSON.
JSON_PARSER = {
    "maxStringLen": "2147483647",
    "maxNestingDepth": str(MAX_DEPTH),
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def with_length(line: Column) -> Column:
    """``[<line>,<bytes of the line>]``.

    The parser stops after the first JSON value.  Whatever else a line holds, it can't
    bring about an array of two whose second element is the length of the line.
    """
    return F.concat(F.lit("["), line, F.lit(","), F.octet_length(line).cast("string"), F.lit("]"))


def parse_json(line: Column) -> Column:
    """VARIANT of :func:`with_length`; NULL where the parser refuses."""
    return F.from_json(with_length(line), "variant", JSON_PARSER)


def one_value(line: Column) -> Column:
    """VARIANT of a text that is one JSON value, else NULL."""
    length = F.octet_length(line).cast("bigint")
    return F.get(
        F.transform(
            F.array(parse_json(line)),
            lambda v: F.when(
                (F.try_variant_get(v, "$[1]", "bigint") == length)
                & F.try_variant_get(v, "$[2]", "variant").isNull(),
                F.try_variant_get(v, "$[0]", "variant"),
            ),
        ),
        F.lit(0),
    )
