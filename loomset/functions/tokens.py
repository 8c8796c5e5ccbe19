"""Tokenizers: how a text becomes tokens, and how many there are."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# A caller's function gets texts of about this many bytes at a time, or a single one.
SLICE_BYTES = 1 << 20


class Tokenizer(NamedTuple):
    """Text column to a column of token counts (INT) or of tokens (an array).

    NULL and empty texts have no tokens, whatever the tokenizer.
    """

    count: Callable[[Column], Column]
    tokens: Callable[[Column], Column]


def split_tokens(text: Column) -> Column:
    """The pieces between blanks; two blanks in a row have an empty piece between them."""
    return F.when(F.length(text) > 0, F.split(text, " ", -1)).otherwise(F.array().cast("array<string>"))


def _count_split(text: Column) -> Column:
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(F.length(text) > 0, blanks + 1).otherwise(0).cast("int")


#: One token for each piece between blanks; runs in the JVM.
BLANKS = Tokenizer(_count_split, split_tokens)


def token_slice(text: Column, start: Column | int, end: Column | int) -> Column:
    """The text of tokens ``start`` up to ``end`` of :data:`BLANKS`."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    size = F.greatest(end - start, F.lit(0))
    return F.array_join(F.slice(split_tokens(text), (start + 1).cast("int"), size.cast("int")), " ")


def python_tokenizer(encode: Callable[[list[str]], Sequence[Sequence[int]]]) -> Tokenizer:
    """A tokenizer from a Python function: a list of texts to a list of ids for each.

    ``encode`` is called with at least one text, none of them NULL or empty, in slices
    of bounded size, and has to return one sequence of whole numbers for each text, in
    order.  Anything else ends the job, since ids could not be told apart from those of
    another text.  Counts do not carry the ids out of the Python worker.  A text may be
    encoded more than once if its column is used twice: store the counts.
    """

    def encoded(texts: pa.Array) -> Iterator[Sequence[int]]:
        for part in _slices(texts):
            rows = part.to_pylist()
            asked = [x for x in rows if x]
            given = encode(asked) if asked else []
            if not hasattr(given, "__len__") or len(given) != len(asked):
                raise ValueError(f"the tokenizer has to return {len(asked)} rows of ids")
            found = iter(given)
            for x in rows:
                yield next(found) if x else []

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(x) for x in encoded(texts)], pa.int32())

    @F.arrow_udf("array<int>")
    def tokens(texts: pa.Array) -> pa.Array:
        return pa.array([list(x) for x in encoded(texts)], pa.list_(pa.int32()))

    return Tokenizer(count.asNondeterministic(), tokens.asNondeterministic())


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    ends = pc.cumulative_sum(pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())).to_pylist()
    at = done = 0
    for i, end in enumerate(ends):
        if end - done > SLICE_BYTES and i > at:
            yield texts.slice(at, i - at)
            at, done = i, ends[i - 1]
    if at < len(texts):
        yield texts.slice(at)
