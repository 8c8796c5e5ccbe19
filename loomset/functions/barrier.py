"""Keep an expensive expression from being evaluated twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, keep: list[str], exprs: dict[str, Column]) -> DataFrame:
    """Select ``keep`` plus the named expressions, each computed once per row.

    Catalyst pushes a filter on a computed column below the projection by
    repeating the expression inside the filter, so a later ``where`` on a parsed
    field would parse the JSON again for every test.  A one-element ``inline``
    yields the same rows, and predicates on its output stay above it.
    """
    fields = F.struct(*[expr.alias(name) for name, expr in exprs.items()])
    return df.select(*keep, F.inline(F.array(fields)))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used.

    Inside one branch of a ``CASE`` Catalyst repeats a shared expression, so a
    costly one is handed over as the argument of a lambda.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
