"""Folds of documents by the CRC-32 of their id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_fold(parts: int, fold: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``parts``.

    A NULL id counts as empty text, whose remainder is 0.
    """
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == fold
