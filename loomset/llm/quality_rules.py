"""Quality rules whose thresholds follow each language and source.

Four shares of every text are measured: symbols for each word, repeated lines,
repeated words, and the length of words.  For each language and source, a quantile
sketch tells the median of a share and its tail quantiles, and a text fails if its share
lies further from the median than FENCE times the distance of the tail quantile.  The
first three shares measure faults, so that only high ones fail; words can be too short as
well.  Where most texts lack a fault, its quantiles are zero, and any share is too high:
then it still takes more than a single occurrence (see SHARES) for a text to fail.

A sketch counts logarithmic bins, so that a quantile is right to RELATIVE.  Sketches
merge by adding counts: tasks count their own rows first, and the sketches of a
language, and of everything, are sums of those of the sources.  The quantiles of a group
of n texts are drawn towards those of its language as if that had SHRINK more texts in
the group, and those of a language towards those of everything, so that a small group
has no thresholds of its own and none changes abruptly as it grows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.words import SPACED, Words, map_slices, normal, stored, texts

#: A quantile differs from the true one by up to this share.
RELATIVE = 0.01
FENCE = 3.0
#: Lower tail, median and upper tail.
PARTS = (0.1, 0.5, 0.9)
#: Texts that a larger group lends to the quantiles of a smaller one.
SHRINK = 20
#: Words of a window whose repetition counts.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Each share, what has to hold besides for a high one to fail, and whether a low one can:
#: one symbol, one repeated line or one window that comes twice is no pattern.  A text
#: without a word has no shares (NULL): Spark computes what two rules share for every row,
#: also for one that has failed already, and a division by zero would end the query.
SHARES = {
    "symbols": ("try_divide(n_symbols, n_words)", "n_symbols > 1", False),
    "lines": ("try_divide(n_dup_lines, n_lines)", "n_dup_lines > 1", False),
    "repeats": ("try_divide(n_repeat_words, n_words)", "n_repeat_words > 16", False),
    "length": ("try_divide(word_chars, n_words)", "true", True),
}
_GAMMA = (1 + RELATIVE) / (1 - RELATIVE)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _repeated(words: Words) -> np.ndarray:
    """For each text, its words in windows that stand in it twice or more."""
    at, h = words.runs(words.hashes(), WINDOW)
    row = words.row[at]
    order = np.lexsort((h, row))
    same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(words.row) + 1, np.int32)
    steps[at[twice]] += 1
    steps[at[twice] + WINDOW] -= 1
    inside = np.cumsum(steps)[:-1] > 0
    return np.bincount(words.row[inside], minlength=len(words.count))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and COUNTS of each row of ``docs``; NULL texts are empty."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [x or b"" for x in texts(batch)]
        words = Words([normal(x, SPACED) for x in rows])
        begins = (words.data & 0xC0) != 0x80
        begins &= (words.data != 32) & (words.data != 10)
        upto = np.concatenate(([0], np.cumsum(begins)))
        chars = upto[words.end] - upto[words.start]
        lines = [[y for y in x.split(b"\n") if y and not y.isspace()] for x in rows]
        counts = {
            "n_words": words.count,
            "word_chars": np.bincount(words.row, chars, len(rows)).astype(np.int64),
            "n_symbols": np.array([len(x) - len(x.translate(None, SYMBOLS)) for x in rows], np.int64),
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
            "n_repeat_words": _repeated(words).astype(np.int64),
            "n_lines": np.array([len(x) for x in lines], np.int64),
        }
        kept = {c: batch.column(c) for c in ("doc_id", "lang", "source")}
        return pa.record_batch(kept | {c: pa.array(v) for c, v in counts.items()})

    base = docs.select("doc_id", "lang", "source", "text")
    numbers = ", ".join(f"{c} bigint" for c in COUNTS)
    return map_slices(base, make, f"doc_id bigint, lang string, source string, {numbers}")


def _bin(x: Column) -> Column:
    """The sketch's bin of a share; the lowest is for zero."""
    return F.when(x > 0, F.floor(F.log(x) / math.log(_GAMMA)).cast("int")).otherwise(-(2**31))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, share, bin, n) over all texts with a word."""
    shares = F.array(
        *(
            F.struct(F.lit(name).alias("share"), _bin(F.expr(rule)).alias("bin"))
            for name, (rule, _, _) in SHARES.items()
        )
    )
    flat = measured.filter("n_words > 0").select("lang", "source", F.explode(shares).alias("s"))
    return flat.groupBy("lang", "source", "s.share", "s.bin").agg(F.count("*").alias("n"))


def merged(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of ``keys``, which leave out what is to be merged."""
    return counts.groupBy(*keys, "share", "bin").agg(F.sum("n").alias("n"))


def quantiles(counts: DataFrame, keys: list[str], parts: tuple[float, ...]) -> DataFrame:
    """``keys``, share, rows and a column q_0, q_1, ... for each of ``parts``."""
    group = Window.partitionBy(*keys, "share")
    upto = F.sum("n").over(group.orderBy("bin"))
    low = F.pow(F.lit(_GAMMA), F.col("bin"))
    middle = F.when(F.col("bin") == -(2**31), F.lit(0.0)).otherwise(low * (1 + _GAMMA) / 2)
    table = counts.select("*", upto.alias("upto"), F.sum("n").over(group).alias("rows"), middle.alias("x"))
    picked = (F.min(F.when(F.col("upto") >= F.col("rows") * p, F.col("x"))).alias(f"q_{i}") for i, p in enumerate(parts))
    return table.groupBy(*keys, "share").agg(F.max("rows").alias("rows"), *picked)


def _drawn(rows: DataFrame, towards: DataFrame, keys: list[str]) -> DataFrame:
    """Quantiles of ``rows``, drawn to those of ``towards``, which ``keys`` lead to."""
    names = [f"q_{i}" for i in range(len(PARTS))]
    wider = towards.select("share", *keys, *(F.col(q).alias(f"to_{q}") for q in names))
    wider = wider.withColumnsRenamed({c: f"to_{c}" for c in ("share", *keys)})
    same = F.col("share") == F.col("to_share")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"to_{k}"))
    drawn = [((F.col("rows") * F.col(q) + SHRINK * F.col(f"to_{q}")) / (F.col("rows") + SHRINK)).alias(q) for q in names]
    kept = [c for c in ("lang", "source") if c in rows.columns]
    return rows.join(wider, same).select(*kept, "share", *drawn)


def thresholds(counts: DataFrame) -> DataFrame:
    """One row for each lang and source, with low_<share> and high_<share>."""
    every = quantiles(merged(counts, []), [], PARTS)
    langs = _drawn(quantiles(merged(counts, ["lang"]), ["lang"], PARTS), every, [])
    table = _drawn(quantiles(counts, ["lang", "source"], PARTS), langs, ["lang"])
    fences = []
    for name in SHARES:
        here = F.col("share") == name
        low = F.col("q_1") - FENCE * (F.col("q_1") - F.col("q_0"))
        high = F.col("q_1") + FENCE * (F.col("q_2") - F.col("q_1"))
        fences += [F.max(F.when(here, low)).alias(f"low_{name}"), F.max(F.when(here, high)).alias(f"high_{name}")]
    return table.groupBy("lang", "source").agg(*fences)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed and kept for each row of ``docs``.

    ``docs`` needs doc_id, text, lang and source; NULL is a language or source of its
    own, and other columns are ignored.  base_failed marks texts of fewer than 20 words or
    with more than 30 % of them in repeated windows; kept is false for those, and for
    texts with a share outside the fences of their language and source.  Repeated rows
    count, and stay, as often as they come.
    """
    measured = stored(measure(docs))
    fences = stored(thresholds(stored(sketches(measured))))
    fences = fences.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    base_failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    inside = F.lit(True)
    for name, (rule, pattern, two_sided) in SHARES.items():
        inside = inside & ~F.expr(f"{rule} > high_{name} and {pattern}")
        if two_sided:
            inside = inside & F.expr(f"{rule} >= low_{name}")
    # a text without a word has failed already, and may be of a group without a sketch
    joined = measured.join(fences, same, "left").withColumn("base_failed", base_failed)
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"))
