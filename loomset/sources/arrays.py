"""JSON documents as the texts of their elements, a file read by many tasks.

A file is read in splits, as records that end with a closing brace.  Whether a bracket or
comma of a split counts depends on what came before it: whether a string is open, and
how deep the nesting is.  So a first pass tells, for each split and for both cases of
the string, how the split changes these; putting the splits' changes together in order,
a prefix scan over one short row for each split, gives the state at which every split
starts.  The second pass then cuts the elements, each split on its own, and the pieces
of elements that lie in several splits are put together at last.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.functions import one_value
from loomset.sources.sinks import stage

SLICE_BYTES = 1 << 20
#: Files beyond the size of a VARIANT hold no single value that could be read.
LARGEST_VALUE = 128 << 20

_QUOTE, _BACKSLASH, _COMMA, _END = b'"\\,}'
_OPEN, _CLOSE = b"[{", b"]}"
_BLANK = b" \t\r\n"
#: Far above any depth.
_NONE = 1 << 40


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, value): the records of each split, in order; the brace is left out."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _split_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, start, bytes) of records that follow each other, each with its brace."""
    for batch in batches:
        held, size, now = [], 0, None
        columns = (batch.column(i).to_pylist() for i in range(2))
        for file, start, value in zip(*columns, batch.column(2).cast(pa.binary()).to_pylist()):
            if held and (now != (file, start) or size >= SLICE_BYTES):
                yield *now, b"}".join(held) + b"}"
                held, size = [], 0
            now = file, start
            held.append(value)
            size += len(value) + 1
        if held:
            yield *now, b"}".join(held) + b"}"


class _Marks(NamedTuple):
    """Bytes of a slice, and what is inside a string if it starts outside of one."""

    data: np.ndarray
    inside: np.ndarray
    flips: bool

    @classmethod
    def of(cls, text: bytes) -> _Marks:
        data = np.frombuffer(text, np.uint8)
        quote = data == _QUOTE
        if _BACKSLASH in text:
            # a quote is escaped by an odd number of backslashes before it
            slash = data == _BACKSLASH
            place = np.arange(len(data))
            other = np.maximum.accumulate(np.where(slash, -1, place))
            run = place - other
            at = np.flatnonzero(quote)
            at = at[at > 0]
            quote[at[run[at - 1] % 2 == 1]] = False
        inside = np.logical_xor.accumulate(quote) if len(data) else quote
        return cls(data, inside, bool(inside[-1]) if len(data) else False)

    def steps(self, in_string: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of brackets that count, and by how much each changes the depth."""
        opens = (self.data == _OPEN[0]) | (self.data == _OPEN[1])
        closes = (self.data == _CLOSE[0]) | (self.data == _CLOSE[1])
        at = np.flatnonzero((opens | closes) & (self.inside == in_string))
        return at, np.where(opens[at], 1, -1)

    def commas(self, in_string: bool) -> np.ndarray:
        return np.flatnonzero((self.data == _COMMA) & (self.inside == in_string))


class _Case:
    """What a split does if it starts inside, or outside, a string."""

    def __init__(self, in_string: bool):
        self.in_string = in_string
        self.depth = 0
        #: Depths after the last two brackets, and the least one before these.
        self.last, self.least = [_NONE, _NONE], _NONE
        #: The least depth of a comma without a value before or behind it.
        self.bare = _NONE
        self.tail = b""

    def take(self, text: bytes, marks: _Marks) -> None:
        at, steps = marks.steps(self.in_string)
        depths = self.depth + np.cumsum(steps)
        commas = marks.commas(self.in_string)
        if len(commas):
            level = np.concatenate([[self.depth], depths])[np.searchsorted(at, commas)]
            for i in np.flatnonzero(level <= self.bare).tolist():
                if _bare(text, int(commas[i])):
                    self.bare = min(self.bare, int(level[i]))
        if len(at):
            recent = self.last + depths.tolist()
            self.least = min([self.least, *recent[:-2]])
            self.last = recent[-2:]
            self.depth = int(depths[-1])
            before = int(at[-2]) + 1 if len(at) > 1 else 0
            self.tail = text[before : int(at[-1])]
        self.in_string ^= marks.flips

    def told(self) -> dict:
        return {
            "delta": self.depth, "a": self.last[0], "z": self.last[1], "least": self.least,
            "bare": self.bare, "ends_in": self.in_string, "tail": not self.tail.strip(_BLANK),
        }


def _bare(text: bytes, at: int) -> bool:
    """Whether a comma lacks a value on one side; a record never ends between the two."""
    behind = at + 1
    while behind < len(text) and text[behind] in _BLANK:
        behind += 1
    if behind < len(text) and text[behind] in b",]":
        return True
    before = at - 1
    while before >= 0 and text[before] in _BLANK:
        before -= 1
    return before >= 0 and text[before] == _OPEN[0]


_SUMMARY = "file string, start bigint, array boolean, told string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, cases, array = None, [], False

    def told() -> pa.RecordBatch:
        row = {"file": now[0], "start": now[1], "array": array, "told": json.dumps([c.told() for c in cases])}
        return pa.RecordBatch.from_pylist([row])

    for file, start, text in _split_slices(batches):
        if now != (file, start):
            if now:
                yield told()
            now, cases = (file, start), [_Case(False), _Case(True)]
            array = start == 0 and text.removeprefix(b"\xef\xbb\xbf").lstrip(_BLANK).startswith(b"[")
        marks = _Marks.of(text)
        for case in cases:
            case.take(text, marks)
    if now:
        yield told()


def _starts(summaries: list) -> tuple[dict, set[str], set[str]]:
    """The state (in_string, depth) of each split of a whole array; other files by kind."""
    files: dict[str, list] = {}
    for row in summaries:
        files.setdefault(row["file"], []).append(row)
    states, broken, others = {}, set(), set()
    for file, rows in files.items():
        rows.sort(key=lambda r: r["start"])
        if not rows[0]["array"]:
            others.add(file)
            continue
        inside, depth, good, found = False, 0, True, {}
        for i, row in enumerate(rows):
            found[file, row["start"]] = inside, depth
            case = json.loads(row["told"])[inside]
            levels = [case["least"], case["a"], case["z"]]
            if i + 1 < len(rows):
                good &= depth + min(levels) >= 1
            else:
                # the last two brackets are the array's end and a brace that is not there
                good &= depth + case["least"] >= 1 and depth + case["a"] == 0 and depth + case["z"] == -1
                good &= case["tail"]
            good &= depth + case["bare"] != 1
            inside, depth = case["ends_in"], depth + case["delta"]
        if good and not inside:
            states |= found
        else:
            broken.add(file)
    return states, broken, others


_PIECES = "file string, start bigint, kind int, value string"
#: Kinds of pieces: a whole element, the end of one, a part without ends, the beginning.
_WHOLE, _HEAD, _PART, _TAIL = range(4)


def _cutter(states: dict):
    """Cuts the records of splits that start in ``states`` into pieces of elements."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.record_batch(
            {
                "file": pa.array(columns[0], pa.string()),
                "start": pa.array(columns[1], pa.int64()),
                "kind": pa.array(columns[2], pa.int32()),
                "value": pa.array(columns[3], pa.binary()).cast(pa.string()),
            }
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, inside, depth, first = None, [], False, 0, True

        def rest() -> list[tuple]:
            # what follows the last boundary of a split goes on in the next one
            return [(*now, _PART if first else _TAIL, b"".join(held))] if now and depth > 0 else []

        for file, start, text in _split_slices(batches):
            if (file, start) not in states:
                continue
            if now != (file, start):
                if out := rest():
                    yield batch(out)
                now, held, first = (file, start), [], True
                inside, depth = states[now]
            marks = _Marks.of(text)
            at, steps = marks.steps(inside)
            depths = depth + np.cumsum(steps)
            commas = marks.commas(inside)
            level = np.concatenate([[depth], depths])[np.searchsorted(at, commas)]
            begins = at[(depths == 1) & (steps == 1)]
            ends = at[(depths == 0) & (steps == -1)]
            out, done = [], 0
            for p in np.sort(np.concatenate([begins, commas[level == 1], ends])).tolist():
                piece = b"".join([*held, text[done:p]])
                opening = text[p] == _OPEN[0]
                if not opening:
                    out.append((file, start, _HEAD if first and states[now][1] else _WHOLE, piece))
                held, done, first = [], p + 1, False
            held.append(text[done:])
            if len(depths):
                depth = int(depths[-1])
            inside ^= marks.flips
            if out:
                yield batch(out)
        if out := rest():
            yield batch(out)

    return cut


def _elements(spark: SparkSession, path: str | list[str], states: dict) -> DataFrame:
    """(file, value): the text of each element of the arrays in ``states``."""
    cut = _cutter(states)
    pieces = _records(spark, path).mapInArrow(cut, _PIECES)
    if all(start == 0 for _, start in states):
        return pieces.select("file", "value")
    # at most two pieces of each split are no whole elements
    whole = pieces.where(F.col("kind") == _WHOLE).select("file", "value")
    parts = stage(pieces.where(F.col("kind") != _WHOLE))
    order = Window.partitionBy("file").orderBy("start", "kind")
    # an element begins with a tail, whose split comes before those of its other pieces
    begun = F.sum(F.when(F.col("kind") == _TAIL, 1).otherwise(0)).over(order)
    numbered = parts.select("file", "start", "kind").withColumn("element", begun)
    texts = parts.join(numbered, ["file", "start", "kind"]).groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "value"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda x: x["value"]), "")
    return whole.union(texts.select("file", joined.alias("value")))


def json_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): the text of each element of an array, of one value, or of a line.

    An array that is whole gives its elements, whatever they are.  Any other file is one
    JSON value, or else its lines.  Blank texts hold no row.
    """
    # one short row for each split, as the driver holds anyway to read the files
    summaries = _records(spark, path).mapInArrow(_summaries, _SUMMARY).collect()
    states, broken, others = _starts(summaries)
    parts = []
    if states:
        parts.append(_elements(spark, path, states))
    file = F.col("_metadata.file_path")
    if others:
        small = F.col("_metadata.file_size") <= LARGEST_VALUE
        texts = spark.read.text(path, wholetext=True).where(file.isin(*others) & small)
        trimmed = F.btrim("value", F.lit(" \t\r\n﻿"))
        read = texts.select(file.alias("file"), trimmed.alias("value"))
        # a file of lines has more than one value, and is divided right here
        lines = F.when(one_value(F.col("value")).isNotNull(), F.array("value")).otherwise(F.split("value", "\n"))
        parts.append(read.select("file", F.explode(lines).alias("value")))
        large = spark.read.text(path).where(file.isin(*others) & ~small)
        parts.append(large.select(file.alias("file"), "value"))
    if broken:
        lines = spark.read.text(path).where(file.isin(*broken))
        parts.append(lines.select(file.alias("file"), "value"))
    if not parts:
        return spark.createDataFrame([], "file string, value string")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    trimmed: Column = F.btrim("value", F.lit(_BLANK.decode() + "﻿"))
    return found.select("file", trimmed.alias("value")).where("value <> ''")
