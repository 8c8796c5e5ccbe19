"""Fill-in-the-middle rows by rank and select over UTF-8 words.

A text is cut into units, here its lines.  Where unit k ends is a select query: the
place of the k-th unit-ending byte.  The UTF-8 bytes of a slice of texts are viewed as
64-bit words; arithmetic on a word marks all its unit-ending bytes at once, and
``bitwise_count`` counts them.  A cumulative sum over the words answers rank, a binary
search in it finds the word of the k-th mark, and within the word a multiplication
gives the running counts of its eight bytes, from which the byte follows.  Code points
are counted alike, from marks on continuation bytes.  No text is decoded or split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.words import free, map_slices, schema_with, without

#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_U = np.uint64
_ONES = _U(0x0101010101010101)
_LOW = _U(0x7F7F7F7F7F7F7F7F)
_HIGH = _U(0x8080808080808080)
_HASHES = 4


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of each byte of ``words`` that equals ``byte``; no others."""
    x = words ^ (_ONES * _U(byte))
    # a carry never leaves its byte, so that each is judged on its own
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte of ``words`` that continues a UTF-8 character."""
    return words & ~(words << _U(1)) & _HIGH


class Marks:
    """Rank and select over marked bytes: one bit in each byte of 64-bit words."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.upto[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(_U)
        inside = np.append(self.marks, _U(0))[word] & ((_U(1) << (byte * _U(8))) - _U(1))
        return self.upto[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the mark before which there are ``k`` others; it has to exist."""
        word = np.searchsorted(self.upto, k, "right") - 1
        wanted = (k - self.upto[word] + 1).astype(_U)
        # byte i of ``running`` counts the marks in bytes 0 to i
        running = (self.marks[word] >> _U(7)) * _ONES
        reached = ((running | _HIGH) - wanted * _ONES) & _HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


def _words(data: bytes | pa.Buffer) -> np.ndarray:
    """Bytes as little-endian 64-bit words, the last one filled up with zeros."""
    raw = np.frombuffer(data, np.uint8)
    padded = np.zeros((len(raw) + 7) // 8 * 8, np.uint8)
    padded[: len(raw)] = raw
    return padded.view("<u8")


class Units:
    """Texts, one after the other in ``data``, as units that end with ``ending``."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, ending: int = 10):
        words = _words(data)
        self.starts, self.ends = starts, ends
        self.ending, self.more = Marks(equal_bytes(words, ending)), Marks(continuations(words))
        self.before = self.ending.rank(starts)
        self.whole = self.ending.rank(ends) - self.before
        last = np.frombuffer(data, np.uint8)[np.maximum(ends - 1, 0)] if len(data) else np.zeros(len(ends), np.uint8)
        #: Units of each text; what follows its last ending is one more.
        self.count = self.whole + ((ends > starts) & (last != ending))

    def end_of(self, k: np.ndarray) -> np.ndarray:
        """Where the first ``k`` units of each text end, in bytes of ``data``."""
        at = np.where(k > 0, self.ends, self.starts)
        inner = np.flatnonzero((k > 0) & (k <= self.whole))
        at[inner] = self.ending.select(self.before[inner] + k[inner] - 1) + 1
        return at

    def chars(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        return end - start - (self.more.rank(end) - self.more.rank(start))


def _arranged(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = PREFIX.encode() + prefix, SUFFIX.encode() + suffix, MIDDLE.encode() + middle
    return p + s + m if form == "psm" else s + p + m


def fill_in_middle(
    docs: DataFrame, seed: int = 7, percent: int = 100, percent_spm: int = 50, ending: str = "\n"
) -> DataFrame:
    """``docs`` with n_units, form, prefix_chars, middle_chars and output.

    Four hashes of ``seed`` and doc_id decide: two of them where the prefix and the
    middle end, counted in units, one whether the row is transformed (``percent``), and
    one whether the suffix comes first (``percent_spm``).  The form is ``psm``, ``spm``
    or ``plain``; empty texts, and texts that hold a sentinel, stay plain, with NULL for
    both lengths.  A unit ends with the ASCII character ``ending``; what follows the
    last one is a unit, too.

    NULL texts are empty.  A NULL doc_id is hashed as empty text.  Equal rows have equal
    results, and columns of the same names are replaced.  A text is held whole, with
    about four times its size in marks and counts, and its output has nine bytes more;
    both have to fit into one cell (2 GB).
    """
    byte = ord(ending)
    if byte > 127:
        raise ValueError("units end with an ASCII character")
    base = without(docs, "n_units", "form", "prefix_chars", "middle_chars", "output")
    names, key = base.columns, free(base, "fim_hashes")
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.unhex(F.substring(F.sha2(seeded.cast("binary"), 256), 1, 8 * _HASHES))
    banned = [x.encode() for x in (PREFIX, SUFFIX, MIDDLE)]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        rows = column.to_pylist()
        sizes = np.array([len(x) for x in rows], np.int64)
        ends = np.cumsum(sizes)
        data = b"".join(rows)
        units = Units(data, ends - sizes, ends, byte)
        h = np.frombuffer(b"".join(batch.column(key).to_pylist()), ">u4").astype(np.int64).reshape(-1, _HASHES)
        first, second = h[:, 0] % (units.count + 1), h[:, 1] % (units.count + 1)
        cut1 = units.end_of(np.minimum(first, second))
        cut2 = units.end_of(np.maximum(first, second))
        plain = (sizes == 0) | (h[:, 2] % 100 >= percent)
        if any(x in data for x in banned):
            plain |= np.array([any(x in row for x in banned) for row in rows], bool)
        forms = np.where(plain, "plain", np.where(h[:, 3] % 100 < percent_spm, "spm", "psm")).tolist()
        out = [
            row if form == "plain" else _arranged(form, row[: a - s], row[a - s : b - s], row[b - s :])
            for row, form, s, a, b in zip(rows, forms, units.starts.tolist(), cut1.tolist(), cut2.tolist())
        ]
        done = {
            "n_units": pa.array(units.count, pa.int64()),
            "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array(units.chars(units.starts, cut1), pa.int64(), mask=plain),
            "middle_chars": pa.array(units.chars(cut1, cut2), pa.int64(), mask=plain),
            "output": pa.array(out, pa.binary()).cast(pa.string()),
        }
        return pa.record_batch({c: batch.column(c) for c in names} | done)

    more = "n_units bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return map_slices(base.withColumn(key, digest), make, schema_with(base, more))


def _cut(text: Column, mark: str) -> tuple[Column, Column]:
    """What stands before and after the first ``mark``, which has to be there."""
    before = F.substring_index(text, mark, 1)
    return before, F.substr(text, F.length(before) + len(mark) + 1)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The exact text that became ``output`` by ``form``; NULL where either is.

    A sentinel begins with the only ``<`` in it and no part holds one, so that the
    first place of each in ``output`` is its own.
    """
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    first, rest = _cut(F.substr(output, F.lit(len(PREFIX) + 1)), SUFFIX)
    suffix, middle = _cut(rest, MIDDLE)
    psm = F.concat(first, middle, suffix)
    suffix, rest = _cut(F.substr(output, F.lit(len(SUFFIX) + 1)), PREFIX)
    first, middle = _cut(rest, MIDDLE)
    spm = F.concat(first, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
