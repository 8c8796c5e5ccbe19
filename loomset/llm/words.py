"""Words of whole texts as numpy arrays, and bounded slices of Arrow batches.

A text is never decoded for this: the separators of both word rules are ASCII, and
no byte of a longer UTF-8 character is.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loomset.sources import shared_dir

SLICE_BYTES = 1 << 20

_SPACE = b" "[0]
#: Words of letters, digits and non-ASCII characters, A-Z lower-cased.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else _SPACE
    for b in range(256)
)
#: Words between white space, A-Z lower-cased.
SPACED_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words between white space, unchanged.
SPACED = bytes(range(256))


def normal(text: bytes | None, table: bytes) -> bytes:
    """The words of a text joined by one space; nothing for NULL."""
    return b" ".join(text.translate(table).split()) if text else b""


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about SLICE_BYTES of text; one text is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(
            zero_copy_only=False
        )
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes | None]:
    return batch.column(text).cast(pa.large_binary()).to_pylist()


def map_batches(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` for columns of any name, with dots too."""
    names = df.columns

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batch.rename_columns(names) for batch in batches)

    return df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(named, schema)


def map_slices(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """``make`` over slices of ``df``, which has a column ``text``."""
    return map_batches(df, lambda batches: map(make, slices(batches)), schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns so named, in any case, whatever else its names hold."""
    low = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in low))


def free(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    low = {c.lower() for c in df.columns}
    while name.lower() in low:
        name += "_"
    return name


def schema_with(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` and the columns of a DDL text; all may be NULL."""
    fields = [StructField(f.name, f.dataType) for f in df.schema.fields]
    return StructType(fields + StructType.fromDDL(more).fields)


def row_key() -> Column:
    """One number for each different (doc_id, text); equal rows have equal results."""
    return F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, or to ``path``, and read back.

    The shuffle files behind it are given back at once, since nothing reads them
    again: a lost executor does not bring back the work before this point.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with contextlib.ExitStack() as after:
        after.callback(conf.set, name, conf.get(name, "false"))
        conf.set(name, "true")
        path = path or shared_dir(df.sparkSession)
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_U = np.uint64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Blocks of a word that are hashed for all words at a time.
_BLOCKS = 8


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        pair = []
        for x in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, x, _U)
            row[0] = 1
            pair.append(np.multiply.accumulate(row))
        have = (pair[0], pair[1])
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each number over all its bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """Where the words of many normalised texts stand, and hashes of runs of them."""

    def __init__(self, rows: list[bytes]):
        self.data = np.frombuffer(b"\n".join(rows), np.uint8)
        self.count = np.array([x.count(b" ") + 1 if x else 0 for x in rows], np.int64)
        gap = (self.data == 32) | (self.data == 10)
        word = np.concatenate(([False], ~gap, [False]))
        edge = np.flatnonzero(word[1:] != word[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.cumsum(self.count) - self.count
        self.row = np.repeat(np.arange(len(rows)), self.count)
        self.place = np.arange(len(self.row)) - self.first[self.row]

    def hashes(self, seed: int = 1) -> np.ndarray:
        """One 64-bit hash for each word, of its bytes in blocks of eight.

        A block goes into a number that is mixed again after each, so that no order of
        letters makes words alike; what is left of a very long word is hashed at once.
        """
        size = self.end - self.start
        h = mix(size.astype(_U) * _U(_STEP) + _U(seed * _BASE % 2**64))
        padded = np.zeros(len(self.data) // 8 * 8 + 24, np.uint8)
        padded[: len(self.data)] = self.data
        wide = padded.view("<u8")
        now = np.arange(len(size))
        for block in range(_BLOCKS):
            at, left = self.start[now] + 8 * block, size[now] - 8 * block
            shift = ((at & 7) * 8).astype(_U)
            # the upper part is shifted in two steps, as a shift by 64 is none
            value = (wide[at >> 3] >> shift) | (wide[(at >> 3) + 1] << (_U(63) - shift) << _U(1))
            value &= _U(2**64 - 1) >> (_U(8) * (_U(8) - np.minimum(left, 8).astype(_U)))
            h[now] = mix((h[now] ^ value) + _U(_BASE))
            now = now[left > 8]
            if not len(now):
                return h
        for i in now.tolist():
            rest = self.data[self.start[i] + 8 * _BLOCKS : self.end[i]]
            h[i] ^= _U(xxhash.xxh64_intdigest(rest, int(h[i])))
        return h

    def runs(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of ``n`` words within one text start, and their hashes."""
        if len(hashes) < n:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        power, back = _powers(_STEP, len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, _U)
        np.cumsum(hashes * power[: len(hashes)], out=sums[1:])
        at = np.flatnonzero((self.place + n <= self.count[self.row])[: len(hashes) - n + 1])
        return at, mix((sums[at + n] - sums[at]) * back[at] + _U(n))


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a run of ``length`` from one of ``starts``."""
    steps = np.zeros(size + length + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps)[:size] > 0
