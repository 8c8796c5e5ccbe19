"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file is compiled into one machine over the tropical semiring:

* the normaliser rewrites the text (spaces to U+2581, one more in front);
* the pieces are arcs over a trie of their characters, and an arc's weight is its
  piece's score, negated;
* a character that no piece spells is an arc that writes its UTF-8 bytes.

Composed with a text, the machine is a lattice, and the encoding its shortest path.
A model of the unigram kind needs no more.  In one of the BPE kind the pieces have no
weight, but two that merging would not leave side by side weigh infinitely much: a
sequence is what the merges produce if, and only if, each pair of neighbours is what
they make of the two pieces together.  One path then has a finite weight, and the
search takes the longest arc first, for it is mostly the right one.

No piece reaches over the front of a space, so that the lattice falls into words.
Words come again and again, and each task keeps the paths of the last ones.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomset.llm.words import map_batches, schema_with, slices, without

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
#: Words whose paths a task keeps (about 250 bytes each); beyond that the older half goes.
REMEMBERED = 600_000
#: How far below the worst piece an unknown character scores in a unigram model.
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol buffer."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        size = {0: 0, 1: 8, 2: 0, 5: 4}[tag & 7]
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        if tag & 7 == 2:
            size = number()
        yield tag >> 3, data[at : at + size]
        at += size


class Machine:
    """A compiled model: ``encode`` and ``decode``."""

    def __init__(
        self,
        pieces: list[tuple[str, float, int]],
        kind: int,
        prefix: bool = True,
        squeeze: bool = False,
    ):
        self.pieces, self.kind, self.prefix, self.squeeze = pieces, kind, prefix, squeeze
        if any(t == USER for _, _, t in pieces):
            raise ValueError("user-defined pieces are not supported")
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == UNKNOWN), 0)
        bytes_of = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.byte_ids = bytes_of if len(bytes_of) == 256 else None
        self.scores = {p: s for p, s, t in pieces if t == NORMAL}
        self.longest = max(map(len, self.ids), default=0)
        self.letters = {c for p in self.ids for c in p}
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self._pairs: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self.spaced, self.bare = _Paths(self, SPACE), _Paths(self, "")

    @classmethod
    def read(cls, model: bytes) -> Machine:
        """Compile the content of a model file."""
        pieces, kind, prefix, squeeze = [], UNIGRAM, True, True
        for number, value in _fields(model):
            if number == 1:
                p = dict(_fields(value))
                score = struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0]
                pieces.append((p[1].decode(), score, p.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                kind = trainer.get(3, UNIGRAM)
                if trainer.get(24):
                    raise ValueError("spaces after words are not supported")
            elif number == 3:
                rules = dict(_fields(value))
                if rules.get(2):
                    raise ValueError("a normaliser with a character map is not supported")
                prefix, squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
                if not rules.get(5, 1):
                    raise ValueError("unescaped spaces are not supported")
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"model kind {kind} is not supported")
        return cls(pieces, kind, prefix, squeeze)

    def forget(self) -> None:
        """Give back the memory of the words seen so far; pairs of pieces are few."""
        self.spaced.clear()
        self.bare.clear()
        if len(self._pairs) > REMEMBERED:
            self._pairs.clear()

    def _squeezed(self, text: str) -> str:
        return " ".join(filter(None, text.split(" "))) if self.squeeze else text

    def normal(self, text: str) -> str:
        text = self._squeezed(text)
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode(self, text: str | None) -> bytes:
        """Ids of the pieces, as 32-bit numbers one after the other."""
        if not text:
            return b""
        if not self.by_word or not self.prefix or SPACE in text:
            return self._chunks(self.normal(text))
        out, text = [], self._squeezed(text)
        # a character that no piece spells parts its neighbours
        lines = text.split("\n") if "\n" not in self.letters else [text]
        for i, line in enumerate(lines):
            if i:
                out.append(self.bare["\n"])
            words = line.split(" ")
            if "" in words[1:] or (not i and not words[0]):
                line = line.replace(" ", SPACE)
                out.append(self._chunks(SPACE + line if not i else line))
                continue
            if i:
                if words[0]:
                    out.append(self.bare[words[0]])
                del words[0]
            out += map(self.spaced.__getitem__, words)
        return b"".join(out)

    _CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def _chunks(self, whole: str) -> bytes:
        if not self.by_word:
            return self._packed(whole)
        return b"".join(map(self.bare.__getitem__, self._CHUNK.findall(whole)))

    def _packed(self, chunk: str) -> bytes:
        known = self.letters
        if known.issuperset(chunk):
            return array("i", self.path(chunk)).tobytes()
        out, at = [], 0
        for i, c in enumerate(chunk):
            if c not in known:
                if at < i:
                    out += self.path(chunk[at:i])
                out += self._fallback(c)
                at = i + 1
        if at < len(chunk):
            out += self.path(chunk[at:])
        return array("i", out).tobytes()

    def _fallback(self, c: str) -> list[int]:
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in c.encode()]

    def path(self, chunk: str) -> list[int]:
        """Ids along the shortest path through ``chunk``, whose characters are known."""
        return self._merged_path(chunk) if self.kind == BPE else self._light_path(chunk)

    def _arcs(self, s: str, at: int) -> list[tuple[int, int]]:
        """Ends and ids of the pieces that start at ``at``, longest first."""
        node, out = self.trie, []
        for c in s[at : at + self.longest]:
            node = node.get(c)
            if node is None:
                break
            at += 1
            if "" in node:
                out.append((at, node[""]))
        out.reverse()
        return out

    def _merged_path(self, s: str) -> list[int]:
        """The path of finite weight: the longest arc first, back where none goes on."""
        n, pairs = len(s), self._pairs
        arcs: dict[int, list[tuple[int, int]]] = {}
        path: list[tuple[int, int]] = []
        ways, dead = [], set()
        at, last = 0, -1
        while True:
            found = arcs.get(at)
            if found is None:
                found = arcs[at] = self._arcs(s, at)
            way = iter(found)
            while True:
                for arc in way:
                    end, i = arc
                    if last < 0:
                        fits = end < n or self._stands(i)
                    else:
                        both = last << 20 | i
                        fits = pairs.get(both)
                        if fits is None:
                            fits = pairs[both] = self._fits(last, i)
                    if fits and arc not in dead:
                        break
                else:
                    if not path:
                        # pieces that can't be reached by merging: what the merges leave
                        return [i for p in self.merges(s) for i in self._ids_of(p)]
                    dead.add(path.pop())
                    way = ways.pop()
                    last = path[-1][1] if path else -1
                    continue
                break
            path.append(arc)
            if end == n:
                return [i for _, i in path]
            ways.append(way)
            at, last = end, i

    def _ids_of(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else self._fallback(piece)

    def _stands(self, i: int) -> bool:
        """Whether merging makes a piece of its own text."""
        found = self._whole.get(i)
        if found is None:
            found = self._whole[i] = len(self.merges(self.pieces[i][0])) == 1
        return found

    def _fits(self, a: int, b: int) -> bool:
        """Whether merging leaves two pieces side by side."""
        left, right = self.pieces[a][0], self.pieces[b][0]
        return self.merges(left + right) == [left, right]

    def merges(self, s: str) -> list[str]:
        """What merging makes of a short text: the best pair first, then the leftmost."""
        parts, scores = list(s), self.scores
        worth = [scores.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, w in enumerate(worth):
                if w is not None and (best is None or w > best):
                    best, at = w, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del worth[at]
            if at:
                worth[at - 1] = scores.get(parts[at - 1] + parts[at])
            if at < len(worth):
                worth[at] = scores.get(parts[at] + parts[at + 1])

    @cached_property
    def _penalty(self) -> float:
        return UNKNOWN_PENALTY - min(self.scores.values(), default=0.0)

    def _light_path(self, s: str) -> list[int]:
        n = len(s)
        cost = [0.0] + [float("inf")] * n
        back: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
        for at in range(n):
            arcs = [(end, [i], -self.pieces[i][1]) for end, i in reversed(self._arcs(s, at))]
            if not arcs or arcs[0][0] > at + 1:
                arcs.append((at + 1, self._fallback(s[at]), self._penalty))
            for end, ids, weight in arcs:
                if cost[at] + weight < cost[end]:
                    cost[end], back[end] = cost[at] + weight, (at, ids)
        out: list[list[int]] = []
        at = n
        while at:
            at, ids = back[at]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    @cached_property
    def _written(self) -> list[bytes]:
        """What each id is in a decoded text, with spaces."""
        table = []
        for piece, _, kind in self.pieces:
            if kind == BYTE:
                table.append(bytes([int(piece[3:5], 16)]))
            elif kind == UNKNOWN:
                table.append(" ⁇ ".encode())
            else:
                table.append(b"" if kind == CONTROL else piece.replace(SPACE, " ").encode())
        return table

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        numbers = np.frombuffer(ids, "<i4").tolist()
        data = b"".join(map(self._written.__getitem__, numbers))
        if self.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode(errors="replace")

    def plain(self, text: str) -> str:
        """What decoding brings back: the text after the normaliser."""
        return self._squeezed(text).replace(SPACE, " ")


class _Paths(dict):
    """Packed ids of words, found when first asked for.

    The words of late are held here, those before them in ``older``: when there are too
    many, the ones go that were not asked for since the last time.
    """

    def __init__(self, machine: Machine, front: str):
        super().__init__()
        self.machine, self.front = machine, front
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.machine._packed(self.front + word)
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            super().clear()
        if len(word) <= 64:
            self[word] = found
        return found

    def clear(self) -> None:
        super().clear()
        self.older.clear()


@lru_cache(maxsize=2)
def _compiled(model: bytes) -> Machine:
    """One machine for each model in a worker."""
    return Machine.read(model)


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with n_pieces, ids and round_trip; columns so named are replaced.

    ``model`` is the content of a model file.  round_trip tells whether the ids decode
    to the text as the normaliser leaves it.  NULL texts have NULL ids, no pieces and
    a NULL round_trip; empty texts have no ids.
    """
    base = without(docs, "n_pieces", "ids", "round_trip")
    names = base.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(machine: Machine, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.column("text").to_pylist()
        packed = [machine.encode(x) for x in rows]
        back = [None if x is None else machine.decode(p) == machine.plain(x) for x, p in zip(rows, packed)]
        sizes = np.array([len(p) // 4 for p in packed], np.int64)
        ids = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)),
            pa.array(np.frombuffer(b"".join(packed), "<i4")),
            mask=pa.array([x is None for x in rows], pa.bool_()),
        )
        columns = {c: batch.column(c) for c in names}
        columns |= {"n_pieces": pa.array(sizes), "ids": ids, "round_trip": pa.array(back, pa.bool_())}
        return pa.record_batch(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(shared.value)
        try:
            for batch in slices(batches):
                yield make(machine, batch)
        finally:  # the worker goes on to other tasks
            machine.forget()

    new = "n_pieces bigint, ids array<int>, round_trip boolean"
    return map_batches(base, run, schema_with(base, new))


def decode(coded: DataFrame, model: bytes) -> DataFrame:
    """``coded`` (with a column ids) and ``decoded``; NULL ids give NULL.

    An id outside the model fails the job: it belongs to another one.
    """
    base = without(coded, "decoded")
    names = base.columns
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(shared.value)
        for batch in batches:
            packed = (None if x is None else array("i", x).tobytes() for x in batch.column("ids").to_pylist())
            out = [None if p is None else machine.decode(p) for p in packed]
            columns = {c: batch.column(c) for c in names}
            yield pa.record_batch(columns | {"decoded": pa.array(out, pa.string())})

    return map_batches(base, run, schema_with(base, "decoded string"))
