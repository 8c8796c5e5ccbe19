"""Languages of a text as a mixture, found by expectation-maximisation.

A model counts hashed runs of three bytes, word edges included, for each language.
A text is taken as a mixture: each of its words comes from one of the languages, with
the likelihood of its n-grams, and EM finds in which proportions.  The languages are
then taken in the order of their proportions, and the set whose likelihood, fitted
anew and lowered by half the logarithm of the word count for each further language,
is highest is the text's.  The first of it is the prediction.

A text counts each of its distinct words once, with its number.  Sets are fitted from
the smallest on, and only while a bound on the likelihood of all larger ones leaves them
a chance, so that the choice is that of trying them all.  A text is never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.folds import in_fold
from loomset.llm.words import Words, map_slices, normal, schema_with, slices, without

#: N-grams fall into this many bins; a model has this many numbers for each language.
BINS = 1 << 16
STEPS = 12
#: Numbers (words by languages) that are fitted at a time, and counts that a task holds.
CELLS = 1 << 22
HELD_COUNTS = 1 << 21
UNKNOWN = "und"

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def _words(rows: list[str | None]) -> Words:
    return Words([normal(x.lower().encode(), _LETTERS) if x else b"" for x in rows])


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bin of the n-gram around each byte of a word, and where each word starts."""
    a = words.data.astype(np.uint32)
    a[a == 10] = 32
    wide = np.concatenate(([32], a, [32])).astype(np.uint32)
    joined = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    bins = (joined * np.uint32(2654435761)) >> np.uint32(16)
    inside = wide[1:-1] != 32
    lengths = words.end - words.start
    return bins[inside], np.cumsum(lengths) - lengths


def _alike(words: Words, has: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the slice: one place of each; and for each text in turn, its
    distinct words (``which`` of the former), how often each comes, and where it starts."""
    names, one, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    whose = np.repeat(np.arange(len(has)), words.count[has])
    pairs, times = np.unique(whose * len(names) + which, return_counts=True)
    first = np.searchsorted(pairs, np.arange(len(has)) * len(names))
    return one, pairs % len(names), times, first


@dataclass(frozen=True)
class LanguageModel:
    """Counts of n-grams for each language, as far as they occur.

    The entries of bin b are ``start[b]`` to ``start[b + 1]``: a language, and by how much
    the logarithm of its likelihood lies above ``rare``, that of a bin it never had.
    """

    languages: tuple[str, ...]
    rare: np.ndarray
    start: np.ndarray
    language: np.ndarray
    above: np.ndarray

    def _logs(self, words: Words, one: np.ndarray) -> np.ndarray:
        """Logarithm of the likelihood of the words ``one``, by language."""
        k = len(self.languages)
        bins, at = _grams(words)
        size = (words.end - words.start)[one]
        # the n-grams of all these words in a row, then the model's entries of each
        gram = bins[_ranges(at[one], size)]
        entries = self.start[gram + 1] - self.start[gram]
        word = np.repeat(np.repeat(np.arange(len(one)), size), entries)
        entry = _ranges(self.start[gram], entries)
        sums = np.bincount(word * k + self.language[entry], self.above[entry], len(one) * k)
        return sums.reshape(len(one), k) + size[:, None] * self.rare

    def predict(self, rows: list[str | None]) -> tuple[list[str], np.ndarray, list[dict[str, float]]]:
        """For each text its language, that language's proportion, and all proportions."""
        names, scores, shares = [UNKNOWN] * len(rows), np.zeros(len(rows)), [{} for _ in rows]
        if not self.languages:
            return names, scores, shares
        whole = _words(rows)
        # texts together while their words, by language, fit; a text is never divided
        room = np.cumsum(whole.count) * len(self.languages) // CELLS
        for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(room)) + 1):
            words = whole if len(part) == len(rows) else _words([rows[i] for i in part])
            has = np.flatnonzero(words.count)
            if not len(has):
                continue
            best = self._mixtures(words, has)
            lead = best.argmax(axis=1)
            for j, i in enumerate(part[has].tolist()):
                if _LETTER.search(rows[i]):
                    names[i] = self.languages[lead[j]]
                    scores[i] = min(1.0, float(best[j, lead[j]]))
                    used = np.flatnonzero(best[j] > 0).tolist()
                    shares[i] = {self.languages[l]: float(best[j, l]) for l in used}
        return names, scores, shares

    def _mixtures(self, words: Words, has: np.ndarray) -> np.ndarray:
        """Proportions of the languages in each text that has words."""
        k, n = len(self.languages), words.count[has]
        one, which, times, first = _alike(words, has)
        logs = self._logs(words, one)
        top = logs.max(axis=1)
        like = np.exp(logs - top[:, None])
        ends = np.append(first[1:], len(which))

        def fitted(of: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Proportions of the allowed languages in the texts ``of``, the likelihood, and
            what no proportions of these languages can exceed."""
            at = _ranges(first[of], (ends - first)[of])
            here, weight, size = like[which[at]], times[at], n[of]
            whose = np.repeat(np.arange(len(of)), (ends - first)[of])
            begin = np.searchsorted(whose, np.arange(len(of)))
            pi = allowed / allowed.sum(axis=1, keepdims=True)
            for _ in range(STEPS):
                part = here * pi[whose]
                part *= (weight / np.maximum(part.sum(axis=1), 1e-30))[:, None]
                pi = np.add.reduceat(part, begin, axis=0) / size[:, None]
            total = np.maximum((here * pi[whose]).sum(axis=1), 1e-300)
            value = np.add.reduceat((top[which[at]] + np.log(total)) * weight, begin)
            # the logarithm is concave: a gain is at most that of the best single direction
            gain = np.add.reduceat(here * (weight / total)[:, None], begin, axis=0) / size[:, None]
            return pi, value, value + size * np.log(np.maximum(gain.max(axis=1), 1))

        texts = np.arange(len(has))
        pi, value, most = fitted(texts, np.ones((len(has), k)))
        rank = np.argsort(np.argsort(-pi, axis=1, kind="stable"), axis=1)
        price = np.log(n) / 2
        best, best_value = pi, value - price * (k - 1)
        for size in range(1, k):
            # no set of this size, or a larger one, is worth more than this
            texts = texts[most[texts] - price[texts] * (size - 1) > best_value[texts]]
            if not len(texts):
                break
            some, some_value, _ = fitted(texts, (rank[texts] < size).astype(float))
            some_value = some_value - price[texts] * (size - 1)
            better = some_value > best_value[texts]
            best[texts[better]], best_value[texts[better]] = some[better], some_value[better]
        return best


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def fit(docs: DataFrame) -> LanguageModel:
    """A model from all rows of ``docs`` (text, lang) whose text and lang are not NULL.

    Each task counts its own rows first; one row for each n-gram that a language has,
    BINS at most, reaches the driver, and no more than there are n-grams in the texts:
    a lang column of many rare values stays small.  The model takes 12 bytes for each.
    Without such rows the model has no language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in slices(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            rows = batch.column("text").to_pylist()
            for lang in sorted(set(langs.tolist())):
                mine = [rows[i] for i in np.flatnonzero(langs == lang)]
                used, n = np.unique(_grams(_words(mine))[0], return_counts=True)
                counts.add(lang, used, n)
                if counts.size > HELD_COUNTS:
                    yield from counts.taken()
        yield from counts.taken()

    base = docs.select("text", "lang").filter("text is not null and lang is not null")
    parts = base.mapInArrow(count, "lang string, bin bigint, n bigint")
    table = parts.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    column = table["lang"].combine_chunks().dictionary_encode()
    found = column.dictionary.to_pylist()
    names = tuple(sorted(found))
    place = {name: i for i, name in enumerate(names)}
    language = np.array([place[x] for x in found], np.int32)[column.indices.to_numpy()]
    bins, n = table["bin"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort((language, bins))
    bins, n, language = bins[order], n[order], language[order]
    # half a count for every bin of every language
    total = np.bincount(language, n, len(names)) + BINS / 2
    start = np.searchsorted(bins, np.arange(BINS + 1))
    return LanguageModel(names, np.log(0.5 / total), start, language, np.log(2.0 * n + 1))


class _Counts:
    """Counts of bins by language, given out as rows before they grow large."""

    def __init__(self) -> None:
        self.size, self.parts = 0, {}

    def add(self, lang: str, bins: np.ndarray, n: np.ndarray) -> None:
        have = self.parts.get(lang)
        if have is not None:
            self.size -= len(have[0])
            both, at = np.unique(np.concatenate((have[0], bins)), return_inverse=True)
            bins, n = both, np.bincount(at, np.concatenate((have[1], n)), len(both)).astype(np.int64)
        self.parts[lang] = bins, n
        self.size += len(bins)

    def taken(self) -> Iterator[pa.RecordBatch]:
        for lang, (bins, n) in self.parts.items():
            names = pa.array([lang] * len(bins), pa.string())
            yield pa.record_batch({"lang": names, "bin": bins.astype(np.int64), "n": n.astype(np.int64)})
        self.size, self.parts = 0, {}


def training_documents(docs: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """The documents outside the held-out fold."""
    return docs.filter(~in_fold(parts, held_out))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, score and lang_shares; columns so named are replaced.

    Only ``text`` is looked at.  A NULL text, or one without a letter, is ``und`` with
    score 0 and no shares; so is every text if the model has no language.  Ties go to
    the language that comes first by name.
    """
    base = without(docs, "lang_pred", "score", "lang_shares")
    names = base.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.map_(pa.string(), pa.float64())

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, shares = shared.value.predict(batch.column("text").to_pylist())
        columns = {c: batch.column(c) for c in names}
        columns |= {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)}
        return pa.record_batch(columns | {"lang_shares": pa.array([list(x.items()) for x in shares], kind)})

    new = "lang_pred string, score double, lang_shares map<string,double>"
    return map_slices(base, make, schema_with(base, new))
