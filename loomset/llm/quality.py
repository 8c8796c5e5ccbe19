"""A quality classifier from positive and unlabelled documents.

The score is linear in features of the whole text: how its bytes are spread over
classes of characters, and how often words and lines repeat.  It minimises the
non-negative unbiased risk of positive-unlabelled learning,

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)),

where P are trusted positives and U is all text, labelled or not.  With the squared
loss each risk is a function of the first two moments of the features, so that Spark
reduces all documents to two small matrices and the minimum is found on those.
Features are whole numbers: the moments are exact, and do not depend on the order in
which executors deliver them.

The class prior is estimated from positives and unlabelled text alone.  A linear score
that separates P from U orders all documents; where its upper end holds hardly anything
but positives, the share of U above a cut, divided by that of P, is the prior.  The cut
is the one with the least upper bound of that quotient (best bin estimation).  The score
is a whole number, too, so that its two histograms are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.folds import in_fold
from loomset.llm.words import free, map_slices, schema_with, slices, stored, texts, without

#: A feature of 1.0 is this number.
SCALE = 255
#: Bytes are counted by class: each ASCII punctuation mark is one of its own.
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_CLASSES = 6 + len(_MARKS)
_STEPS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4)
_LENGTHS = (1, 3, 10, 20, 50, 200, 1000)
#: Bins of the score that separates positives from all text, and the unit of its weights.
PRIOR_BINS = 2000
_UNIT = 1 << 20
#: The bound of the prior's quotient holds with this chance of error, and is widened so.
_ERROR, _WIDER = 0.1, 0.01


def _class_table() -> np.ndarray:
    table = np.full(256, 5)
    for b in range(256):
        c = chr(b)
        if b >= 128 or "a" <= c <= "z":
            table[b] = 0
        elif "A" <= c <= "Z":
            table[b] = 1
        elif "0" <= c <= "9":
            table[b] = 2
        elif b == 32:
            table[b] = 3
        elif 9 <= b <= 13:
            table[b] = 4
        elif b in _MARKS:
            table[b] = 6 + _MARKS.index(b)
    return table


_CLASS = _class_table()


def _shares(text: bytes) -> list[float]:
    """Shares of words or lines in which a text differs from running prose."""
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    marks = len(text) - len(text.translate(None, _MARKS))
    loud = sum(map(bytes.isupper, words))
    return [
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        min(1.0, marks / n / 4),
        loud / n,
        1 - len(set(words)) / n,
    ]


_SHARES = 5
#: Bias, character classes, steps of each share, steps of the length in words.
FEATURES = 1 + _CLASSES + _SHARES * (1 + len(_STEPS)) + len(_LENGTHS)


def features(rows: list[bytes | None]) -> np.ndarray:
    """One row of FEATURES whole numbers from 0 to SCALE for each text.

    NULL counts as empty; its only feature is the bias.
    """
    rows = [x or b"" for x in rows]
    x = np.zeros((len(rows), FEATURES))
    x[:, 0] = 1
    for i, text in enumerate(rows):
        if text:
            kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_CLASSES)
            x[i, 1 : 1 + _CLASSES] = np.sqrt(kinds / len(text))
    share = np.array([_shares(t) for t in rows]).reshape(-1, _SHARES)
    at = 1 + _CLASSES
    x[:, at : at + _SHARES] = share
    at += _SHARES
    for step in _STEPS:
        x[:, at : at + _SHARES] = share > step
        at += _SHARES
    n = np.array([len(t.split()) for t in rows])
    for k, step in enumerate(_LENGTHS):
        x[:, at + k] = n >= step
    return np.rint(x * SCALE)


@dataclass(frozen=True)
class QualityModel:
    prior: float
    weights: tuple[float, ...]

    def scores(self, rows: list[bytes | None]) -> np.ndarray:
        """From 0 to 1; the squared loss makes it an estimate of the probability."""
        g = features(rows) / SCALE @ np.array(self.weights)
        return np.clip((g + 1) / 2, 0.0, 1.0)


def non_negative_weights(
    prior: float, mp: np.ndarray, sp: np.ndarray, mu: np.ndarray, su: np.ndarray, ridge: float = 1e-3
) -> np.ndarray:
    """Weights of the least non-negative risk, from means ``m`` and second moments ``s``
    of the positives ``p`` and of all text ``u``."""
    d = len(mu)

    def inner(w: np.ndarray) -> float:
        """R_U(-) - prior * R_P(-); for true risks, never negative."""
        u = (w @ su @ w + 2 * w @ mu + 1) / 4
        return float(u - prior * (w @ sp @ w + 2 * w @ mp + 1) / 4)

    half = np.linalg.inv(su + 4 * ridge * np.eye(d))
    w = half @ (2 * prior * mp - mu)
    if inner(w) >= 0:
        return w
    # the bound holds: follow the risk where it is open, and leave it where it is not
    w, best = np.zeros(d), (np.inf, np.zeros(d))
    for _ in range(2000):
        plus = prior * (w @ sp @ w - 2 * w @ mp + 1) / 4
        risk = plus + max(0.0, inner(w)) + ridge * w @ w
        best = min(best, (risk, w), key=lambda x: x[0])
        back = (su @ w + mu - prior * (sp @ w + mp)) / 2
        if inner(w) >= 0:
            step = prior * (sp @ w - mp) / 2 + back + 2 * ridge * w
        else:
            step = -back
        w = w - 0.1 * half @ step
    return best[1]


def separating_weights(mp: np.ndarray, sp: np.ndarray, mu: np.ndarray, su: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Whole weights of the least-squares score, near 1 for positives and -1 for all text."""
    w = np.linalg.solve((sp + su) / 2 + ridge * np.eye(len(mu)), (mp - mu) / 2)
    return np.rint(np.clip(w, -1e3, 1e3) * _UNIT)


def prior_bins(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The bin of each row of whole features; the sums are exact in 64-bit floats."""
    g = x @ weights / (_UNIT * SCALE)
    return np.clip((g + 1) / 2 * PRIOR_BINS, 0, PRIOR_BINS - 1).astype(np.int64)


def class_prior(positives: np.ndarray, everything: np.ndarray) -> float:
    """The share of positives in all text, from how many of both fall into each bin."""
    n_p, n_u = positives.sum(), everything.sum()
    above_p = positives[::-1].cumsum() / n_p
    above_u = everything[::-1].cumsum() / n_u
    at = np.flatnonzero(above_p)
    quotient = above_u[at] / above_p[at]
    doubt = np.sqrt(np.log(4 / _ERROR) / 2) * (n_u**-0.5 + n_p**-0.5)
    return float(quotient[np.argmin(quotient + (1 + _WIDER) * doubt / above_p[at])])


def labelled_share(labels: DataFrame) -> float | None:
    """The share of documents labelled 1 among the labelled; None if there is none.

    A prior for ``fit`` where labels are a fair sample of both kinds.
    """
    return _known(labels).agg(F.avg((F.col("_quality") == 1).cast("int"))).first()[0]


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, _quality): the smallest label of each labelled document."""
    known = labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_quality"))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> QualityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Trusted positives are the documents labelled 1; other labels are not looked at.  All
    documents, whatever their label, are the unlabelled text.  Unless given, the class
    prior is estimated from these two.  It is kept between 0.05 and 0.95.  Where a
    document is labelled more than once, the smallest label counts; NULL labels and
    labels without a document do not.  Without a positive every text scores 0.5.
    """
    known = _known(labels)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(texts(batch)).astype(np.uint8)
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "x": pa.array([r.tobytes() for r in x], pa.binary())}
            )

    def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Features of the rows, and which of them are positives."""
        x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8)
        y = batch.column("_quality").fill_null(-1).to_numpy(zero_copy_only=False)
        return x.reshape(-1, FEATURES).astype(float), y == 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, m, n = np.zeros((2, FEATURES, FEATURES)), np.zeros((2, FEATURES)), np.zeros(2)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, good = rows_of(batch)
            for k, part in enumerate((x[good], x)):
                s[k] += part.T @ part
                m[k] += part.sum(axis=0)
            n += [good.sum(), len(x)]
        yield numbered(np.concatenate([s.ravel(), m.ravel(), n]))

    def numbered(flat: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"at": np.arange(len(flat)), "n": flat.astype(np.int64)})

    def total(make: Callable, size: int) -> np.ndarray:
        """Sums over all documents of what ``make`` gives for each task."""
        parts = rows.mapInArrow(make, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        flat = np.zeros(size)
        flat[parts["at"].to_numpy()] = parts["n"].to_numpy()
        return flat

    x = docs.select("doc_id", "text").mapInArrow(vectors, "doc_id bigint, x binary")
    rows = x.join(known, "doc_id", "left").select("x", "_quality")
    if prior is None:
        rows = stored(rows)  # read twice
    flat = total(moments, 2 * FEATURES * (FEATURES + 1) + 2)
    size = 2 * FEATURES * FEATURES
    s = flat[:size].reshape(2, FEATURES, FEATURES) / SCALE**2
    m = flat[size : size + 2 * FEATURES].reshape(2, FEATURES) / SCALE
    n_pos, n_all = flat[-2:]
    if not n_pos:
        return QualityModel(0.5, (0.0,) * FEATURES)
    means = m[0] / n_pos, s[0] / n_pos, m[1] / n_all, s[1] / n_all
    if prior is None:
        weights = separating_weights(*means)

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros((2, PRIOR_BINS), np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, good = rows_of(batch)
                at = prior_bins(x, weights)
                for k, part in enumerate((at[good], at)):
                    n[k] += np.bincount(part, minlength=PRIOR_BINS)
            yield numbered(n.ravel())

        prior = class_prior(*total(histograms, 2 * PRIOR_BINS).reshape(2, PRIOR_BINS))
    prior = float(np.clip(prior, 0.05, 0.95))
    return QualityModel(prior, tuple(non_negative_weights(prior, *means).tolist()))


def training_labels(labels: DataFrame, parts: int = 5, held_out: int = 0) -> DataFrame:
    """The labels outside the held-out fold."""
    return labels.filter(~in_fold(parts, held_out))


def score(docs: DataFrame, model: QualityModel, column: str = "score") -> DataFrame:
    """``docs`` with a column ``score``; one of that name is replaced.

    NULL and empty texts get the score of a text without a character.
    """
    base = without(docs, column)
    names = base.columns

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {c: batch.column(c) for c in names}
        return pa.record_batch(columns | {column: pa.array(model.scores(texts(batch)))})

    return map_slices(base, make, schema_with(base, f"{column} double"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    column = free(docs, "quality_score")
    scored = score(docs, fit(docs, labels), column)
    return without(scored.filter(F.col(column) >= least), column)
