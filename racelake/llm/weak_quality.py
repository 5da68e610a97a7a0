"""A quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document.  How often each pattern of votes occurs (a table of at
most 3 ** labellers rows, over all documents) is all that expectation-maximisation needs to estimate how each labeller votes on good
and on bad documents, and the share of good ones.  Posteriors of the patterns then label a bounded sample, on which a linear scorer over
hashed word-shape features is trained; it scores every document.

The sample: about `most` documents, those in a hash range of (doc_id, text) as wide as the number of documents asks for, so that each
pattern has about its share of all documents; repeated rows count once in it.

Defined cases: a null or empty text has no features and gets only the labellers' verdict on length; null ids stay; repeated rows are scored one by
one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import hash_sample
from ._text import Words, grams, inside, mix, slices

_U = np.uint64
_LOG = logging.getLogger(__name__)
_DIMS = 2048
LABELLERS = ("symbols", "letters", "plain_words", "capitals", "marks", "distinct_words", "distinct_runs", "stops", "word_length", "length")
_LENGTH = LABELLERS.index("length")
_SYMBOL, _CAPITAL, _DIGIT, _STOP, _MARK = (np.zeros(256, np.int32) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>~^=_{}[]\\")] = 1
_CAPITAL[65:91] = 1
_DIGIT[48:58] = 1
_STOP[list(b".,;:?")] = 1
_MARK[list(b"!")] = 1


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its row and two hashed features; per text: the measures that LABELLERS read."""
    words = Words(column)
    n, size = words.rows, words.ends - words.starts
    sums = {}
    for name, table in (("symbol", _SYMBOL), ("capital", _CAPITAL), ("digit", _DIGIT), ("stop", _STOP), ("mark", _MARK)):
        total = np.concatenate([[0], np.cumsum(table[words.data])])
        sums[name] = total[words.ends] - total[words.starts]
    h = words.hashes()
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
    case = np.where(sums["capital"] == 0, 0, np.where(sums["capital"] * 2 > size, 2, 1))
    shape = np.minimum(size, 11) + 12 * (case + 3 * ((sums["digit"] > 0) + 2 * ((sums["symbol"] > 0) + 2 * (np.minimum(sums["stop"], 1) + 2 * (np.minimum(sums["mark"], 1) + 2 * same)))))
    before = np.full(len(shape), 4095)
    before[1:] = np.where(words.doc[1:] == words.doc[:-1], shape[:-1], 4095)
    keys = mix(np.stack([shape.astype(_U), shape.astype(_U) * _U(4096) + before.astype(_U) + _U(1 << 32)])) % _U(_DIMS)
    keys = keys.astype(np.int64) + np.array([[0], [_DIMS]])

    def per_doc(x: np.ndarray) -> np.ndarray:
        return np.bincount(words.doc, weights=x, minlength=n)

    def distinct_pairs(doc: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many different entries each row has, told apart by 40 bits of their hash: one sort of plain integers."""
        key = np.sort((doc.astype(_U) << _U(40)) | (x >> _U(24)))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        return np.bincount((key[new] >> _U(40)).astype(np.int64), minlength=n)

    many, chars = np.maximum(words.counts, 1), np.maximum(per_doc(size), 1)
    good = inside(words.doc, 3)
    runs = np.bincount(words.doc[: len(good)][good], minlength=n)
    odd = sums["symbol"] + sums["digit"] + sums["mark"]
    measures = np.column_stack([
        per_doc(sums["symbol"]) / many, 1 - per_doc(odd + sums["stop"]) / chars, per_doc(odd == 0) / many, per_doc(sums["capital"]) / chars, per_doc(sums["mark"]) / many, distinct_pairs(words.doc, h) / many,
        distinct_pairs(words.doc[: len(good)][good], grams(h, 3)[good]) / np.maximum(runs, 1), per_doc(sums["stop"]) / many, chars / many, words.counts,
    ])
    return words.doc, keys, measures


def votes(m: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, 2 nothing, for each text and labeller."""

    def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.where(bad, 0, np.where(good, 1, 2))

    symbols, letters, plain, capitals, marks, words, runs, stops, length, n = m.T
    some = n >= 20
    return np.column_stack([
        vote(symbols < 0.03, symbols > 0.15), vote(letters > 0.93, letters < 0.85), vote(plain > 0.9, plain < 0.75), vote(capitals < 0.1, capitals > 0.3), vote(marks < 0.02, marks > 0.2), vote(some & (words > 0.45), some & (words < 0.2)),
        vote(some & (runs > 0.9), some & (runs < 0.6)), vote(some & (stops > 0.04) & (stops < 0.5), some & (stops < 0.01)), vote((length > 3.2) & (length < 9), (length < 2.6) | (length > 12)), vote(n >= 50, n < 10),
    ])


@dataclass
class LabelModel:
    """good: the share of good documents; votes: the chance of each vote (bad, good, nothing), by class (bad, good) and labeller: 2 x 3 x labellers."""

    good: float
    votes: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance of good for each row of votes."""
        each = np.arange(patterns.shape[1])
        bad, good = (np.log(self.votes[c])[patterns, each].sum(axis=1) for c in (0, 1))
        return 1 / (1 + np.exp(np.clip(bad + np.log(1 - self.good) - good - np.log(self.good), -36, 36)))


def fit_labellers(patterns: np.ndarray, n: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over patterns (rows of votes, n documents each); a labeller's three votes are independent of the others' given the class, and one pseudo-count each smooths them. It starts from the share of good among the votes given."""
    spoke = patterns < 2
    p = np.clip(np.where(spoke.any(axis=1), (patterns == 1).sum(axis=1) / np.maximum(spoke.sum(axis=1), 1), 0.5), 0.05, 0.95)
    model = LabelModel(0.5, np.full((2, 3, patterns.shape[1]), 1 / 3))
    for _ in range(rounds):
        counts = np.array([[((patterns == v) * w[:, None]).sum(axis=0) + 1 for v in range(3)] for w in ((1 - p) * n, p * n)])
        model = LabelModel(float(np.clip((p * n).sum() / n.sum(), 0.02, 0.98)), counts / counts.sum(axis=1, keepdims=True))
        p = model.posterior(patterns)
    return model


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 0.5, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels by Adam; the last weight is the bias."""
    w, m, v = np.zeros(x.shape[1] + 1, x.dtype), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -36, 36)))
        g = np.append(x.T @ (p - y) / len(y) + ridge * w[:-1], (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _code(v: np.ndarray) -> np.ndarray:
    return (v * 3 ** np.arange(v.shape[1])).sum(axis=1)


def _pattern(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def train(docs: DataFrame, most: int = 2000) -> tuple[LabelModel | None, np.ndarray]:
    """The label model and the scorer's weights; None and no weights without documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b.column(0), 8_000_000):
                u, n = np.unique(_code(votes(features(part)[2])), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n)], ["code", "n"])

    coded = docs.select("text").mapInArrow(count, "code long, n long")
    table = coded.groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # at most 3 ** labellers rows
    order = np.argsort(table["code"].to_numpy())
    codes, n = (table[c].to_numpy()[order] for c in ("code", "n"))
    if not len(codes):
        return None, np.zeros(2 * _DIMS + 1)
    model = fit_labellers(_pattern(codes), n.astype(float))
    for name, bad, good in zip(LABELLERS, model.votes[0].T, model.votes[1].T, strict=True):
        _LOG.info("%s votes good on %.3f of good documents, bad on %.3f of bad ones", name, good[1], bad[0])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b.column(0), 4_000_000):
                doc, keys, measures = features(part)
                code = _code(votes(measures))
                for i in range(len(part)):
                    mine = keys[:, np.searchsorted(doc, i) : np.searchsorted(doc, i, side="right")]
                    x = np.bincount(mine.ravel(), minlength=2 * _DIMS) / max(mine.shape[1], 1)
                    yield pa.RecordBatch.from_arrays([pa.array([int(code[i])]), pa.array([x.astype(np.float32).tobytes()], pa.binary())], ["code", "x"])

    got = hash_sample(docs.select("doc_id", "text"), int(n.sum()), most).select("text").mapInArrow(sample, "code long, x binary").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, 2 * _DIMS)
    if not len(x):
        return model, np.zeros(2 * _DIMS + 1)
    y = model.posterior(_pattern(got["code"].to_numpy()))
    order = np.lexsort((x[:, :8].sum(axis=1), y))
    return model, fit_linear(x[order], y[order].astype(np.float32))


def classify(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, weak_label (the posterior of the labellers' votes), score, kept of every document."""
    model, weights = train(docs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weak, scores = [], []
            for part in slices(b.column(1), 8_000_000):
                doc, keys, measures = features(part)
                x = np.bincount(doc, weights=weights[keys].sum(axis=0), minlength=len(part)) / np.maximum(measures[:, _LENGTH], 1)
                scores.append(1 / (1 + np.exp(-np.clip(x + weights[-1], -36, 36))))
                weak.append(model.posterior(votes(measures)) if model else np.full(len(part), 0.5))
            weak, scores = (np.concatenate(a) if a else np.zeros(0) for a in (weak, scores))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(weak), pa.array(scores), pa.array(scores >= threshold)], ["doc_id", "weak_label", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, weak_label double, score double, kept boolean")
