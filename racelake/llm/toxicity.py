"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Two models of order 5 (toxic, ordinary) share one chain of backoff distributions, made of continuation counts over both classes, so
that an expression rare in either class is judged alike by both.  Where an n-gram is unknown to both, the shared backoff cancels and
only the backoff weights of its context differ.  A text's words get log-likelihood ratios; sums over eight words, over the whole text
and over its most telling words, each divided by the bytes they span, are calibrated by a logistic function on labelled documents kept
from the counts.

Learning uses a bounded sample: about `per_class` labelled documents of each class, those in a range of the hash of doc_id as wide as the
class's number of labels asks for.

Defined cases: a null or empty text scores as a text without evidence; a null doc_id is not learned from and not held out; a doc_id
labelled twice is toxic if one label says so; null labels are ignored; repeated rows are scored one by one; without labels of both
classes every score is 0.5; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import hash_sample_by
from ._text import Words, mix, slices

ORDER, _CUT, _WINDOW, _LEAST_BYTES = 5, 40, 8, 32
_END, FEATURES = 2, 6
_U = np.uint64


def unique_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Padded rows of the distinct words of a block, and the row of each: zeros, the word, its end mark, zeros.

    Words of more than _CUT bytes take several rows, each beginning with the last bytes of the one before instead of zeros, and only the last
    with an end mark; so the rows' n-grams are those of the whole word."""
    size = words.ends - words.starts
    many = -(-size // _CUT)
    at = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    begin = words.starts[at] + nth * _CUT
    held = np.minimum(words.ends[at] - begin, _CUT)
    before, last = np.where(nth > 0, ORDER - 1, 0), nth == many[at] - 1
    part = Words.__new__(Words)
    part.data, part.starts, part.ends = words.data, begin - before, begin + held
    _, first, row = np.unique(mix(part.hashes() + before.astype(_U) * _U(2) + last.astype(_U)), return_index=True, return_inverse=True)
    # as many zeros around the data as a row reads beyond it
    data = np.concatenate([np.zeros(ORDER - 1, np.uint8), words.data, np.zeros(_CUT, np.uint8)])
    place = np.arange(ORDER - 1 + _CUT)
    body = data[begin[first][:, None] + place]
    body[(place < ORDER - 1 - before[first][:, None]) | (place >= ORDER - 1 + held[first][:, None])] = 0
    out = np.zeros((len(first), ORDER - 1 + _CUT + 1), np.uint8)
    out[:, :-1] = body
    ends = np.flatnonzero(last[first])
    out[ends, ORDER - 1 + held[first][ends]] = _END
    return out, row


def grams(padded: np.ndarray) -> np.ndarray:
    """The packed n-grams of each padded row (0 after its end)."""
    wide = padded.astype(_U)
    n = padded.shape[1] - ORDER + 1
    key = np.zeros((len(padded), n), _U)
    for k in range(ORDER):
        key = (key << _U(8)) | wide[:, k : k + n]
    return np.where(padded[:, ORDER - 1 :] > 0, key, _U(0))


@dataclass
class Model:
    """Log ratios (toxic over ordinary) of known n-grams and of known contexts, both by sorted key; weights of the calibration."""

    keys: np.ndarray
    ratio: np.ndarray
    contexts: np.ndarray
    context_ratio: np.ndarray
    weights: np.ndarray | None = None

    def of_words(self, padded: np.ndarray) -> np.ndarray:
        key = grams(padded)
        flat = key.ravel()
        used = np.flatnonzero(flat)
        k = flat[used]
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        known = self.keys[i] == k
        value = np.where(known, self.ratio[i], 0.0)
        rest = np.flatnonzero(~known)
        c = k[rest] >> _U(8)
        i = np.minimum(np.searchsorted(self.contexts, c), len(self.contexts) - 1)
        value[rest] = np.where(self.contexts[i] == c, self.context_ratio[i], 0.0)
        out = np.zeros(len(flat))
        out[used] = value
        return out.reshape(key.shape).sum(axis=1)

    def features(self, column: pa.Array) -> np.ndarray:
        """For each text: the log ratio per byte of its best window and of the whole, those of its three best words, and the logarithm of its words (maxima grow with it)."""
        words = Words(column, lower=True)
        out = np.zeros((len(column), FEATURES))
        out[:, 5] = np.log1p(words.counts)
        if not len(words.starts):
            return out
        padded, row = unique_words(words)
        size = words.ends - words.starts
        many = -(-size // _CUT)
        score = np.add.reduceat(self.of_words(padded)[row], np.cumsum(many) - many)
        total, spans = np.concatenate([[0.0], np.cumsum(score)]), np.concatenate([[0], np.cumsum(size + 1)])
        n = len(score)
        last = words.first[1:][words.doc]
        to = np.minimum(np.arange(n) + _WINDOW, last)
        window = (total[to] - total[:n]) / np.maximum(spans[to] - spans[:n], _LEAST_BYTES)
        has = np.flatnonzero(words.counts)
        first = words.first[:-1][has]
        out[has, 0] = np.maximum.reduceat(window, first)
        end = words.first[1:][has]
        out[has, 1] = (total[end] - total[first]) / np.maximum(spans[end] - spans[first], _LEAST_BYTES)
        order = np.lexsort((-score, words.doc))
        rank = np.arange(n) - words.first[:-1][words.doc]
        for k in range(3):
            top = order[rank == k]
            out[words.doc[top], 2 + k] = np.clip(score[top], 0, 12) / 8
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        f = _shaped(self.features(column))
        return 1 / (1 + np.exp(-np.clip(f @ self.weights, -36, 36)))


def _shaped(f: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(f)), f])


def _discount(counts: np.ndarray) -> float:
    n1, n2 = float((counts == 1).sum()), float((counts == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75


def _by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, summed values and the number of entries, keys sorted."""
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, weights=values, minlength=len(u)), np.bincount(inv, minlength=len(u))


def _tail(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & _U((1 << (8 * n)) - 1)


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> Model:
    """keys: sorted distinct n-grams; counts: two columns, ordinary and toxic."""
    # shared chain: continuation counts, from the bytes alone up to order-1
    types = [keys]
    for n in range(ORDER - 1, 0, -1):
        types.append(np.unique(_tail(types[-1], n)))
    p = np.full(len(types[-1]), 1 / 257)
    shorter = types[-1]
    for n in range(1, ORDER):
        longer, grammar = types[ORDER - n - 1], types[ORDER - n]
        cont = np.bincount(np.searchsorted(grammar, _tail(longer, n)), minlength=len(grammar)).astype(float)
        below = p[np.searchsorted(shorter, _tail(grammar, n - 1))] if n > 1 else np.full(len(grammar), 1 / 257)
        d = _discount(cont)
        context, total, kinds = _by(grammar >> _U(8), cont)
        c = np.searchsorted(context, grammar >> _U(8))
        p = np.maximum(cont - d, 0) / total[c] + d * kinds[c] / total[c] * below
        shorter = grammar
    below = p[np.searchsorted(shorter, _tail(keys, ORDER - 1))]
    contexts = np.unique(keys >> _U(8))
    logs, weights = [], []
    for k in (0, 1):
        own = counts[:, k].astype(float)
        d = _discount(own)
        seen = own > 0
        context, total, kinds = _by(keys[seen] >> _U(8), own[seen])
        of = np.searchsorted(contexts, context)
        sums, backoff = np.ones(len(contexts)), np.ones(len(contexts))
        sums[of], backoff[of] = total, d * kinds / total
        c = np.searchsorted(contexts, keys >> _U(8))
        logs.append(np.log(np.maximum(own - d, 0) / sums[c] + backoff[c] * below))
        weights.append(np.log(backoff))
    return Model(keys, (logs[1] - logs[0]).astype(np.float32), contexts, (weights[1] - weights[0]).astype(np.float32))


def calibrate(f: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps; classes weigh as they come."""
    x, w = _shaped(f), np.zeros(f.shape[1] + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -36, 36)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    return w


#: The fold that the registered query keeps from learning, and the part of the rest that calibrates.
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)"
_CALIBRATES = "crc32(cast(doc_id as string)) div 3 % 4 = 0"


def train(docs: DataFrame, labels: DataFrame, per_class: int = 6000) -> Model | None:
    """A model from labelled documents, about per_class of each class at most; None without both classes. The n-gram counts of the sample and a row of measures for each of its calibrating documents reach the driver; of rows of one id and text one is used."""
    given = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    given = hash_sample_by(given, "_toxic", per_class).select("doc_id", "_toxic", F.expr(_CALIBRATES).alias("_late"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(given), "doc_id").select("_toxic", "_late", "text").dropDuplicates()  # about 2 * per_class ids

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column(0).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                texts = b.column(1).filter(pa.array(toxic == k))
                for part in slices(texts, 8_000_000):
                    words = Words(part, lower=True)
                    if not len(words.starts):
                        continue
                    padded, row = unique_words(words)
                    key = grams(padded)
                    times = np.repeat(np.bincount(row, minlength=len(padded)), key.shape[1])
                    used = np.flatnonzero(key.ravel())
                    u, n, _ = _by(key.ravel()[used], times[used])
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.full(len(u), k, np.int32)), pa.array(n.astype(np.int64))], ["key", "k", "n"])

    table = chosen.filter("not _late").select("_toxic", "text").mapInArrow(count, "key long, k int, n long")
    table = table.groupBy("key").agg(F.sum(F.when(F.col("k") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("n1"))
    got = table.toArrow()
    keys = got["key"].to_numpy().view(_U)
    order = np.argsort(keys)
    counts = np.column_stack([got["n0"].to_numpy(), got["n1"].to_numpy()])[order]
    if not len(keys) or not counts.any(axis=0).all():
        return None
    model = kneser_ney(keys[order], counts)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.concatenate([model.features(part) for part in slices(b.column(1), 8_000_000)])
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_numpy(zero_copy_only=False).astype(np.float64)), *(pa.array(np.ascontiguousarray(f[:, k])) for k in range(FEATURES))], ["y", *names])

    names = [f"f{k}" for k in range(FEATURES)]
    late = chosen.filter("_late").select("_toxic", "text").mapInArrow(measure, ", ".join(f"{c} double" for c in ("y", *names))).toArrow()
    y = late["y"].to_numpy() if late.num_rows else np.zeros(0)
    if not 0 < y.sum() < len(y):
        model.weights = np.array([-6.0, 6.0, 0.0, 1.0, 1.0, 1.0, 0.0])
    else:
        f = np.column_stack([late[c].to_numpy() for c in names])
        order = np.lexsort((*f.T, y))
        model.weights = calibrate(f[order], y[order])
    return model


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7, held_out: str = "false") -> DataFrame:
    """doc_id, held_out (an SQL expression over doc_id), score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [sent.value.score(part) if sent.value else np.full(len(part), 0.5) for part in slices(b.column(2), 8_000_000)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.expr(held_out).alias("held_out"), "text").mapInArrow(scan, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold and score all."""
    learn = labels.filter(f"not {HELD_OUT}")
    return score(docs, train(docs, learn), held_out=HELD_OUT)
