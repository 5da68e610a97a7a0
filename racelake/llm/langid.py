"""Language identification by a byte convolutional network.

Bytes are embedded, filters of widths 2, 3 and 4 run over a window of fixed length, each filter's maximum over the window is kept, and
a softmax layer reads the maxima.  Training is numpy on the driver over a bounded sample of rows: about `per_lang` documents of each
language (those in a range of the hash of id and text as wide as the language's number of documents asks for; equal rows count once),
all windows of each, or, where those are more than `windows_per_lang`, about as many, taken by hash from everywhere in the texts; so what reaches the driver is
bounded in bytes too (`most_langs` x `windows_per_lang` x 256; more languages are an error, for such a column names no languages).  Prediction runs in Spark tasks over all windows of every text; the window
probabilities are averaged by their bytes.

Defined cases: a null text or one without a letter is `und` with score 0; a null doc_id is not held out; null languages are not
learned; repeated rows are predicted one by one; without a learned language everything is `und`; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import hash_sample_by, share_of
from ._text import _offsets, slices

SIZE, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 8


@dataclass
class Net:
    """langs: the classes; embed: 256 x EMBED; conv: (widest * EMBED) x filters, narrower filters zero at the end; bias; out: filters x classes; out_bias."""

    langs: list[str]
    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """windows: n x (SIZE + 3) bytes. Returns n x SIZE x (widest * EMBED)."""
        e = np.ascontiguousarray(self.embed[windows])
        n, step = len(windows), e.strides[1]
        wide = np.lib.stride_tricks.as_strided(e, (n, SIZE, max(WIDTHS) * EMBED), (e.strides[0], step, e.strides[2]))
        return wide.reshape(n * SIZE, -1)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maxima (rectified) and where they are."""
        a = (self.patches(windows) @ self.conv).reshape(len(windows), SIZE, -1)
        where = a.argmax(axis=1)
        top = np.take_along_axis(a, where[:, None], axis=1)[:, 0] + self.bias
        return np.maximum(top, 0), where

    def probabilities(self, windows: np.ndarray, step: int = 128) -> np.ndarray:
        parts = []
        for i in range(0, len(windows), step):
            w = windows[i : i + step]
            a = (self.patches(w) @ self.conv).reshape(len(w), SIZE, -1).max(axis=1) + self.bias
            parts.append(_softmax(np.maximum(a, 0) @ self.out + self.out_bias))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)), np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit_net(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 6, steps: int = 400, batch: int = 64, rate: float = 0.004, seed: int = 7) -> Net:
    """Cross-entropy by Adam over shuffled batches: so many epochs, and more on small samples until there are `steps` batches."""
    rng = np.random.default_rng(seed)
    widest, many = max(WIDTHS), FILTERS * len(WIDTHS)
    shape = np.zeros((widest * EMBED, many), np.float32)
    for i, w in enumerate(WIDTHS):
        shape[: w * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
    net = Net(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), (rng.normal(0, 0.3, shape.shape) * shape).astype(np.float32), np.zeros(many, np.float32), rng.normal(0, 0.3, (many, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    params = [net.embed, net.conv, net.bias, net.out, net.out_bias]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(max(epochs, -(-steps * batch // max(len(windows), 1)) if len(windows) else 0)):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            x, y = windows[order[i : i + batch]], labels[order[i : i + batch]]
            t += 1
            for k, g in enumerate(gradient(net, x, y)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return net


def gradient(net: Net, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """The slopes of the mean cross-entropy of windows x with classes y, in the order of Net's parameters."""
    widest, many = max(WIDTHS), FILTERS * len(WIDTHS)
    used = np.arange(widest * EMBED)[:, None] < np.repeat(WIDTHS, FILTERS) * EMBED
    top, where = net.pooled(x)
    d = _softmax(top @ net.out + net.out_bias)
    d[np.arange(len(y)), y] -= 1
    d /= len(y)
    d_top = (d @ net.out.T) * (top > 0)
    at = where[:, :, None] + np.arange(widest)  # n x filters x widest
    seen = x[np.arange(len(x))[:, None, None], at]
    patch = net.embed[seen].reshape(len(x), many, -1)
    d_conv = np.einsum("nf,nfk->kf", d_top, patch) * used
    d_patch = (d_top[:, :, None] * net.conv.T).reshape(len(x), many, widest, EMBED)
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, seen.ravel(), d_patch.reshape(-1, EMBED))
    return d_embed, d_conv, d_top.sum(0), top.T @ d, d.sum(0)


def cut(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a block of texts: n x (SIZE + 3) bytes (zeros after a text's end), the text and the bytes of each."""
    size = np.diff(off)
    many = -(-size // SIZE)
    doc = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    begin = off[:-1][doc] + nth * SIZE
    held = np.minimum(off[1:][doc] - begin, SIZE)
    padded = np.concatenate([data, np.zeros(SIZE + 3, np.uint8)])
    out = padded[begin[:, None] + np.arange(SIZE + 3)]
    out[np.arange(SIZE + 3) >= held[:, None]] = 0
    return out, doc, held


def _block(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    off = _offsets(part).astype(np.int64)
    buf = part.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def _windows(shares: dict[str, float]):
    """Columns lang, text: of the windows that prediction reads, all or a share by hash of place and bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, rows = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw, share = text.encode(), shares[lang]
                for at in range(0, len(raw), SIZE):
                    w = raw[at : at + SIZE]
                    if share >= 1 or xxhash.xxh3_64_intdigest(w, at) < share * 2.0**64:
                        langs.append(lang)
                        rows.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], ["lang", "w"])

    return scan


def train(docs: DataFrame, per_lang: int = 1000, windows_per_lang: int = 60_000, most_langs: int = 200) -> Net | None:
    """A net learned from documents with a language, about per_lang of each and windows_per_lang of their windows at most; None without any."""
    given = docs.filter("text is not null and lang is not null").select("doc_id", "text", "lang")
    if given.select("lang").distinct().limit(most_langs + 1).count() > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    known = hash_sample_by(given, "lang", per_lang).select("lang", "text")
    sizes = known.groupBy("lang").agg(F.sum(F.ceil(F.octet_length("text") / SIZE)).alias("n")).collect()  # a row for each language
    shares = {r["lang"]: share_of(r["n"], windows_per_lang) for r in sizes}
    rows = sorted((r["lang"], bytes(r["w"])) for r in known.mapInArrow(_windows(shares), "lang string, w binary").collect())
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    x = np.zeros((len(rows), SIZE + 3), np.uint8)
    for i, (_, w) in enumerate(rows):
        x[i, : len(w)] = np.frombuffer(w, np.uint8)
    return fit_net(x, np.array([langs.index(lang) for lang, _ in rows]), langs)


def predict(docs: DataFrame, net: Net | None, held_out: str = "false") -> DataFrame:
    """doc_id, held_out (an SQL expression over doc_id), lang_pred, score."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            preds, scores = [], []
            for part in slices(b.column(2), 2_000_000):
                p = np.zeros((len(part), len(net.langs) if net else 1))
                if net:
                    x, doc, held = cut(*_block(part))
                    np.add.at(p, doc, net.probabilities(x) * held[:, None])
                    p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-30)
                best = p.argmax(axis=1)
                for i, text in enumerate(part.to_pylist()):
                    known = net is not None and any(map(str.isalpha, text))
                    preds.append(net.langs[best[i]] if known else "und")
                    scores.append(float(p[i, best[i]]) if known else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.expr(held_out).alias("held_out"), "text").mapInArrow(scan, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


#: The fold that the registered query keeps from learning.
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)"


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside the held-out fold and predict all."""
    learn = docs.filter(f"doc_id is not null and not {HELD_OUT}")
    return predict(docs, train(learn), HELD_OUT)
