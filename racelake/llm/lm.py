"""Scoring by a trigram model with deleted interpolation.

Counts of one, two and three words cover every training token.  A scan task turns its texts into blocks; of each block the distinct
n-grams (hashes of 64 bits for words, of 56 for longer ones) with their training counts travel as sorted, delta-coded byte planes to the
owner of their hash range, are summed there over all blocks, and the sums return to the block in the order in which it sent them.  The
block then knows, for each token, the counts of the word, of the pair and of the three.

The probability of a word is interpolated from below:  p0 = 1 / (V + 1),  p1 = a * c(w) / N + (1 - a) * p0,  p2 = b * c(v w) / c(v) + (1 - b) * p1,
p3 = d * c(u v w) / c(u v) + (1 - d) * p2,  with b and d by bucket (powers of two) of the context's frequency, 0 where the context is
unknown.  The weights of each order maximise the likelihood of held-out counts: each training token is taken out of the counts
(deleted) and predicted from the rest.  What a weight does to a token depends only on the ratio of its order's estimate to the order
below, so expectation-maximisation runs on the driver over counts by bucket and binned ratio, a table of bounded size.

Defined cases: a null or empty text is the end token alone; a null doc_id is not held out; repeated rows are scored one by one; an empty
table gives an empty result; extra columns are ignored; without training tokens every token has probability 1 / (V + 1).  `docs` must be a
deterministic scan (a table): a block is named by its content, and counts that return to no block, or a block whose counts are not all
there, end the query with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._blocks import BLOCK_BYTES, carried, parts_of, range_edges, to_owners
from ._scratch import Scratch, settings
from ._text import Words, grams, pack, planes, released, unpack, unplanes

_U = np.uint64
_END = _U(0x5851F42D4C957F2D)
_START = _U(0x14057B7EF767814F)
ORDER = 3
#: Context buckets (powers of two); bins of a ratio: steps of its natural logarithm (32 a unit) to either side of 1, and one for 0.
_BUCKETS, _STEP, _HALF = 48, 32.0, 2560
_BINS = 2 * _HALF + 2


class Block:
    """Texts of one block: per document its tokens (words, then the end); for each order the distinct n-grams, each token's place among them, and their training counts."""

    def __init__(self, ids: pa.Array, held: np.ndarray, texts: pa.Array):
        self.ids, self.held = ids, held
        words = Words(texts, lower=True)
        n = words.rows
        h = words.hashes()
        self.sizes = words.counts + 1
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        token = np.full(int(ends[-1]) if n else 0, _END, _U)
        is_word = np.ones(len(token), bool)
        is_word[ends - 1] = False
        token[is_word] = h
        del words, h
        one = self._before(token, _START)
        two = self._before(one, _START)
        train = np.repeat(~held, self.sizes)
        keys = [token]
        for parts in ((one, token), (two, one, token)):
            k = len(parts)
            keys.append(grams(np.column_stack(parts).ravel(), k)[::k] >> _U(8) if len(token) else token)
        del one, two
        self.keys, self.at, self.n = [], [], []
        for key in keys:
            u, at = np.unique(key, return_inverse=True)
            self.keys.append(u)
            self.at.append(at)
            self.n.append(np.bincount(at[train], minlength=len(u)).astype(np.int64))

    def _before(self, x: np.ndarray, first: np.uint64) -> np.ndarray:
        """The entry before each token in its document."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.starts] = first
        return out


def _block(ids: pa.Array, held: pa.Array, texts: pa.Array) -> Block:
    return Block(ids, held.to_numpy(zero_copy_only=False).astype(bool), texts)


def _requests(parts: int):
    """Rows (owner, block, kind, hashes, counts): the distinct n-grams of each block by owner of their range."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, *block in parts_of(batch):
                b = _block(*block)
                for kind, (u, n) in enumerate(zip(b.keys, b.n, strict=True)):
                    edges = [0, *np.searchsorted(u, range_edges(parts, 56 if kind else 64)).tolist(), len(u)]
                    rows = [(i, name, kind, planes(np.diff(u[s:e], prepend=u[s : s + 1] * _U(0)), 8), pack(n[s:e])) for i, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if e > s]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["owner", "block", "kind", "hashes", "counts"])

    return send


_ANSWER = "block long, kind int, owner int, counts binary, types long, tokens long"


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions sorted by (owner, kind): sum the counts of each n-gram of a range over all blocks and answer each block; rows without a block tell how many words (types) have a count of some size, and their tokens."""
    for (owner, kind), rows in _groups(batches):
        hashes = [np.cumsum(unplanes(r[3], 8), dtype=_U) for r in rows]
        sizes = [len(h) for h in hashes]
        every = np.concatenate(hashes)
        del hashes
        u, at = np.unique(every, return_inverse=True)
        del every
        total, begin = np.zeros(len(u), np.int64), 0
        for r, n in zip(rows, sizes, strict=True):
            total[at[begin : begin + n]] += unpack(r[4])  # the n-grams of a block are distinct
            begin += n
        out, begin = [], 0
        for r, n in zip(rows, sizes, strict=True):
            out.append((r[1], kind, owner, pack(total[at[begin : begin + n]]), 0, 0))
            begin += n
        if kind == 0:
            seen = total[total > 0]
            size = np.where(seen < 256, seen, 256 + np.round(np.log2(np.maximum(seen, 1)) * 32).astype(np.int64))
            for s in np.unique(size).tolist():
                out.append((-1, int(s), owner, b"", int((size == s).sum()), int(seen[size == s].sum())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["block", "kind", "owner", "counts", "types", "tokens"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows of equal (owner, kind), whole."""
    key, rows = None, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (r[0], r[2]) != key:
                if rows:
                    yield key, rows
                key, rows = (r[0], r[2]), []
            rows.append(r)
    if rows:
        yield key, rows


def _bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(c.astype(float))[1], _BUCKETS - 1)


def _binned(ratio: np.ndarray) -> np.ndarray:
    """0 for none, else by the logarithm, from 1."""
    with np.errstate(divide="ignore"):
        return np.where(ratio > 0, np.clip(np.round(np.log(np.maximum(ratio, 1e-300)) * _STEP), -_HALF, _HALF) + _HALF + 1, 0).astype(np.int64)


def _ratio_of(bins: np.ndarray) -> np.ndarray:
    return np.where(bins > 0, np.exp((bins - _HALF - 1) / _STEP), 0.0)


def fit_weights(bucket: np.ndarray, ratio: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """The weight of an order by context bucket, by expectation-maximisation over held-out tokens: n of them have an estimate `ratio` times that of the order below. A bucket without tokens has the weight of the one before; unknown contexts have none."""
    out, last = np.zeros(_BUCKETS), 0.0
    for b in range(1, _BUCKETS):
        r, c = ratio[bucket == b], n[bucket == b].astype(float)
        if c.sum() > 0:
            w = 0.5
            for _ in range(rounds):
                w = float((c * w * r / (w * r + 1 - w)).sum() / c.sum())
                w = min(max(w, 1e-6), 1 - 1e-6)
            last = w
        out[b] = last
    return out


class Mix:
    """The probabilities of tokens from their counts; training counts minus `own` (0 or 1) where tokens are deleted. weights: by order (1, 2, 3) and bucket; starts: training documents."""

    def __init__(self, total: int, kinds: int, starts: int, weights: list[np.ndarray]):
        self.total, self.kinds, self.starts, self.weights = total, kinds, starts, weights

    def contexts(self, counts: list[np.ndarray], first: np.ndarray) -> list[np.ndarray]:
        """The frequency of the context of each order: all tokens, the word before, the two words before."""
        out = [np.full(len(counts[0]), self.total, np.int64)]
        for c in counts[:-1]:
            context = np.empty_like(c)
            context[1:] = c[:-1]
            context[first] = self.starts
            out.append(context)
        return out

    def ratio(self, order: int, counts: list[np.ndarray], first: np.ndarray, own: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token the context's bucket, the estimate of that order, and the probability by the orders below."""
        contexts = self.contexts(counts, first)
        p = np.full(len(counts[0]), 1 / (self.kinds + 1))
        for k in range(order):
            seen = np.maximum(contexts[k] - own, 0)
            bucket, estimate = _bucket(seen), (counts[k] - own) / np.maximum(seen, 1)
            if k + 1 == order:
                return bucket, estimate, p
            w = self.weights[k][bucket]
            p = w * estimate + (1 - w) * p
        raise ValueError(order)

    def probability(self, counts: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        bucket, estimate, p = self.ratio(ORDER, counts, first)
        w = self.weights[ORDER - 1][bucket]
        return w * estimate + (1 - w) * p

    def histogram(self, order: int, counts: list[np.ndarray], first: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training tokens, each deleted from the counts, by context bucket and binned ratio: keys and numbers."""
        bucket, estimate, p = self.ratio(order, counts, first, own=1)
        return np.unique(bucket[train] * _BINS + _binned(estimate[train] / p[train]), return_counts=True)


def _counted(mix: Mix):
    """Rows of texts and answers of a block, together, become one row: ids, held, sizes, counts of each token by order, and the histogram of the second order."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, answers in _with_answers(batches):
            counts = []
            for kind in range(ORDER):
                got = np.concatenate([unpack(c) for _, c in sorted(answers[kind])] or [np.zeros(0, np.int64)])
                if len(got) != len(b.keys[kind]):
                    raise RuntimeError("counts of a block are missing: the documents must come from a deterministic scan")
                counts.append(got[b.at[kind]])
            key, n = mix.histogram(2, counts, b.starts, np.repeat(~b.held, b.sizes))
            row = [b.ids, b.held, b.sizes.astype(np.int32), *(pack(c) for c in counts), key, n.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array([x]) if isinstance(x, bytes) else pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x) if not isinstance(x, pa.Array) else x) for x in row], ["ids", "held", "sizes", *_COUNTS, "key", "n"])

    return finish


_COUNTS = ["one", "two", "three"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """ids, held, sizes, first tokens and counts of each row of _counted()."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, held, sizes = (batch.column(k)[i].values for k in range(3))
            sizes = sizes.to_numpy().astype(np.int64)
            yield ids, held, sizes, np.cumsum(sizes) - sizes, [unpack(batch.column(3 + k)[i].as_py()) for k in range(ORDER)]


def _third(mix: Mix):
    """Rows of _counted(): the histogram of the third order."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, sizes, first, counts in _read(batches):
            key, n = mix.histogram(3, counts, first, np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    return finish


def _scored(mix: Mix):
    total = mix.total
    base = float(np.log10(total + 0.5 * (mix.kinds + 1)))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held, sizes, first, counts in _read(batches):
            score = np.add.reduceat(np.log10(mix.probability(counts, first)), first)
            plain = np.add.reduceat(np.log10(counts[0] + 0.5) - base, first)
            known = np.add.reduceat((counts[0] > 0).astype(np.int64), first)
            yield pa.RecordBatch.from_arrays([ids, held, pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), total, np.int64)), pa.array(plain), pa.array(score)], _OUT)

    return finish


_OUT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _with_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, dict[int, list]]]:
    """Rows sorted by block, of columns block, kind, owner, counts, ids, held, texts: those with texts come first."""
    once = lambda answers: {k: list({o: (o, c) for o, c in v}.values()) for k, v in answers.items()}
    name, waiting, answers = None, [], {}
    for batch in batches:
        for i in range(batch.num_rows):
            at = batch.column(0)[i].as_py()
            if at != name:
                yield from ((_block(*x), once(answers)) for x in waiting)
                name, waiting, answers = at, [], {k: [] for k in range(ORDER)}
            if batch.column(4)[i].is_valid:
                waiting.append([batch.column(k)[i].values for k in (4, 5, 6)])  # more than one: the same content again, with the same answers
            else:
                answers[batch.column(1)[i].as_py()].append((batch.column(2)[i].as_py(), batch.column(3)[i].as_py()))
    yield from ((_block(*x), once(answers)) for x in waiting)


#: The fold that the registered query keeps from learning.
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 5 = 1, false)"


def _fitted(histogram: DataFrame) -> np.ndarray:
    """Weights by bucket from rows (key, n)."""
    table = histogram.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most _BUCKETS * _BINS rows
    key, n = (table[c].to_numpy() for c in ("key", "n"))
    order = np.argsort(key)
    return fit_weights(key[order] // _BINS, _ratio_of(key[order] % _BINS), n[order])


def lm_scores(spark: SparkSession, docs: DataFrame, held_out: str = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    scratch = Scratch(spark, "lm")
    d = docs.select("doc_id", F.expr(held_out).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = {"spark__sql__execution__arrow__maxRecordsPerBatch": 6000, "spark__sql__execution__arrow__maxBytesPerBatch": BLOCK_BYTES, "spark__sql__files__minPartitionNum": parts, "spark__sql__adaptive__coalescePartitions__enabled": "false"}
    with settings(spark, **blocks):
        answers = scratch.put(to_owners(d.mapInArrow(released(_requests(parts)), "owner int, block long, kind int, hashes binary, counts binary"), parts, "kind").mapInArrow(released(_sum_up), _ANSWER), "answers")
        words = answers.filter("block = -1").groupBy("kind").agg(F.sum("types").alias("v"), F.sum("tokens").alias("n")).toArrow()  # a row for each size of count, binned
        types, tokens = (words[c].to_numpy().astype(float) for c in ("v", "n"))
        kinds, total, starts = int(types.sum()), int(tokens.sum()), d.filter("not held_out").count()
        size = np.sort(tokens / np.maximum(types, 1))
        ratio = (size - 1) / max(total - 1, 1) * (kinds + 1)
        by_size = np.argsort(tokens / np.maximum(types, 1))
        first = fit_weights(np.ones(len(size), np.int64), ratio, tokens[by_size])
        mix = Mix(total, kinds, starts, [first])
        texts = d.mapInArrow(carried, f"block long, kind long, owner long, counts binary, ids array<{kind}>, held array<boolean>, texts array<string>")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("ids", f"array<{kind}>"), ("held", "array<boolean>"), ("texts", "array<string>"))]
        both = texts.unionByName(answers.filter("block <> -1").select("block", "kind", "owner", "counts", *nothing))
        both = both.repartition(parts, "block").sortWithinPartitions("block", F.col("ids").isNull(), "kind", "owner")
        counted = scratch.put(both.mapInArrow(released(_counted(mix)), f"ids array<{kind}>, held array<boolean>, sizes array<int>, one binary, two binary, three binary, key array<long>, n array<long>"), "counted")
    mix.weights.append(_fitted(counted.select(F.explode(F.arrays_zip("key", "n")).alias("x")).select("x.*")))
    table = counted.select("ids", "held", "sizes", *_COUNTS)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=4):
        mix.weights.append(_fitted(table.mapInArrow(_third(mix), "key long, n long")))
        schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return scratch.result(table.mapInArrow(_scored(mix), schema))
