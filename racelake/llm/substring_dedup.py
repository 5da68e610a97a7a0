"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is `size` consecutive words.  Its minimiser is the least hash of its runs of _RUN words; consecutive windows of one minimiser
form a super-k-mer.

1. Each block of texts sends the minimisers of its super-k-mers to the owners of their hash ranges.  A minimiser that occurs once in
   all documents cannot belong to a repeated window, so only super-k-mers with a repeated one go on.
2. Those travel as packed strings (their words, one space between) to the bucket of their minimiser; equal strings are added up first.
   A bucket is sorted by window, and windows that occur twice or more are marked.
3. Minimisers with very many different super-k-mers (a passage in many documents, large groups of near copies) are counted window by
   window instead, added up before the shuffle, so that no bucket holds them.
4. Marks go back to the documents they come from; covered words are removed.

Windows are compared by two independent hashes of their words, 128 bits.

Defined cases: null, empty and short texts keep all their words; repeated rows are copies of each other; null ids stay; an empty table
gives an empty result; extra columns are ignored.  `docs` must be a deterministic scan (a table).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._blocks import BLOCK_BYTES, carried, parts_of, range_edges, to_owners
from ._scratch import Scratch, settings
from ._text import Words, grams, inside, mix, planes, released, unplanes

_U = np.uint64
_RUN = 8
#: Minimisers of more different super-k-mers are counted by window.
_MANY = 2000
#: Hit lists of at most so many rows are broadcast (a row has two hashes and some tens of offsets).
MOST_BROADCAST = 50_000


def super_kmers(words: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window (as an index of words), number of windows and minimiser of each super-k-mer of a block."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    low, held = grams(h, _RUN), 1
    span = size - _RUN + 1
    while held < span:
        step = min(held, span - held)
        low, held = np.minimum(low[:-step], low[step:]), held + step
    at = np.flatnonzero(inside(words.doc, size))
    low, doc = low[at], words.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), low[first]


def _own_repeats(g: np.ndarray, at: np.ndarray, n: np.ndarray, low: np.ndarray, size: int) -> np.ndarray:
    """The super-k-mers in which the minimiser stands at two places or more."""
    if not len(at):
        return at
    held = n + size - _RUN
    begin = np.cumsum(held) - held
    where = np.arange(int(held.sum())) + np.repeat(at - begin, held)
    return np.flatnonzero(np.add.reduceat((g[where] == np.repeat(low, held)).astype(np.int64), begin) > 1)


def _send(parts: int, size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, _, _, texts in parts_of(batch):
                words = Words(texts)
                h = words.hashes()
                at, n, low = super_kmers(words, h, size)
                # a minimiser found at two places of one super-k-mer (periodic text) repeats by itself: it is sent twice
                twice = _own_repeats(grams(h, _RUN), at, n, low, size)
                nth = np.concatenate([np.arange(len(low)), twice])
                low = np.concatenate([low, low[twice]])
                order = np.argsort(low, kind="stable")
                low, nth = low[order], nth[order]
                edges = [0, *np.searchsorted(low, range_edges(parts)).tolist(), len(low)]
                rows = [(i, name, planes(np.diff(low[s:e], prepend=_U(0)), 8), planes(nth[s:e], 4)) for i, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if e > s]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["owner", "block", "low", "nth"])

    return scan


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by owner: for each block the super-k-mers whose minimiser occurs again."""

    def own(rows: list[tuple]) -> pa.RecordBatch:
        low = [np.cumsum(unplanes(r[2], 8), dtype=_U) for r in rows]
        _, at, n = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
        out, begin = [], 0
        for r, x in zip(rows, low, strict=True):
            keep = n[at[begin : begin + len(x)]] > 1
            begin += len(x)
            out.append((r[1], 0, int(r[0]), planes(unplanes(r[3], 4)[keep], 4)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["block", "kind", "owner", "counts"])

    rows: list[tuple] = []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and rows[-1][0] != r[0]:
                yield own(rows)
                rows = []
            rows.append(r)
    if rows:
        yield own(rows)


_SPLIT = ["docno", "doc_id", "n_words", "sha", "text", "low", "own", "start", "packed"]


def _split(id_type: pa.DataType, size: int):
    """Rows sorted by block, texts (kind 2) first: one row per document (with its words where it has marked super-k-mers, else with its result), and one per marked super-k-mer."""

    def block(name: int, rows: list[tuple], answers: list[bytes]) -> Iterator[pa.RecordBatch]:
        marked = np.unique(np.concatenate([unplanes(a, 4) for a in answers] or [np.zeros(0, _U)]).astype(np.int64))
        for ids, texts in rows:
            words = Words(texts)
            at, n, low = super_kmers(words, words.hashes(), size)
            if len(marked) and marked[-1] >= len(at):
                raise RuntimeError("super-k-mers came back to another block: the documents must come from a deterministic scan")
            docno = (mix(_U(name) + np.arange(words.rows, dtype=_U) * _U(0x9E3779B97F4A7C15)) >> _U(1)).astype(np.int64)
            touched = np.zeros(words.rows, bool)
            touched[words.doc[at[marked]]] = True
            shas, plain = [], []
            for i in range(words.rows):
                text = words.spaced(words.first[i], words.first[i + 1])
                shas.append(None if touched[i] else hashlib.sha256(text).hexdigest())
                plain.append(text if touched[i] else None)
            none = lambda k, t: pa.nulls(k, t)
            yield pa.RecordBatch.from_arrays([pa.array(docno), ids, pa.array(words.counts.astype(np.int64)), pa.array(shas, pa.string()), pa.array(plain, pa.binary()), *(none(words.rows, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], _SPLIT)
            if len(marked):
                doc = words.doc[at[marked]]
                packed = [words.spaced(a, a + k + size - 1) for a, k in zip(at[marked].tolist(), n[marked].tolist(), strict=True)]
                own = np.array([int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little", signed=True) for p in packed], np.int64)
                m = len(marked)
                yield pa.RecordBatch.from_arrays([pa.array(docno[doc]), none(m, id_type), none(m, pa.int64()), none(m, pa.string()), none(m, pa.binary()), pa.array(low[marked].view(np.int64)), pa.array(own), pa.array(at[marked] - words.first[doc]), pa.array(packed, pa.binary())], _SPLIT)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, answers = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                at = batch.column(0)[i].as_py()
                if at != name:
                    if rows:
                        yield from block(name, rows, list(answers.values()))
                    name, rows, answers = at, [], {}
                if batch.column(1)[i].as_py() == 2:
                    rows.append((batch.column(4)[i].values, batch.column(6)[i].values))
                else:
                    answers[batch.column(2)[i].as_py()] = batch.column(3)[i].as_py()
        if rows:
            yield from block(name, rows, list(answers.values()))

    return scan


def _windows(packed: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset and two hashes of each window of packed strings."""
    words = Words(packed.cast(pa.binary()))
    good = np.flatnonzero(inside(words.doc, size))
    one, two = (grams(words.hashes(seed), size)[good] for seed in (1, 2))
    return words.doc[good], good - words.first[words.doc[good]], one, two


def _counted(size: int):
    """Rows sorted by low, of columns low, own, times, packed: the offsets of the windows of each super-k-mer that occur twice or more in the bucket."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            held = [b for b in (rest, batch) if b is not None and b.num_rows]
            if not held:
                continue
            table = pa.Table.from_batches(held)
            low = table["low"].to_numpy()
            end = len(low) if batch is None else int(np.flatnonzero(low != low[-1])[-1]) + 1 if (low != low[-1]).any() else 0
            left = table.slice(end).combine_chunks()
            rest = left.to_batches()[0] if left.num_rows else None
            part = table.slice(0, end).combine_chunks()
            if not end:
                continue
            row, offset, one, two = _windows(part["packed"].combine_chunks() if part["packed"].num_chunks != 1 else part["packed"].chunk(0), size)
            times = part["times"].to_numpy()[row]
            # a bucket is one minimiser; equal windows have equal minimisers, so the hashes alone sort the windows of many buckets
            order = np.lexsort((two, one))
            one, two = one[order], two[order]
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            group = np.cumsum(new) - 1
            again = np.bincount(group, weights=times[order].astype(float)) > 1
            hit = np.zeros(len(row), bool)
            hit[order] = again[group]
            row, offset = row[hit], offset[hit]
            if len(row):
                rows, begin = np.unique(row, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)), pa.int32()), pa.array(offset.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part["low"].combine_chunks().take(pa.array(rows)), part["own"].combine_chunks().take(pa.array(rows)), lists], ["low", "own", "offsets"])

    return scan


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _each_window(size: int):
    """Columns low, own, times, packed: a row for each window."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, offset, one, two = _windows(batch.column(3), size)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(3)), pa.array(offset.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], ["low", "own", "times", "offset", "one", "two"])

    return scan


def _removed(size: int):
    """Columns doc_id, n_words, text, spots (starts of repeated windows): the kept words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, shas = [], []
            for n, text, spots in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                words = text.split(b" ")
                drop = np.zeros(n + 1, np.int64)
                starts = np.unique(np.array(spots or [], np.int64))
                drop[starts] += 1
                np.add.at(drop, starts + size, -1)
                keep = np.cumsum(drop)[:n] == 0
                gone.append(int(n - keep.sum()))
                shas.append(hashlib.sha256(b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return scan


def remove_repeats(spark: SparkSession, docs: DataFrame, size: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    from pyspark.sql.pandas.types import to_arrow_type

    scratch = Scratch(spark, "repeats")
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    d = docs.select("doc_id", F.lit(False).alias("held_out"), "text")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=6000, spark__sql__execution__arrow__maxBytesPerBatch=BLOCK_BYTES, spark__sql__files__minPartitionNum=parts, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sent = d.mapInArrow(released(_send(parts, size)), "owner int, block long, low binary, nth binary")
        answers = to_owners(sent, parts).mapInArrow(released(_repeated), "block long, kind long, owner long, counts binary")
        texts = d.mapInArrow(carried, f"block long, kind long, owner long, counts binary, ids array<{kind}>, held array<boolean>, texts array<string>")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("ids", f"array<{kind}>"), ("held", "array<boolean>"), ("texts", "array<string>"))]
        both = texts.unionByName(answers.select("*", *nothing)).repartition(parts, "block").sortWithinPartitions("block", F.desc("kind"))
        split = scratch.put(both.mapInArrow(released(_split(id_type, size)), f"docno long, doc_id {kind}, n_words long, sha string, text binary, low long, own long, start long, packed binary"), "split")
        kmers = split.filter("packed is not null")
        different = scratch.put(kmers.groupBy("low", "own").agg(F.count("*").alias("times"), F.first("packed").alias("packed")), "different")
        by_low = different.groupBy("low").agg(F.count("*").alias("_n"))
        many = scratch.put(by_low.filter(F.col("_n") > _MANY).select("low"), "many")
        few = different.join(many, "low", "left_anti").select("low", "own", "times", "packed")
        hits = few.repartition(parts, "low").sortWithinPartitions("low").mapInArrow(_counted(size), "low long, own long, offsets array<int>")
        single = different.join(many, "low", "left_semi").select("low", "own", "times", "packed").mapInArrow(_each_window(size), "low long, own long, times long, offset int, one long, two long")
        single = scratch.put(single, "windows")
        # a table of its own on each side of a join lets adaptive execution split a key that many rows share
        again = scratch.put(single.groupBy("one", "two").agg(F.sum("times").alias("_t")).filter("_t > 1").select("one", "two"), "again")
        single = single.join(again, ["one", "two"]).groupBy("low", "own").agg(F.collect_list("offset").alias("offsets"))
        hits = scratch.put(hits.unionByName(single), "hits")
        hits = F.broadcast(hits) if hits.count() <= MOST_BROADCAST else hits
        spots = kmers.select("docno", "low", "own", "start").join(hits, ["low", "own"]).select("docno", F.expr("transform(offsets, x -> start + x)").alias("_s"))
        spots = spots.groupBy("docno").agg(F.flatten(F.collect_list("_s")).alias("spots"))
        whole = split.filter("packed is null")
        touched = whole.filter("text is not null").select("docno", "doc_id", "n_words", "text").join(spots, "docno", "left").select("doc_id", "n_words", "text", "spots")
        touched = touched.mapInArrow(_removed(size), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
        rest = whole.filter("text is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
        return scratch.result(rest.unionByName(touched))
