"""Jaccard self-join on word n-gram sets: rare-first prefix filtering with length, positional and suffix filters.

1. A scan task turns its texts into blocks and sends each document's distinct n-gram hashes, sorted and delta-coded, to the owners of
   the hash ranges.  An owner finds the n-grams held by two documents or more and returns only those, with their document counts.
   The block then knows each document's n-grams in rare-first order: those of no other document come first.
2. Documents whose prefix (n - ceil(t n) + 1 rarest n-grams) has an n-gram of another document go on; equal sets go on once.
3. Prefix n-grams are the join keys.  Pairs must pass the length filter, the positional filter, and a suffix filter that compares
   how many n-grams fall in each of 128 hash classes; each pair that passes is compared exactly, once.
4. Two rounds keep large groups of near copies linear: the first compares each document with its closest partner only and joins what
   it links; the second compares all pairs of different components.  Keys with many documents are split into chunks of
   documents, and no two chunks of one component are compared.

Hashes have 64 bits, so an intersection is exact but for hash collisions.

Defined cases: null, empty and blank texts have no set and link with nothing; texts with fewer words than n have one n-gram, the whole;
a null doc_id takes part, and is named only where its whole component is null; repeated rows link like copies; an empty table gives an
empty result; extra columns are ignored.  `docs` must be a deterministic scan (a table).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._blocks import RANGES, range_edges, to_owners
from ._scratch import Scratch, free_name, settings, without
from ._text import Words, grams, inside, mix, planes, released, slices, unplanes
from .components import components

_U = np.uint64
BLOCK_BYTES = 8_000_000
_CLASSES = 128
#: Join keys of more documents are split into blocks of about so many.
_SPLIT = 2048
#: Sides of at most so many rows are broadcast (a row has under 100 bytes).
MOST_BROADCAST = 200_000


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by row then hash: the row and the hash of each distinct n-gram."""
    words = Words(column, lower=True)
    h = words.hashes()
    good = inside(words.doc, n)
    doc, key = words.doc[: len(good)][good], grams(h, n)[good]
    few = np.flatnonzero((words.counts > 0) & (words.counts < n))
    short = []
    for d in few.tolist():
        own = h[words.first[d] : words.first[d + 1]]
        short.append(mix(grams(own, len(own)) ^ (0x632BE59BD9B4E019 + len(own)))[0])
    doc, key = np.concatenate([doc, few]), np.concatenate([key, np.array(short, _U)])
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], key[new]


_ROWS = ["owner", "block", "kind", "ids", "sizes", "h1", "h2", "th", "hashes", "docs", "dfs"]


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int32(), pa.list_(id_type), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], _ROWS)


def _send(parts: int, n: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), BLOCK_BYTES):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                doc, key = shingle_sets(texts, n)
                name = xxhash.xxh3_64_intdigest(repr(ids.to_pylist()).encode() + key.tobytes() + doc.tobytes()) >> 1
                sizes = np.bincount(doc, minlength=len(texts))
                first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
                full = np.flatnonzero(sizes)
                marks = [np.zeros(len(texts), np.int64) for _ in range(2)]
                for m, salted in zip(marks, (key, mix(key ^ _U(0xA5A5A5A5))), strict=True):
                    if len(full):
                        m[full] = mix(np.add.reduceat(salted, first[full])).view(np.int64)
                # Spark's xxhash64(text), by which one_of_each() finds the row again
                own = np.array([xxhash.xxh64_intdigest(t.as_buffer(), 42) for t in texts], _U).view(np.int64)
                rows = [(name % (parts * RANGES), name, 0, ids.to_pylist(), sizes.tolist(), marks[0].tolist(), marks[1].tolist(), own.tolist(), None, None, None)]
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                edges = [0, *np.searchsorted(key, range_edges(parts)).tolist(), len(key)]
                for i, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    if e > s:
                        rows.append((i, name, 1, None, None, None, None, None, planes(np.diff(key[s:e] >> _U(6), prepend=_U(0)), 8), planes(doc[s:e], 3), None))
                yield _batch(rows, ids.type)

    return scan


def _shared(id_type: pa.DataType):
    """Rows sorted by owner: keep what occurs in two documents or more, with its document count."""

    def own(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        mine = [r for r in rows if r[2] == 1]
        out = [r for r in rows if r[2] == 0]
        hashes = [np.cumsum(unplanes(r[8], 8), dtype=_U) for r in mine]
        if hashes:
            _, at, df = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            begin = 0
            for r, h in zip(mine, hashes, strict=True):
                d = df[at[begin : begin + len(h)]]
                begin += len(h)
                keep = d > 1
                # rows without a shared n-gram are sent too: a block can tell that all owners have answered
                out.append((*r[:8], planes(np.diff(h[keep], prepend=_U(0)), 8), planes(unplanes(r[9], 3)[keep], 3), planes(d[keep], 5)))
        yield _batch(out, id_type)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 0):
            yield from own(rows)

    return scan


def _runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Consecutive rows of one value in a column."""
    rows: list[tuple] = []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and r[key] != rows[-1][key]:
                yield rows
                rows = []
            rows.append(r)
    if rows:
        yield rows


_DOCS = ["docno", "doc_id", "n", "h1", "h2", "th", "u", "p", "tokens"]


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * n // 100)


def _assemble(id_type: pa.DataType, percent: int):
    """Rows sorted by block and kind: one row per document, with its shared n-grams in rare-first order where its prefix has one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 1):
            infos = [r for r in rows if r[2] == 0]
            if not infos:
                raise RuntimeError("n-grams came back to no block: the documents must come from a deterministic scan")
            answers = list({r[0]: r for r in rows if r[2] == 1}.values())
            parts = [(np.cumsum(unplanes(r[8], 8), dtype=_U), unplanes(r[9], 3).astype(np.int64), unplanes(r[10], 5).astype(np.int64)) for r in answers]
            h, doc, df = (np.concatenate([p[k] for p in parts] or [np.zeros(0, _U)]) for k in range(3))
            order = np.lexsort((h, df, doc))
            h, doc = h[order], doc[order].astype(np.int64)
            sizes = np.array(infos[0][4], np.int64)
            held = np.bincount(doc, minlength=len(sizes))
            edges = np.concatenate([[0], np.cumsum(held)])
            prefix = np.where(sizes > 0, sizes - _need(sizes, percent) + 1, 0)
            unique = sizes - held
            no = (mix(_U(infos[0][1]) + np.arange(len(sizes), dtype=_U) * _U(0x9E3779B97F4A7C15)) >> _U(1)).astype(np.int64)
            tokens = [h[edges[i] : edges[i + 1]].tobytes() if unique[i] < prefix[i] else None for i in range(len(sizes))]
            for r in infos:
                yield pa.RecordBatch.from_arrays([pa.array(no), pa.array(r[3], id_type), pa.array(sizes), pa.array(r[5], pa.int64()), pa.array(r[6], pa.int64()), pa.array(r[7], pa.int64()), pa.array(unique), pa.array(prefix), pa.array(tokens, pa.binary())], _DOCS)
                tokens = [None] * len(sizes) if len(infos) > 1 else tokens  # an equal block: its documents are named already

    return scan


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, docno, n, u, pos, classes) for each shared n-gram in a prefix; columns in: docno, n, u, p, tokens."""
    for batch in batches:
        if not batch.num_rows:
            continue
        docno, n, u, p = (batch.column(k).to_numpy() for k in range(4))
        sets = [np.frombuffer(t.as_buffer(), np.int64) for t in batch.column(4)]
        held = p - u
        row = np.repeat(np.arange(len(held)), held)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held) + u[row]
        classes = np.stack([np.minimum(np.bincount((h >> 9) % _CLASSES, minlength=_CLASSES), 255) for h in sets]).astype(np.uint8)
        each = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_CLASSES), len(sets), [None, pa.py_buffer(classes)]).cast(pa.binary())
        tokens = np.concatenate([h[:k] for h, k in zip(sets, held.tolist(), strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(docno[row]), pa.array(n[row]), pa.array(u[row]), pa.array(pos), each.take(pa.array(row))], ["token", "docno", "n", "u", "pos", "classes"])


def _candidates(percent: int, closest: bool):
    """Rows sorted by (token, a, b), of columns token, a, b, side, docno, n, u, pos, classes, label: pairs that pass the filters.

    closest: for each document only the partner of least difference; else all pairs of different labels.  Blocks a < b are compared
    with each other (side tells a row's), blocks a = b within themselves."""

    def pairs(r: dict[str, np.ndarray], cross: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n, pos, u, classes, label, side = r["n"], r["pos"], r["u"], r["classes"], r["label"], r["side"]
        order = np.lexsort((r["docno"], n))
        for s in range(0, len(order), 256):
            i = order[s : s + 256]
            x, y = np.meshgrid(np.arange(s, s + len(i)), np.arange(s + len(i)), indexing="ij")
            ok = (y < x) & (100 * n[order[y]] >= percent * n[order[x]])
            x, y = order[x[ok]], order[y[ok]]
            need = -(-percent * (n[x] + n[y]) // (100 + percent))
            ok = (1 + np.minimum(n[x] - pos[x], n[y] - pos[y]) - 1 >= need) & (x != y)
            ok &= (label[x] != label[y]) if not closest else (r["docno"][x] != r["docno"][y])
            if cross:
                ok &= side[x] != side[y]
            x, y, need = x[ok], y[ok], need[ok]
            for k in range(0, len(x), 50_000):
                p, q = x[k : k + 50_000], y[k : k + 50_000]
                apart = np.abs(classes[p].astype(np.int16) - classes[q]).sum(axis=1, dtype=np.int64) + u[p] + u[q]
                ok = apart <= n[p] + n[q] - 2 * need[k : k + 50_000]
                p, q, apart = p[ok], q[ok], apart[ok]
                if closest and len(p):
                    by = np.lexsort((apart, p))
                    p, q = p[by], q[by]
                    first = np.ones(len(p), bool)
                    first[1:] = p[1:] != p[:-1]
                    p, q = p[first], q[first]
                yield r["docno"][p], r["docno"][q]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            held = [b for b in (rest, batch) if b is not None and b.num_rows]
            if not held:
                continue
            table = pa.Table.from_batches(held)
            table = table.combine_chunks()
            keys = np.column_stack([table[c].to_numpy() for c in ("token", "a", "b")])
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cut.tolist()] + ([len(keys)] if batch is None else [])
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if e - s < 2:
                    continue
                part = table.slice(s, e - s)
                r = {c: part[c].to_numpy() for c in ("side", "docno", "n", "u", "pos", "label")}
                r["classes"] = np.frombuffer(b"".join(part["classes"].to_pylist()), np.uint8).reshape(-1, _CLASSES)
                for x, y in pairs(r, bool(keys[s, 1] != keys[s, 2])):
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            left = table.slice(edges[-1] if batch is not None else len(keys)).combine_chunks()
            rest = left.to_batches()[0] if left.num_rows else None

    return scan


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _linked(percent: int):
    """Columns a, b, na, nb, ta, tb: the pairs whose sets are similar enough."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                na, nb = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.int64) for k in (4, 5))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (na + nb - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return scan


def _links(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    pairs = pairs.distinct()
    side = lambda x: reps.select(F.col("docno").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ta", "tb").mapInArrow(_linked(percent), "a long, b long")


def jaccard_components(spark: SparkSession, docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every document, and docno, one number for each document, th, Spark's xxhash64 of its text, and first: whether it is the one to keep of its component (least doc_id, then docno)."""
    scratch = Scratch(spark, "jaccard")
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = f"owner int, block long, kind int, ids array<{kind}>, sizes array<int>, h1 array<long>, h2 array<long>, th array<long>, hashes binary, docs binary, dfs binary"
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=6000, spark__sql__execution__arrow__maxBytesPerBatch=BLOCK_BYTES, spark__sql__files__minPartitionNum=parts, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sent = docs.select("doc_id", "text").mapInArrow(released(_send(parts, n)), rows)
        shared = to_owners(sent, parts).mapInArrow(released(_shared(id_type)), rows)
        whole = shared.repartition(parts, "block").sortWithinPartitions("block", "kind").mapInArrow(released(_assemble(id_type, percent)), f"docno long, doc_id {kind}, n long, h1 long, h2 long, th long, u long, p long, tokens binary")
        whole = scratch.put(whole, "documents")
        active = whole.filter("tokens is not null")
        # a table of its own on each side of a join lets adaptive execution split a key that many rows share
        least = scratch.put(active.groupBy("h1", "h2", "n").agg(F.min("docno").alias("rep")), "equal")
        same = scratch.put(active.select("docno", "h1", "h2", "n").join(least, ["h1", "h2", "n"]).select("docno", "rep"), "same")
        reps = scratch.put(active.join(same.filter("docno = rep").select("docno"), "docno", "left_semi").select("docno", "n", "u", "p", "tokens"), "reps")
        posts = scratch.put(reps.mapInArrow(_postings, "token long, docno long, n long, u long, pos long, classes binary"), "postings")
        many = scratch.put(posts.groupBy("token").agg(F.count("*").alias("_m")).filter("_m > 1"), "many")
        posts = scratch.put(posts.join(many, "token"), "postings")

        columns = ["token", "a", "b", "side", "docno", "n", "u", "pos", "classes", "label"]
        chunk = F.pmod(F.xxhash64("docno"), F.ceil(F.col("_m") / _SPLIT)).cast("long")
        near = posts.withColumn("a", chunk).withColumn("b", chunk).withColumn("side", F.lit(0).cast("long")).withColumn("label", F.col("docno"))
        near = near.select(columns).repartition(parts, "token", "a").sortWithinPartitions("token", "a").mapInArrow(released(_candidates(percent, True)), "a long, b long")
        first = scratch.put(_links(near, reps, percent), "links")
        comps = components(first, scratch, "first")

        labelled = posts.join(comps, posts["docno"] == comps["node"], "left").withColumn("label", F.coalesce("comp", "docno"))
        labelled = scratch.put(labelled.select("token", "docno", "n", "u", "pos", "classes", "label", "_m"), "labelled")
        rest = _chunk_pairs(labelled, scratch)
        rest = rest.select(columns).repartition(parts, "token", "a", "b").sortWithinPartitions("token", "a", "b").mapInArrow(released(_candidates(percent, False)), "a long, b long")
        second = scratch.put(_links(rest, reps, percent), "links")
        joined = comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(second)
        comps = components(joined, scratch, "second")

        of_doc = same.join(comps, same["rep"] == comps["node"], "left").select(F.col("docno").alias("_no"), F.coalesce("comp", "rep").alias("_comp")).distinct()
        named = whole.select("docno", "doc_id", "th", F.col("n").alias("n_shingles"))
        named = named.join(of_doc, named["docno"] == of_doc["_no"], "left").drop("_no")
        inner = scratch.put(named, "named")
        least = inner.filter("_comp is not null").groupBy("_comp").agg(F.min("doc_id").alias("_least"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "docno")).alias("_best"))
        least = scratch.put(least, "least")
        # documents without a link need no join; with it they would all meet in the task of the null key
        alone = inner.filter("_comp is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "docno", "th", F.lit(True).alias("first"))
        linked = inner.filter("_comp is not null").join(least, "_comp").select("doc_id", "n_shingles", F.col("_least").alias("component_id"), "docno", "th", (F.col("_best.docno") == F.col("docno")).alias("first"))
        out = alone.unionByName(linked)
        return scratch.result(out)


def _chunk_pairs(labelled: DataFrame, scratch: Scratch) -> DataFrame:
    """The postings of tokens that documents of several labels hold, once for each pair (a, b) of chunks to compare; side tells a row's own.

    A label with many documents of a token has chunks of its own there, the others are dealt out by label; two chunks of one and the
    same label are not compared, so a large group of linked documents costs as many rows as there are chunks of others."""
    counts = scratch.put(labelled.groupBy("token", "label").agg(F.count("*").alias("_c")), "label-counts")
    mixed = scratch.put(counts.groupBy("token").agg(F.count("*").alias("_labels")).filter("_labels > 1").select("token"), "mixed")
    # one join of the postings both drops tokens of one label and brings the label's count
    rest = labelled.join(scratch.put(counts.join(mixed, "token"), "mixed-counts"), ["token", "label"])
    large = F.col("_c") > _SPLIT // 2
    chunk = F.when(large, F.xxhash64(F.lit("one"), "label", F.pmod(F.xxhash64("docno"), F.ceil(F.col("_c") / _SPLIT)))).otherwise(F.xxhash64(F.lit("some"), F.pmod(F.xxhash64("label"), F.ceil(F.col("_m") / _SPLIT))))
    rest = scratch.put(rest.withColumn("side", chunk), "chunked")
    chunks = scratch.put(rest.groupBy("token", "side").agg(F.min("label").alias("low"), F.max("label").alias("high")), "chunks")
    x, y = (chunks.select("token", *[F.col(c).alias(f"{k}{c}") for c in ("side", "low", "high")]) for k in ("x", "y"))
    one_label = (F.col("xlow") == F.col("xhigh")) & (F.col("ylow") == F.col("yhigh")) & (F.col("xlow") == F.col("ylow"))
    pairs = scratch.put(x.join(y, "token").filter((F.col("xside") <= F.col("yside")) & ~one_label).select("token", F.col("xside").alias("a"), F.col("yside").alias("b")), "pairs")
    # each row goes to every pair that its chunk is in
    ends = pairs.select("token", "a", "b", F.col("a").alias("side")).union(pairs.filter("a <> b").select("token", "a", "b", F.col("b").alias("side")))
    return rest.join(scratch.put(ends, "ends"), ["token", "side"])


def one_of_each(spark: SparkSession, docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The documents without those that link with an earlier one, with all their columns; of rows equal in doc_id and text one stays."""
    found = jaccard_components(spark, docs, n, percent)
    scratch = Scratch(spark, "one-of-each")
    rows = found.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("_id"), F.col("th").alias("_h")).agg(F.max("first").alias("stays"), F.count("*").alias("rows"))
    rows = scratch.put(rows.filter("not stays or rows > 1"), "rows")
    few = lambda df: df.count() <= MOST_BROADCAST
    gone, again = rows.filter("not stays"), rows.filter("stays")
    kept = without(spark, docs, gone, few(gone))
    if again.isEmpty():
        return kept
    k, h = free_name(docs, "_again_id"), free_name(docs, "_again_h")
    again = again.select(F.col("_id").alias(k), F.col("_h").alias(h))
    again = F.broadcast(again) if few(again) else again
    own = (F.coalesce(kept["doc_id"].cast("string"), F.lit("-")) == F.col(k)) & (F.xxhash64(kept["text"]) == F.col(h))
    return kept.join(again, own, "left_anti").unionByName(kept.join(again, own, "left_semi").dropDuplicates(["doc_id", "text"]))
