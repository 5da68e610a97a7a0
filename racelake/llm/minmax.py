"""Near-duplicate documents by min-max hashing: exact links over shingle sets, candidates by banded minima and maxima.

1. A scan reduces each document to its set of word shingles.  Each of _PERMUTATIONS permutations of the shingles' hashes gives two
   values, the least and the greatest shingle under it, so that 64 passes over a set give a signature of 128.  Both agree between two
   sets with a chance of their Jaccard similarity; a minimum and a maximum of one permutation meet different shingles, which makes the
   share of agreeing values a less scattered estimate than that of as many minima.  Bands have four values of different permutations.
2. Equal sets are one node from here on.  Two nodes are compared where they share a band: at a similarity of 0.85 all of 32 bands differ
   for 6 pairs in 10^11.  The comparison counts agreeing values of the signature (a byte each); under _LEAST of 128 is dropped, which
   hits 1 in 10^12 pairs at 0.85.  What passes is verified on the full sets, which a second scan makes for the nodes that need them.
3. Two rounds keep large groups linear: the first compares each node only with the most alike of those before it (in order of size),
   which links a group to one component; the second compares nodes of different components.  Bands with many nodes are split into
   chunks, and no two chunks of one component are compared, so no task holds a group.
4. Groups whose texts are alike, but mostly below the threshold, have many pairs that a signature of 128 cannot tell from links.  The nodes of
   the second round get a longer one, a bit for each of _BITS values; what agrees in fewer bits than _LEAST_BITS (about 0.81) is dropped in
   place, which hits 1 in 10^12 pairs at 0.85.  A pair that shares several bands is passed on by the first of them alone.

Hashes of shingles and the two digests of a set have 64 bits each; links are exact but for their collisions and the chances above, which
apply to links of 0.85 or more (`percent`); for lower thresholds more bands would be needed, so they are refused.

Defined cases: null, empty and blank texts have no set and link with nothing; texts with fewer words than n have one shingle, the whole; a
null doc_id takes part, and is named only where its whole component is null; repeated rows link like copies; very long texts are taken
whole; an empty table gives an empty result; extra columns are ignored, whatever their names.  `docs` must be a deterministic scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._scratch import Scratch, settings
from ._text import mix, released, slices
from .components import components
from .ngram_join import _SPLIT, MOST_BROADCAST, _chunk_pairs, _links, _with_end, shingle_sets

_U = np.uint64
BLOCK_BYTES = 4_000_000
_PERMUTATIONS, _ROWS = 64, 4
_VALUES = 2 * _PERMUTATIONS
#: Bands that the first round compares in: one in so many.
_FIRST = 4
_LEAST = 76
_LOWEST_PERCENT = 85
#: The second round's signatures: bits of as many values, and how many agree at least.
_BITS, _LEAST_BITS = 8192, 7400
_SEEDS = mix(np.arange(1, _BITS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
#: Permutations of 32 bits: x -> (x ^ r) * a, a odd.
_XOR, _ODD = (_SEEDS >> _U(32)).astype(np.uint32), _SEEDS.astype(np.uint32) | np.uint32(1)


def _extremes(key: np.ndarray, first: np.ndarray, permutations: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The least and the greatest value of each set (its hashes start at `first`, none empty) under one permutation after another."""
    small = (key >> _U(32)).astype(np.uint32)
    for k in range(permutations):
        x = (small ^ _XOR[k]) * _ODD[k]
        yield np.minimum.reduceat(x, first), np.maximum.reduceat(x, first)


def signatures(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set the least value under each permutation, then the greatest ones."""
    out = np.empty((len(first), _VALUES), np.uint32)
    if len(first):
        for k, (low, high) in enumerate(_extremes(key, first, _PERMUTATIONS)):
            out[:, k], out[:, _PERMUTATIONS + k] = low, high
    return out


def bit_signatures(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set a bit of each of _BITS values, as _BITS / 64 numbers."""
    out = np.zeros((len(first), _BITS // 64), _U)
    if len(first):
        for k, ends in enumerate(_extremes(key, first, _BITS // 2)):
            for side, x in enumerate(ends):
                bit = (x * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(_U)
                out[:, (2 * k + side) // 64] |= bit << _U((2 * k + side) % 64)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash of each band of four values, all minima or all maxima."""
    wide = signature.astype(_U).reshape(len(signature), -1, _ROWS)
    h = np.broadcast_to(np.arange(1, wide.shape[1] + 1, dtype=_U) * _U(0xD6E8FEB86659FD93), wide.shape[:2])
    for k in range(_ROWS):
        h = mix(h ^ wide[:, :, k]) * _U(0x9FB21C651E98DF25)
    return mix(h)


def _sketched(n: int):
    """doc_id, th (Spark's xxhash64 of the text), n, two digests of the set, its bands, and the signature's bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), BLOCK_BYTES):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                doc, key = shingle_sets(texts, n)
                sizes = np.bincount(doc, minlength=len(texts))
                full = np.flatnonzero(sizes)
                first = (np.cumsum(sizes) - sizes)[full]
                marks = [np.zeros(len(texts), np.int64) for _ in range(2)]
                for m, salted in zip(marks, (key, mix(key ^ _U(0xA5A5A5A5))), strict=True):
                    if len(full):
                        m[full] = mix(np.add.reduceat(salted, first)).view(np.int64)
                own = np.array([xxhash.xxh64_intdigest(t.as_buffer(), 42) for t in texts], _U).view(np.int64)
                values = signatures(key, first)
                tokens = bands(values).view(np.int64)
                lengths = np.zeros(len(texts) + 1, np.int32)
                lengths[1:][full] = tokens.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(tokens.ravel()))
                sketch = np.zeros((len(texts), _VALUES), np.uint8)
                sketch[full] = (values * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                each = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_VALUES), len(texts), [None, pa.py_buffer(sketch)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([ids, pa.array(own), pa.array(sizes.astype(np.int64)), pa.array(marks[0]), pa.array(marks[1]), lists, each], ["doc_id", "th", "n", "h1", "h2", "bands", "sketch"])

    return scan


def alike(sketch: np.ndarray, x: np.ndarray, y: slice) -> np.ndarray:
    """Agreeing values of rows x with rows y of sketches laid out value by value."""
    out = np.zeros((len(x), y.stop - y.start), np.uint8)
    for values in sketch:
        out += values[x][:, None] == values[None, y]
    return out


def bits_alike(bits: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Agreeing bits of rows x with rows y, one pair each."""
    out = np.empty(len(x), np.int64)
    for s in range(0, len(x), 10_000):
        out[s : s + 10_000] = _BITS - np.bitwise_count(bits[x[s : s + 10_000]] ^ bits[y[s : s + 10_000]]).sum(axis=1, dtype=np.int64)
    return out


def _compared(percent: int, closest: bool):
    """Rows sorted by (token, a, b), of columns token, a, b, side, docno, n, label, sketch and, but for closest, bits and bands: pairs (x, y, alike) that share a band and look similar.

    closest: for each node the most alike of those before it in order of size; else all pairs of different labels.  Chunks a < b are
    compared with each other (side tells a row's), a chunk a = b within itself."""

    def pairs(node: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, sketch: np.ndarray, bits: np.ndarray, bands: np.ndarray, token: int, cross: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        order = np.lexsort((node, n))
        node, n, label, side, sketch, bits, bands = node[order], n[order], label[order], side[order], np.ascontiguousarray(sketch[order].T), bits[order], bands[order]
        for s in range(0, len(node), 256):
            x = np.arange(s, min(s + 256, len(node)))
            low = int(np.searchsorted(n, -(-percent * n[s] // 100)))
            same = alike(sketch, x, slice(low, int(x[-1]) + 1))
            y = np.arange(low, int(x[-1]) + 1)
            ok = (y[None, :] < x[:, None]) & (100 * n[y][None, :] >= percent * n[x][:, None]) & (same >= _LEAST)
            if closest:
                at = np.where(ok, same, 0).argmax(axis=1)
                good = ok[np.arange(len(x)), at]
                i, j = np.flatnonzero(good), at[good]
            else:
                ok &= label[x][:, None] != label[y][None, :]
                if cross:
                    ok &= side[x][:, None] != side[y][None, :]
                i, j = np.nonzero(ok)
                good = bits_alike(bits, x[i], y[j]) >= _LEAST_BITS
                i, j = i[good], j[good]
                # nodes of different labels meet in each band that they share
                shared = bands[x[i]] == bands[y[j]]
                good = bands[x[i], shared.argmax(axis=1)] == token
                i, j = i[good], j[good]
            if len(i):
                yield node[x[i]], node[y[j]], same[i, j].astype(np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            held = [b for b in (rest, batch) if b is not None and b.num_rows]
            if not held:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.column_stack([table[c].to_numpy() for c in ("token", "a", "b")])
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cut.tolist()] + ([len(keys)] if batch is None else [])
            found = []
            columns = [table[c].to_numpy() for c in ("docno", "n", "label", "side")]
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, _VALUES)
            bits = np.zeros((len(keys), 0), _U) if closest else np.frombuffer(b"".join(table["bits"].to_pylist()), _U).reshape(-1, _BITS // 64)
            tokens = np.zeros((len(keys), 0), np.int64) if closest else table["bands"].combine_chunks().flatten().to_numpy().reshape(len(keys), -1)
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if e - s > 1:
                    found += pairs(*(c[s:e] for c in columns), sketch[s:e], bits[s:e], tokens[s:e], int(keys[s, 0]), bool(keys[s, 1] != keys[s, 2]))
                if sum(len(f[0]) for f in found) > 50_000 or e == edges[-1] and found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in range(3)], ["x", "y", "alike"])
                    found = []
            left = table.slice(edges[-1] if batch is not None else len(keys)).combine_chunks()
            rest = left.to_batches()[0] if left.num_rows else None

    return scan


def _of_nodes(n: int, whole: bool):
    """Columns node, text: of each node, once a task, the whole set (docno, n, tokens) or the bits of its longer signature."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            new = []
            for i, x in enumerate(batch.column(0).to_pylist()):
                if x not in done:
                    done.add(x)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            at = 0
            for texts in slices(batch.column(1), BLOCK_BYTES):
                doc, key = shingle_sets(texts, n)
                sizes = np.bincount(doc, minlength=len(texts))
                ends = np.cumsum(sizes)
                if whole:
                    made = [key[e - k : e].tobytes() for e, k in zip(ends.tolist(), sizes.tolist(), strict=True)]
                else:
                    made = [x.tobytes() for x in bit_signatures(key, ends - sizes)]  # nodes have no empty sets
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(sizes), pa.array(made, pa.binary())], ["docno", "n", "tokens"])
                at += len(texts)

    return scan


def _name(c: str = "doc_id"):
    return F.coalesce(F.col(c).cast("string"), F.lit("-"))


def near_duplicates(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that links reach) and kept (whether that is the document itself) of every document."""
    if percent < _LOWEST_PERCENT:
        raise ValueError(f"the bands find links of {_LOWEST_PERCENT} % and more")
    scratch = Scratch(spark, "minmax")
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    d = docs.select("doc_id", "text")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=6000, spark__sql__execution__arrow__maxBytesPerBatch=BLOCK_BYTES, spark__sql__files__minPartitionNum=parts):
        whole = scratch.put(d.mapInArrow(released(_sketched(n)), f"doc_id {kind}, th long, n long, h1 long, h2 long, bands array<long>, sketch binary"), "documents")
        least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th"))
        nodes = whole.filter("n > 0").groupBy("h1", "h2", "n").agg(least.alias("_least"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.count("*").alias("docs"))
        nodes = scratch.put(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        posts = nodes.select("node", F.posexplode("bands").alias("band", "token"))
        # a table of its own on each side of a join lets adaptive execution split a key that many rows share
        many = scratch.put(posts.groupBy("token").agg(F.count("*").alias("_m")).filter("_m > 1"), "many")
        posts = scratch.put(posts.join(many, "token"), "postings")
        sketches = nodes.select(F.col("node").alias("_node"), "n", "sketch", "bands")

        columns = ["token", "a", "b", "side", "docno", "n", "label", "sketch"]
        # dealt anew for each band, so that the chunks of one band are joined by those of another
        chunk = F.pmod(F.xxhash64("token", "node"), F.ceil(F.col("_m") / _SPLIT)).cast("long")
        near = posts.filter(F.col("band") % _FIRST == 0).select("token", chunk.alias("a"), F.col("node").alias("docno"))
        near = near.join(sketches.drop("bands"), near["docno"] == sketches["_node"]).withColumns({"b": F.col("a"), "side": F.lit(0).cast("long"), "label": F.col("docno")})
        near = near.select(columns).repartition(parts, "token", "a").sortWithinPartitions("token", "a").mapInArrow(released(_compared(percent, True)), "x long, y long, alike long")
        near = near.groupBy("x").agg(F.max(F.struct("alike", "y")).alias("_y")).select(F.col("x").alias("a"), F.col("_y.y").alias("b"))
        first = _verified(scratch, d, nodes, scratch.put(near, "near"), n, percent)
        comps = components(first, scratch, "first")

        labelled = posts.join(comps, posts["node"] == comps["node"], "left").select("token", posts["node"].alias("docno"), F.coalesce("comp", posts["node"]).alias("label"), "_m")
        rest = _chunk_pairs(scratch.put(labelled, "labelled"), scratch)
        bits = _from_texts(scratch, d, nodes, rest.select(F.col("docno").alias("a")).distinct(), n, False).select(F.col("docno").alias("_node"), F.col("tokens").alias("bits"))
        longer = scratch.put(sketches.join(bits.dropDuplicates(["_node"]), "_node"), "signatures")
        rest = rest.join(longer, rest["docno"] == longer["_node"])
        rest = rest.select(*columns, "bits", "bands").repartition(parts, "token", "a", "b").sortWithinPartitions("token", "a", "b").mapInArrow(released(_compared(percent, False)), "x long, y long, alike long")
        rest = scratch.put(rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "rest")
        second = _verified(scratch, d, nodes, rest, n, percent)
        comps = components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).filter("a <> b").union(second), scratch, "second")

        # documents of a node alone in its component need no join
        of_node = nodes.select("node", "h1", "h2", "n", "docs", "_least").join(comps.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").filter("docs > 1 or comp is not null")
        of_node = scratch.put(of_node.select("h1", "h2", "n", F.coalesce("comp", "node").alias("comp"), F.col("_least.doc_id").alias("_doc")), "linked")
        names = scratch.put(of_node.groupBy("comp").agg(F.min("_doc").alias("_id")), "least")
        named = scratch.put(of_node.join(names, "comp").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("n").alias("_n"), "_id", F.lit(True).alias("_linked")), "named")
        inner = whole.select("doc_id", "n", "h1", "h2")
        out = inner.join(named, (inner["h1"] == named["_h1"]) & (inner["h2"] == named["_h2"]) & (inner["n"] == named["_n"]), "left")
        out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("_linked"), F.col("_id")).otherwise(F.col("doc_id")).alias("component_id"))
        return scratch.result(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _from_texts(scratch: Scratch, docs: DataFrame, nodes: DataFrame, wanted: DataFrame, n: int, whole: bool) -> DataFrame:
    """docno, n and tokens of the nodes in wanted (a), from the text of one document of each: whole sets, or the bits of longer signatures."""
    needed = nodes.join(wanted, nodes["node"] == wanted["a"]).select("node", F.coalesce(F.col("_least.doc_id").cast("string"), F.lit("-")).alias("_id"), F.col("_least.th").alias("_th"))
    needed = scratch.put(needed, "needed")
    side = F.broadcast(needed) if needed.count() <= MOST_BROADCAST else needed
    found = docs.join(side, (_name() == F.col("_id")) & (F.xxhash64("text") == F.col("_th"))).select("node", "text")
    return scratch.put(found.mapInArrow(released(_of_nodes(n, whole)), "docno long, n long, tokens binary"), "sets" if whole else "bits")


def _verified(scratch: Scratch, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    sets = _from_texts(scratch, docs, nodes, pairs.select("a").union(pairs.select("b")).distinct(), n, True)
    return scratch.put(_links(pairs, sets, percent), "links")
