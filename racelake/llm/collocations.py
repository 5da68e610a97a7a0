"""Phrase collocations by direct-address tiling: exact counts of phrases per language, scored by their weakest cut.

1. One scan counts words.  A word's identity is a 64-bit hash of language and word, checked over all words of the table: should two of
   them share a hash, the scan is repeated with another seed.
2. Words that are frequent enough get ids by frequency; the ids of the _HEAD most frequent are broadcast.  A second scan counts pairs of
   neighbouring ids in tiles of 512 x 512: a tile that a block fills well is an array of counters addressed by the pair and counted by
   bincount, the others are sorted coordinates with counts.  Since ids follow frequency, few tiles hold most pairs.  Counts of a task are
   added up there and sent once for each pair, so the most frequent pair costs a row a task.
3. Frequent pairs are ranked anew, and neighbouring pairs are counted in the same way: they overlap in a word, so they are phrases of three
   words, all of whose parts are frequent.  And so on, up to the longest phrase.

Where more words or phrases are frequent than _HEAD, those beyond it have no id: phrases with one of them are counted as rows of
hashes by Spark, so counts are exact for any vocabulary.  Each language is a group of its own everywhere.

Defined cases: null and empty texts have no words; a null language is `und`; repeated rows count as often as they stand there; doc_id is
not read, so null and equal ids make no difference; very long texts are cut nowhere; ties are ordered by count, then phrase; an empty
table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._scratch import Scratch, settings
from ._text import Words, mix, released, slices

_U = np.uint64
BLOCK_BYTES = 4_000_000
#: Ids of at most so many words or phrases are broadcast (under 40 bytes each).
_HEAD = 1 << 20
_BITS = 9
_CELLS = 1 << 2 * _BITS
#: Tiles with so many pairs of a block are counted by direct address; a task holds at most so many (2 MB each), and so many coordinates.
_DENSE, _MOST_DENSE, _MOST_SPARSE = _CELLS // 8, 24, 1 << 21
_RARE, _UNKNOWN = -1, -2

_BLANK = np.zeros(256, bool)
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK[[0x20, 0x09]] = True
_BLANK |= _CUT


@dataclass
class Level:
    """Ids of the most frequent phrases of one length: keys (hashes of words, else two ids of the length below) in order with the rank of each, the words' hashes by rank, and whether all frequent phrases are here."""

    keys: np.ndarray
    ranks: np.ndarray
    words: np.ndarray
    complete: bool

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ranks; for keys not here, rare or unknown."""
        if not len(self.keys):
            return np.full(len(keys), _RARE if self.complete else _UNKNOWN)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _RARE if self.complete else _UNKNOWN)


class _Text:
    """Words of a block: their hashes, and which have the next one beside them in their piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array, seed: int):
        self.words = words = Words(texts, lower=True, blank=_BLANK)
        codes = langs.fill_null("und").dictionary_encode()
        of_lang = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, key=b"%d" % seed).digest(), "little") for x in codes.dictionary.to_pylist()], _U)
        self.names = codes.dictionary.to_pylist()
        self.code = codes.indices.to_numpy(zero_copy_only=False)[words.doc] if words.rows else np.zeros(0, np.int64)
        self.hash = mix(words.hashes(seed) ^ of_lang[self.code]).view(np.int64) if len(words.doc) else np.zeros(0, np.int64)
        cuts = np.concatenate([[0], np.cumsum(_CUT[words.data], dtype=np.int32)])
        self.beside = (words.doc[1:] == words.doc[:-1]) & (cuts[words.starts[1:]] == cuts[words.ends[:-1]]) if len(words.doc) else np.zeros(0, bool)


def _texts(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[_Text]:
    for batch in batches:
        at = 0
        for texts in slices(batch.column(1), BLOCK_BYTES):
            yield _Text(batch.column(0).slice(at, len(texts)), texts, seed)
            at += len(texts)


def _count_words(seed: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _texts(batches, seed):
            # words of one hash in a block that differ in bytes are told apart by a second hash, or the check for collisions would not see them
            other = t.words.hashes(seed + 1)
            order = np.lexsort((other, t.hash))
            h, o = t.hash[order], other[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
            begin = np.flatnonzero(first)
            at = order[begin]
            data, starts, ends = t.words.data, t.words.starts[at].tolist(), t.words.ends[at].tolist()
            names = pa.array(t.names, pa.string()).take(pa.array(t.code[at], pa.int64()))
            words = pa.array([data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(h[begin]), names, words, pa.array(np.diff(np.append(begin, len(h))))], ["h", "lang", "word", "n"])

    return scan


class Tiles:
    """Counts of pairs of ids: dense tiles, and sorted coordinates for what falls into sparse ones."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if not len(a):
            return
        wide = (int(max(a.max(), b.max())) >> _BITS) + 1
        tile = (a >> _BITS) * wide + (b >> _BITS)
        filled = np.bincount(tile)
        rest = np.ones(len(a), bool)
        # tiles that a block fills well, and those that the task counts by direct address already
        for k in dict.fromkeys([*np.flatnonzero(filled >= _DENSE).tolist(), *[(x >> 32) * wide + (x & 0xFFFFFFFF) for x in self.dense if max(x >> 32, x & 0xFFFFFFFF) < wide]]):
            name = (k // wide) << 32 | k % wide
            if k >= len(filled) or not filled[k] or name not in self.dense and len(self.dense) >= _MOST_DENSE:
                continue
            mine = np.flatnonzero(tile == k)
            rest[mine] = False
            cells = np.bincount((a[mine] & ((1 << _BITS) - 1)) << _BITS | b[mine] & ((1 << _BITS) - 1), minlength=_CELLS)
            self.dense[name] = self.dense[name] + cells if name in self.dense else cells
        keys, n = np.unique(a[rest] << 20 | b[rest], return_counts=True)
        self.sparse.append((keys, n))
        self.held += len(keys)
        if self.held > _MOST_SPARSE:
            self.sparse = [self._merged()]
            self.held = len(self.sparse[0][0])

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate([x[k] for x in self.sparse] or [np.zeros(0, np.int64)]) for k in range(2))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[begin], np.add.reduceat(n, begin) if len(begin) else n

    def full(self) -> bool:
        return self.held > _MOST_SPARSE // 2 and len(self.sparse) == 1

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys (first id << 20 | second) and counts; empties the tiles."""
        for name, cells in self.dense.items():
            at = np.flatnonzero(cells)
            yield ((name >> 32 << _BITS) + (at >> _BITS)) << 20 | ((name & 0xFFFFFFFF) << _BITS) + (at & ((1 << _BITS) - 1)), cells[at]
        yield self._merged()
        self.__init__()


def _count_phrases(seed: int, levels):
    """Phrases of one word more than the last of the broadcast levels: key (two ids) or tail (hashes of all words), and counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, known = Tiles(), levels.value
        names = ["key", "tail", "n"]

        def counted() -> Iterator[pa.RecordBatch]:
            for keys, n in tiles.take():
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.list_(pa.int64())), pa.array(n)], names)

        for t in _texts(batches, seed):
            ids, run = known[0].find(t.hash), t.beside
            for k, level in enumerate(known[1:], 1):
                a, b = ids[: len(run)], ids[1 : len(run) + 1]
                up = level.find(np.maximum(a, 0) << 20 | np.maximum(b, 0))
                up[(a == _UNKNOWN) | (b == _UNKNOWN)] = _UNKNOWN
                up[(a == _RARE) | (b == _RARE) | ~run] = _RARE
                ids, run = up, run[:-1] & t.beside[k:] if len(run) else run
            a, b = ids[: len(run)], ids[1 : len(run) + 1]
            both = run & (a >= 0) & (b >= 0)
            tiles.add(a[both], b[both])
            odd = np.flatnonzero(run & (a != _RARE) & (b != _RARE) & ~both)
            if len(odd):
                size = len(known) + 1
                phrase = np.stack([t.hash[odd + j] for j in range(size)], axis=1)
                phrase, n = np.unique(phrase, axis=0, return_counts=True)
                tail = pa.ListArray.from_arrays(pa.array(np.arange(0, phrase.size + 1, size), pa.int32()), pa.array(phrase.ravel()))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), tail, pa.array(n)], names)
            if tiles.full():
                yield from counted()
        yield from counted()

    return scan


def _spelt(levels):
    """Columns key, tail, n: the hashes of all words instead of two ids."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = levels.value[-1].words
        for batch in batches:
            keys = batch.column(0)
            held = keys.drop_null().to_numpy()
            phrase = np.concatenate([words[held >> 20], words[held & ((1 << 20) - 1)][:, -1:]], axis=1)
            size = phrase.shape[1]
            spelt = pa.ListArray.from_arrays(pa.array(np.arange(0, phrase.size + 1, size), pa.int32()), pa.array(phrase.ravel()))
            at = np.cumsum(keys.is_valid().to_numpy(zero_copy_only=False)) - 1
            spelt = spelt.take(pa.array(at, mask=keys.is_null().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([pa.compute.coalesce(batch.column(1), spelt), keys, batch.column(2)], ["h", "key", "n"])

    return scan


def _level(table: DataFrame, most: int) -> Level:
    """The ids of a table of h (hashes), key and n: of all its phrases that can have one, or of the most frequent ones, at most so many."""
    able = table if "key" not in table.columns else table.filter("key is not null")
    # a power of two in sixteen steps; at most some thousand rows, whatever the counts
    step = F.floor(F.log2("n") * 16)
    steps = sorted(((r[0], r[1]) for r in able.groupBy(step).count().collect()), reverse=True)
    held, least = 0, None
    for s, n in steps:
        if held + n > most:
            break
        held, least = held + n, s
    head = able.filter(step >= least) if least is not None else able.filter("false")
    rows = head.toArrow()
    words = np.array(rows["h"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.int64).reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 1), np.int64)
    keys = rows["key"].to_numpy() if "key" in rows.column_names else words[:, 0]
    by_count = np.lexsort((keys, -rows["n"].to_numpy()))
    keys, words = keys[by_count], words[by_count]
    order = np.argsort(keys, kind="stable")
    return Level(keys[order], order, words, held == table.count())


def phrase_counts(spark: SparkSession, docs: DataFrame, longest: int, least: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(lang, size) in words; (h, lang, word, n) of the frequent words; for each length (h, n) of the phrases that stand there `least` times or more, words among them. h are hashes of words, an array."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=6000, spark__sql__execution__arrow__maxBytesPerBatch=BLOCK_BYTES, spark__sql__files__minPartitionNum=parts):
        seed = 0
        while True:
            seen = d.mapInArrow(released(_count_words(seed)), "h long, lang string, word string, n long")
            words = scratch.put(seen.groupBy("h", "lang", "word").agg(F.sum("n").alias("n")), "words")
            if words.groupBy("h").count().filter("count > 1").isEmpty():
                break
            seed += 2
        sizes = words.groupBy("lang").agg(F.sum("n").alias("size"))
        frequent = scratch.put(words.filter(F.col("n") >= least), "frequent")
        tables = [frequent.select(F.array("h").alias("h"), "n")]
        levels = [_level(tables[0], _HEAD)]
        while len(levels) < longest:
            known = spark.sparkContext.broadcast(levels)
            found = d.mapInArrow(released(_count_phrases(seed, known)), "key long, tail array<long>, n long").groupBy("key", "tail").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
            found = scratch.put(found.select("key", "tail", "n").mapInArrow(_spelt(known), "h array<long>, key long, n long"), "phrases")
            tables.append(found.select("h", "n"))
            levels.append(_level(found, _HEAD))
        return sizes, frequent, tables


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact up to counts of 10^13: a decimal holds both products, and integer division takes them."""
    wide = lambda c: c.cast("decimal(19,0)")
    parts = {"num": (wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), "den": (wide(left) * wide(right)).cast("decimal(38,0)")}
    return F.call_function("div", parts["num"], parts["den"])


def collocations(spark: SparkSession, docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language, without those of which a longer candidate makes up `share` percent or more."""
    scratch = Scratch(spark, "collocations")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sizes, words, tables = phrase_counts(spark, docs, longest, least, scratch)
    known = tables[0]
    for t in tables[1:]:
        known = known.unionByName(t)
    known = known.select(F.col("h").alias("_part"), F.col("n").alias("_n"))
    phrases = tables[1]
    for t in tables[2:]:
        phrases = phrases.unionByName(t)
    # candidates inside a longer one: each proper part of two words or more, with the most frequent phrase around it
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("h") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.size("h") - k + 1), lambda s: F.slice("h", s, k))))
    around = phrases.filter(F.size("h") > 2).select(F.explode(spans).alias("_in"), "n").groupBy("_in").agg(F.max("n").alias("_around"))
    left = phrases.join(around, phrases["h"] == around["_in"], "left").filter(F.coalesce(100 * F.col("_around") < share * F.col("n"), F.lit(True))).select("h", F.col("n").alias("a"))
    left = scratch.put(left, "candidates")
    cuts = left.select("h", "a", F.explode(F.sequence(F.lit(1), F.size("h") - 1)).alias("k"))
    cuts = cuts.select("h", "a", "k", F.slice("h", F.lit(1), F.col("k")).alias("_l"), F.slice("h", F.col("k") + 1, F.size("h") - F.col("k")).alias("_r"))
    cuts = cuts.join(known.select(F.col("_part").alias("_l"), F.col("_n").alias("l")), "_l").join(known.select(F.col("_part").alias("_r"), F.col("_n").alias("r")), "_r")
    scored = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))).groupBy("h").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("_b"))
    spelt = scored.select("h", "_b", F.posexplode("h").alias("_at", "_h")).join(words.select(F.col("h").alias("_h"), "lang", "word"), "_h")
    spelt = spelt.groupBy("h").agg(F.first("_b").alias("_b"), F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    spelt = spelt.select("lang", "phrase", "_b.*")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of many parts of a language, then the best of these: no task ranks a language whole
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = spelt.withColumn("_part", part).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).filter(F.col("_r") <= top)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    out = some.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("size").alias("n"), "score")
    return scratch.result(out)
