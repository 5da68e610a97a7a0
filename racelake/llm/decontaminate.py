"""Benchmark decontamination by winnowing, in DataFrame functions only.

The fingerprints of a text are the least hashes of its windows of `window` consecutive k-grams; with k + window - 1 = span, every run of span
words that a document shares with a test item gives both the same fingerprint.  A fingerprint keeps its place: the run of windows whose
minimum it is, so that periodic texts have one where they repeat.  Fingerprints of documents and items are joined, and each hit is extended from its place to the left
and right over the windows of its run, no further: these are compared with the items' windows by 128 bits of hash, and hit windows that overlap form one
range.  A phrase of k words that many documents share with an item thus costs at most `window` windows where it stands.

Items of fewer than span words are one window of their whole length: its hash is looked up among the document's grams of that length.

Defined cases: null texts have no words; rows of one doc_id with different texts are judged apart, equal rows alike; a null doc_id
is kept; null or empty items have no window; items of one id count once; empty tables give no hits; extra columns, whatever their names, are
neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._scratch import Scratch, without

#: Separators in ASCII: everything but digits and letters.
_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum() and c != 0x20)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sides of at most so many rows are broadcast (a row has under 100 bytes).
MOST_BROADCAST = 500_000


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) runs of characters other than \\x00-\\x2F, \\x3A-\\x60 and \\x7B-\\x7F."""
    flat = F.translate(F.coalesce(text, F.lit("")), _UPPER + _BREAKS, _LOWER + " " * len(_BREAKS))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def _gram(words: str, k: int, *salt: Column) -> Column:
    """Hashes of the k-grams of an array column of k words or more."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*salt, *[F.get(words, i + j) for j in range(k)]))


_PLACED = "array<struct<n:int,h:bigint,s:int,e:int>>"


def _placed(n: int, hashes: Column) -> Column:
    """Hashes of windows of n words as (n, h, s, e), each of the one window that starts at its place."""
    return F.transform(hashes, lambda h, i: F.struct(F.lit(n).alias("n"), h.alias("h"), i.alias("s"), i.alias("e")))


def fingerprints(d: DataFrame, words: str, k: int, span: int) -> DataFrame:
    """d with _prints: the window minima of a word array's k-gram hashes as (n, h, s, e), one for each run of windows that share their minimum: the windows of n = span words that start at s to e. Empty below span words."""
    window = span - k + 1
    none = F.array().cast("array<bigint>")
    d = d.withColumn("_g", F.when(F.size(words) < span, none).otherwise(_gram(words, k)))
    least = F.transform(F.sequence(F.lit(0), F.size("_g") - window), lambda i: F.least(*[F.get("_g", i + j) for j in range(window)]))
    d = d.withColumn("_m", F.when(F.size("_g") < window, none).otherwise(least))
    d = d.withColumn("_c", F.filter(_placed(span, F.col("_m")), lambda x: ~x["h"].eqNullSafe(F.get("_m", x["s"] - 1))))
    until = lambda i: F.coalesce(F.get("_c", i + 1)["s"], F.size("_m")) - 1
    runs = F.transform("_c", lambda x, i: F.struct(x["n"].alias("n"), x["h"].alias("h"), x["s"].alias("s"), until(i).alias("e")))
    return d.withColumn("_prints", runs.cast(_PLACED)).drop("_g", "_m", "_c")


def _extended(words: str, at: str) -> Column:
    """The windows that hold the matched fingerprints `at`, as (n, h, g, p): two hashes and the first word of each."""
    cut = lambda x, p: F.slice(words, p + 1, x["n"])
    window = lambda x: lambda p: F.struct(x["n"].alias("n"), F.xxhash64(cut(x, p)).alias("h"), F.xxhash64(F.lit("again"), cut(x, p)).alias("g"), p.alias("p"))
    return F.flatten(F.transform(at, lambda x: F.transform(F.sequence(x["s"], x["e"]), window(x))))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("_id"), F.xxhash64("text").alias("_h"), F.col("text").alias("_text"))


def _few(df: DataFrame) -> bool:
    """Whether the counted rows of df allow a broadcast; else a shuffle join is left to Spark."""
    return df.count() <= MOST_BROADCAST


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if _few(df) else df


def _exploded(d: DataFrame, keys: list[str], array: Column) -> DataFrame:
    """explode() would add a filter on the size of its array, which is pushed into the lambdas that make it; explode_outer() does not."""
    return d.select(*keys, F.explode_outer(array).alias("_x")).filter(F.col("_x").isNotNull())


def _sequences(items: DataFrame, scratch: Scratch) -> DataFrame:
    """(_seq, _w, _items): the different word sequences of items, with their item_ids."""
    seqs = items.select("item_id", words_of(F.col("text")).alias("_w")).filter(F.size("_w") > 0)
    seqs = seqs.groupBy("_w").agg(F.collect_set(F.col("item_id").cast("string")).alias("_items")).withColumn("_seq", F.sha2(F.array_join("_w", " "), 256))
    return scratch.put(seqs, "items")


def candidate_windows(docs: DataFrame, seqs: DataFrame, scratch: Scratch, span: int = 10, k: int = 6) -> tuple[DataFrame, DataFrame]:
    """(keys, n, h, g, p) of the windows of documents (_id, _h) that hold a fingerprint of an item, and of all windows of items (_seq).

    A run of windows is sought by its one fingerprint, with its place; where that is an item's, exactly the windows of the run are read."""
    lengths = sorted(r[0] for r in seqs.select(F.size("_w").alias("n")).filter(F.col("n") < span).distinct().collect())
    every = _exploded(fingerprints(seqs, "_w", k, span), ["_seq", "_w"], F.col("_prints"))
    for n in lengths:
        every = every.unionByName(_exploded(seqs.filter(F.size("_w") == n), ["_seq", "_w"], _placed(n, _gram("_w", n)).cast(_PLACED)))
    every = every.withColumn("_at", F.array("_x"))
    prints = scratch.put(every.select(F.col("_x.n").alias("_n"), F.col("_x.h").alias("_fp")).distinct(), "prints")
    theirs = _exploded(every, ["_seq"], _extended("_w", "_at")).select("_seq", "_x.*")
    theirs = scratch.put(theirs.select("n", "h", "g", "_seq").distinct(), "windows")

    d = fingerprints(_keyed(docs).withColumn("_w", words_of(F.col("_text"))).select("_id", "_h", "_w"), "_w", k, span)
    none = F.array().cast("array<bigint>")
    found = F.concat("_prints", *[_placed(n, F.when(F.size("_w") < n, none).otherwise(_gram("_w", n))).cast(_PLACED) for n in lengths])
    d = _exploded(d, ["_id", "_h"], found).select("_id", "_h", F.col("_x.n").alias("_n"), F.col("_x.h").alias("_fp"), F.col("_x.s").alias("s"), F.col("_x.e").alias("e"))
    hits = scratch.put(d.join(_sized(prints), ["_n", "_fp"]).select("_id", "_h", F.col("_n").alias("n"), "s", "e"), "hits")

    # the runs of one text, which came from one row; rows of equal id and text give equal runs
    few = _few(hits)
    runs = hits.groupBy("_id", "_h").agg(F.collect_set(F.struct("n", "s", "e")).alias("_at"))
    full = (_keyed(docs) if few else _keyed(docs).dropDuplicates(["_id", "_h"])).join(F.broadcast(runs) if few else runs, ["_id", "_h"])
    ours = _exploded(full.withColumn("_w", words_of(F.col("_text"))), ["_id", "_h"], _extended("_w", "_at")).select("_id", "_h", "_x.*")
    return ours, theirs


def hit_windows(spark: SparkSession, docs: DataFrame, items: DataFrame, scratch: Scratch, span: int = 10, k: int = 6) -> tuple[DataFrame, DataFrame]:
    """(_id, _h, _seq, _p, _n): the windows of documents, by first word and length, that equal one of the item word sequence _seq; and the sequences with their item_ids."""
    seqs = _sequences(items, scratch)
    ours, theirs = candidate_windows(docs, seqs, scratch, span, k)
    return ours.join(_sized(theirs), ["n", "h", "g"]).select("_id", "_h", "_seq", F.col("p").alias("_p"), F.col("n").alias("_n")).distinct(), seqs


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, span: int = 10, k: int = 6) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document; k-grams of k words are fingerprinted."""
    scratch = Scratch(spark, "decontaminate")
    windows, seqs = hit_windows(spark, docs, items, scratch, span, k)
    windows = scratch.put(windows, "hit-windows")
    covered = windows.groupBy("_id", "_h").agg(F.array_sort(F.collect_set(F.struct(F.col("_p").alias("s"), (F.col("_p") + F.col("_n")).alias("e")))).alias("_r"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    merged = F.aggregate("_r", zero, lambda a, r: F.struct(F.greatest(a["end"], r["e"]).alias("end"), (a["n"] + F.greatest(r["e"] - F.greatest(r["s"], a["end"]), F.lit(0))).alias("n")), lambda a: a["n"])
    covered = covered.select("_id", "_h", merged.cast("long").alias("n_hit"))
    named = windows.select("_id", "_h", "_seq").distinct().join(_sized(seqs.select("_seq", F.explode("_items").alias("_item"))), "_seq")
    named = named.groupBy("_id", "_h").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    hit = scratch.put(covered.join(named, ["_id", "_h"]), "hit")
    scratch.keep(1)
    out = _keyed(docs).select("doc_id", "_id", "_h", F.size(words_of(F.col("_text"))).cast("long").alias("n_words")).join(_sized(hit), ["_id", "_h"], "left")
    items_found = F.coalesce("_items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"), F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, span: int = 10, k: int = 6) -> DataFrame:
    """The documents without a hit, with all their columns."""
    scratch = Scratch(spark, "clean")
    windows, _ = hit_windows(spark, docs, items, scratch, span, k)
    hit = scratch.put(windows.select("_id", "_h").distinct(), "hit")
    scratch.keep(1)
    return without(spark, docs, hit, _few(hit))
