"""Collocations against brute force: edge cases, small heads of ids, longer phrases, tiles, colliding hashes, large counts."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from racelake.llm import collocations, queries, sql

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, least=10, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = tuple(x for x in re.split("[ \t]+", piece) if x)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    dropped = set()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                part = (lang, w[i : i + k])
                if 100 * a >= 50 * f[part]:
                    dropped.add(part)
    found = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            score, _, left, right = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, every in found.items() for i, (s, a, p, left, right) in enumerate(sorted(every)[:top], 1))


def same(df, want):
    assert df.columns == COLUMNS
    assert sorted(tuple(r) for r in df.collect()) == want


def test_query_and_sql(spark, docs, rows, tmp_path):
    want = brute(rows)
    assert len({r[0] for r in want}) > 1
    same(collocations.collocations(spark, docs), want)
    docs.select("doc_id", "text", "lang").write.parquet(str(tmp_path / "documents.parquet"))
    same(queries.op12_collocations(spark, str(tmp_path)), want)
    assert sorted(duckdb.sql(sql.COLLOCATIONS.format(documents=f"'{tmp_path}/documents.parquet/*.parquet'", least=10, top=2000)).fetchall()) == want


@pytest.mark.parametrize("head", [0, 7, 60])
def test_words_and_phrases_without_an_id(spark, docs, rows, head, monkeypatch):
    monkeypatch.setattr(collocations, "_HEAD", head)
    same(collocations.collocations(spark, docs), brute(rows))


def test_longer_phrases_and_other_bounds(spark, docs, rows, monkeypatch):
    want = brute(rows, 5, 3, 25)
    assert any(len(r[2].split()) == 5 for r in want)
    same(collocations.collocations(spark, docs, longest=5, least=3, top=25), want)
    monkeypatch.setattr(collocations, "_HEAD", 40)
    same(collocations.collocations(spark, docs, longest=5, least=3, top=25), want)


def test_pieces_languages_and_nulls(spark):
    rows = [(None, "A b. c,d\x0be f", None), (1, None, "x"), (1, "", "x"), (2, "a\tb  c;d", "und"), (3, "É b é B", "")] * 10
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n", F.lit("clash")).withColumn("h", F.lit(1))
    want = brute(rows)
    assert {r[2] for r in want if r[0] == "und"} == {"a b c", "e f"}
    same(collocations.collocations(spark, df), want)


def test_empty_table(spark, no_docs):
    assert collocations.collocations(spark, no_docs).count() == 0


def test_tiles_count_pairs(monkeypatch):
    monkeypatch.setattr(collocations, "_DENSE", 50)
    monkeypatch.setattr(collocations, "_MOST_DENSE", 3)
    monkeypatch.setattr(collocations, "_MOST_SPARSE", 500)
    some, tiles, want, got = np.random.default_rng(3), collocations.Tiles(), collections.Counter(), collections.Counter()

    def take():
        for keys, n in tiles.take():
            for k, c in zip(keys.tolist(), n.tolist(), strict=True):
                got[k >> 20, k & 0xFFFFF] += c

    for _ in range(60):
        size = int(some.integers(0, 900))
        a, b = (np.minimum((some.pareto(0.4, size) * 40).astype(np.int64), collocations._HEAD - 1) for _ in range(2))
        tiles.add(a, b)
        want.update(zip(a.tolist(), b.tolist(), strict=True))
        if tiles.full():
            take()
    assert tiles.dense and tiles.sparse
    take()
    assert got == want


def test_words_of_one_hash_are_told_apart(spark, docs, rows, monkeypatch):
    real, asked = collocations._count_words, []

    def colliding(seed):
        asked.append(seed)
        if seed:
            return real(seed)

        def scan(batches):
            import pyarrow as pa

            for batch in real(seed)(batches):
                yield pa.RecordBatch.from_arrays([pa.array([5] * batch.num_rows, pa.int64()), *batch.columns[1:]], batch.schema.names)

        return scan

    monkeypatch.setattr(collocations, "_count_words", colliding)
    same(collocations.collocations(spark, docs), brute(rows))
    assert asked == [0, 2]


def test_scores_of_large_counts_are_exact(spark):
    some = random.Random(5)
    rows = [(0, 0, 0)]
    for _ in range(500):
        left, right = some.randrange(10, 10**13), some.randrange(10, 10**13)
        rows.append((some.randrange(10, min(left, right) + 1), left, right))
    rows += [(10**13 - 1, 10**13 - 1, 10**13), (10**13, 10**13, 10**13), (10, 10, 10)]
    df = spark.createDataFrame(rows[1:], "a long, l long, r long")
    got = df.withColumn("s", collocations._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in got)
