"""Near duplicates by min-max hashing against brute force: edge cases, chunks, chains of near copies, estimates."""

import itertools
import random

import numpy as np
import pytest
from test_corpus_operators import low_words, same_rows

from racelake.llm import minmax, ngram_join, queries

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def shingles(text, n=5):
    w = low_words(text)
    return frozenset(zip(*(w[k:] for k in range(n)), strict=False)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    """rows of (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            up[top(b)] = top(a)
    least = {}
    for i, (doc, _) in enumerate(rows):
        t = top(i)
        least[t] = doc if least.get(t) is None else least[t] if doc is None else min(doc, least[t])
    return [(doc, len(sets[i]), least[top(i)], doc == least[top(i)]) for i, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("split", [2048, 3])
def test_edge_cases(spark, docs, rows, split, monkeypatch):
    for module in (minmax, ngram_join):
        monkeypatch.setattr(module, "_SPLIT", split)
    got = minmax.near_duplicates(spark, docs)
    assert got.columns == COLUMNS
    same_rows([tuple(r) for r in got.collect()], brute([r[:2] for r in rows]))


def test_groups_chains_and_near_misses(spark, tmp_path, monkeypatch):
    for module in (minmax, ngram_join):
        monkeypatch.setattr(module, "_SPLIT", 16)
    some = random.Random(11)
    base = [f"w{some.randrange(4000)}" for _ in range(300)]
    rows = []
    for _ in range(70):  # edits of one text: some pairs link, others only through a third
        w = list(base)
        for _ in range(some.randrange(9)):
            w[some.randrange(300)] = f"e{some.randrange(10**6)}"
        rows.append(w)
    chain = list(base[:150])
    for k in range(20):  # each links with the next, the ends do not
        chain = chain[3:] + [f"c{k}_{j}" for j in range(3)]
        rows.append(list(chain))
    # similarities of 0.85 exactly, just under, and far under
    one = [f"x{i}" for i in range(89)]
    rows += [one, one[:74] + [f"y{i}" for i in range(2)], one[:76], one[:77], one[:60], ["a"], ["A"], ["a", "b"], ["b", "a"]]
    table = [(1000 - i if i % 3 else i, " ".join(w)) for i, w in enumerate(rows)]
    some.shuffle(table)
    spark.createDataFrame([(*r, i) for i, r in enumerate(table)], "doc_id long, text string, n long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want = brute(table)
    assert 1 < len({r[2] for r in want}) < len(want)
    same_rows([tuple(r) for r in queries.op11_minhash(spark, str(tmp_path)).collect()], want)


def test_empty_table_and_low_thresholds(spark, no_docs):
    assert minmax.near_duplicates(spark, no_docs).count() == 0
    with pytest.raises(ValueError, match="85"):
        minmax.near_duplicates(spark, no_docs, percent=70)


def test_many_copies_of_one_row(spark):
    rows = [(7, "the same row again and again " * 3)] * 400 + [(None, "the same row again and again " * 3), (9, None)]
    got = minmax.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()
    same_rows([tuple(r) for r in got], brute(rows))


def test_estimates_and_bands():
    some = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.85):
        agree, bands = [], []
        for _ in range(60):
            both, left, right = (some.integers(0, 2**64, k, dtype=np.uint64) for k in (int(600 * share), int(300 * (1 - share)), int(300 * (1 - share))))
            x, y = np.concatenate([both, left]), np.concatenate([both, right])
            s = minmax.signatures(np.concatenate([x, y]), np.array([0, len(x)]))
            agree.append((s[0] == s[1]).mean())
            b = minmax.bands(s)
            bands.append((b[0] == b[1]).mean())
        jaccard = len(both) / (len(both) + len(left) + len(right))
        assert abs(np.mean(agree) - jaccard) < 0.02 and abs(np.mean(bands) - jaccard**4) < 0.05
    assert (s[:, :64] <= s[:, 64:]).all()
    # values of one set only: all bands of equal sets are equal, whatever the order
    assert (minmax.bands(minmax.signatures(np.concatenate([x, x[::-1]]), np.array([0, len(x)])))[0] == minmax.bands(minmax.signatures(x, np.array([0])))[0]).all()


def test_values_agree_as_counted():
    some = np.random.default_rng(4)
    sketch = some.integers(0, 3, (40, minmax._VALUES), dtype=np.uint8)
    want = (sketch[:, None, :] == sketch[None, :, :]).sum(axis=2)
    assert (minmax.alike(np.ascontiguousarray(sketch.T), np.arange(5, 20), slice(2, 33)) == want[5:20, 2:33]).all()


def test_longer_signatures():
    some = np.random.default_rng(8)
    for share in (0.7, 0.85):
        got = []
        for _ in range(40):
            both, left, right = (some.integers(0, 2**64, k, dtype=np.uint64) for k in (int(400 * share), int(200 * (1 - share)), int(200 * (1 - share))))
            x, y = np.concatenate([both, left]), np.concatenate([both, right])
            b = minmax.bit_signatures(np.concatenate([x, y]), np.array([0, len(x)]))
            got.append(int(minmax.bits_alike(b, np.array([0]), np.array([1]))[0]))
            assert got[-1] == sum(f"{p:064b}"[i] == f"{q:064b}"[i] for p, q in zip(*b.tolist(), strict=True) for i in range(64))
        jaccard = len(both) / (len(both) + len(left) + len(right))
        # agreeing bits: all of shared values, half of the others; no wider than independent bits
        assert abs(np.mean(got) / minmax._BITS - (1 + jaccard) / 2) < 0.004 and np.std(got) < 1.4 * (minmax._BITS * (1 + jaccard) / 2 * (1 - jaccard) / 2) ** 0.5
    assert min(got) > minmax._LEAST_BITS


def test_a_group_of_texts_alike_but_not_linked(spark, monkeypatch):
    some = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(60):
        w = list(base)
        for i in some.sample(range(200), 5):  # about 0.78 between any two
            w[i] = f"e{k}_{i}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, t.replace("b100", f"z{k}")) for k, t in rows[:10]]
    got = minmax.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same_rows([tuple(r) for r in got], brute(rows))
