"""The pipeline's stages on the smallest tables: what each keeps, by SQL and brute force."""

import itertools

import duckdb
from test_corpus_operators import base_spans, shingles

import corpus_pipeline
from racelake.llm import sql

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "pii", "packing"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.toPandas())
    assert all(list(k.columns) == columns for k in kept[:4])
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    good = {r[0] for r in c.sql(f"select doc_id from ({sql.QUALITY.replace('{documents}', 'documents')}) where kept").fetchall()}
    assert set(kept[0].doc_id) == good
    text = dict(zip(kept[0].doc_id, kept[0].text, strict=True))
    sets = {i: shingles(t) for i, t in text.items()}
    up = {i: i for i in text}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(text), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            up[high] = low
    assert set(kept[1].doc_id) == {top(i) for i in text}
    c.register("d", kept[1])
    clean = {r[0] for r in c.sql(f"select doc_id from ({sql.DECONTAMINATION.replace('{documents}', 'd').replace('{benchmark}', repr(SF + '/benchmark.parquet'))}) where not contaminated").fetchall()}
    assert set(kept[2].doc_id) == clean == set(kept[3].doc_id) == set(kept[4].doc_id)
    assert not any(base_spans(t) for t in kept[3].text)
    assert kept[4].groupby("sequence_id").length.sum().max() <= 2048


def test_stages_on_edge_cases(spark, docs, no_docs, tmp_path):
    """Columns that clash with internal names, nulls, repeated rows and empty tables go through every stage but the last with their columns."""
    for given, name in ((docs, "edges"), (no_docs, "none")):
        d, kept = given, []
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, d, SF).write.parquet(str(tmp_path / f"{name}-{i}"))
            d = spark.read.parquet(str(tmp_path / f"{name}-{i}"))
            kept.append(d.toPandas())
        assert all(list(k.columns) == given.columns for k in kept[:4]) and list(kept[4].columns) == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        if name == "none":
            assert all(k.empty for k in kept)
            continue
        assert (kept[3]["_k"] == "k").all() and (kept[3]["_hit_h"] == 2).all() and kept[3]["kept"].all() and set(kept[3]["_text"]) == {"clash"}
        assert (kept[3].n_chars == kept[3].text.str.len()).all()
        # one id of the table has two texts
        assert not kept[1].duplicated(["doc_id", "text"]).any() and not kept[1].text.duplicated().any() and len(kept[1]) < len(kept[0])


def test_scratch_is_dropped(spark):
    import os

    base = spark.conf.get("spark.checkpoint.dir", None)
    before = set(os.listdir(base.removeprefix("file://"))) if base else set()
    out = corpus_pipeline.run(spark, SF)
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    left = {d: os.listdir(f"{base}/{d}") for d in set(os.listdir(base)) - before}
    assert out.count() > 0
    # the pipeline's last table, and what each stage's lazy result reads
    assert all(len(tables) <= 2 for tables in left.values()) and sum(map(len, left.values())) <= 10


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    import pytest

    from racelake.llm import _scratch

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _scratch.shared_folder(Session())


def test_near_copies_of_five_words_and_four_fifths(spark, tmp_path):
    # one long text with 19 to 27 % appended: Jaccard between 0.85 and 0.79
    base = [f"w{i}" for i in range(200)]
    texts = {0: base, **{k: base + [f"x{k}_{i}" for i in range(k)] for k in (38, 44, 48, 54)}, 99: [f"y{i}" for i in range(60)]}
    texts[100] = base[:110] + ["edit"] + base[111:]
    texts[200] = base[:33] + ["one"] + base[34:99] + ["two"] + base[100:150] + ["three"] + base[151:170] + ["four"] + base[171:]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").write.parquet(path)
    sets = {i: {tuple(t[k : k + 5]) for k in range(len(t) - 4)} for i, t in texts.items()}
    up = {i: i for i in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            up[high] = low
    want = {top(i) for i in texts}
    assert want < set(texts) and {0, 99} <= want
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, spark.read.parquet(path), "").collect()} == want
