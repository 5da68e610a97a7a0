"""Operators whose edge cases the star schema lacks."""

import json
import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racelake.functions import json_keys
from racelake.functions import text as X
from racelake.operators import checks, lineage, pit, reconcile, scoring


def test_null_keys_match_each_other(spark):
    a = spark.createDataFrame([(1, None), (1, "x")], "k int, j string")
    b = spark.createDataFrame([(1, None), (2, "x")], "k int, j string")
    got = reconcile.full_outer(a, b, ["k", "j"]).groupBy("side").count().collect()
    assert {r.side: r["count"] for r in got} == {"both": 1, "left_only": 1, "right_only": 1}


@pytest.mark.parametrize("a,b,kind", [("abc", "abc", "exact"), ("ab", "abc", "prefix"), ("ac", "abc", "subsequence"), ("ca", "abc", "unexplained"), ("axxc", "ac", "subsequence")])
def test_names(spark, a, b, kind):
    d = spark.createDataFrame([(a, b)], "a string, b string")
    assert d.select(reconcile.name_match(d, "a", "b")).first()[0] == kind


def test_text_functions(spark):
    d = spark.createDataFrame([("\t　a b　", "12345", "7")], "t string, long string, short string")
    r = d.select(X.strip_all(F.col("t")), X.pad_id(F.col("long"), 4), X.pad_id(F.col("short"), 4), X.nfkc(F.lit("Ｈ１")), F.size(X.numbered_lines(F.lit("a\r\nb\x0bc\n")))).first()
    assert list(r) == ["a b", "12345", "0007", "H1", 3]


def test_aware_timestamps(spark):
    d = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("2026-01-01T09:00:00+09:00",), ("2026-01-01T00:00:00",), ("x",)], "t string")
    assert [r[0] for r in d.select(F.unix_seconds(pit.aware(F.col("t")))).collect()] == [1767225600, 1767225600, None, None]


def test_digests_ignore_input_order(spark):
    rows = [(v, b, f"{v}{b}") for v in (1, 2) for b in range(3)]
    one = lineage.group_digest(spark.createDataFrame(rows, "v int, b int, s string"), ["v"], F.col("s"))
    two = lineage.group_digest(spark.createDataFrame(rows[::-1], "v int, b int, s string"), ["v"], F.col("s"))
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}
    changed = lineage.group_digest(spark.createDataFrame([*rows[:-1], (2, 2, "z")], "v int, b int, s string"), ["v"], F.col("s"))
    assert lineage.binding_report(one, changed, ["v"], "digest").first().mismatches == 1


def test_gate_and_violations(spark):
    d = spark.createDataFrame([("a", 0, 2), ("b", 0, 0)], "u string, x long, y long")
    assert {r.u: (r.failures, r.status) for r in checks.gate(d, ["x", "y"]).collect()} == {"a": ("y", "FAILED"), "b": ("", "SUCCESS")}
    with pytest.raises(ValueError):
        checks.assert_gate(checks.gate(d, ["x", "y"]))
    e = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (1.5,)], "x double")
    got = checks.violations(e, {"range": checks.between("x", 0, 2), "integral": checks.integral("x")}).collect()
    assert {r.rule: r.violations for r in got} == {"range": 2, "integral": 3}


def test_contract_report(spark):
    d = spark.createDataFrame([(1, None, "x")], "a int, b string, payout string")
    contract = T.StructType([T.StructField("b", T.StringType(), False), T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    got = {(r.column_name, r.problem, r.nulls) for r in checks.contract_report(d, contract, checks.RESULT_COLUMNS).collect()}
    assert got == {("c", "missing", 0), ("payout", "extra", 0), ("b", "order", 0), ("a", "order", 0), ("a", "type", 0), ("b", "nullable", 0), ("payout", "prohibited", 0), ("b", "nulls", 1)}
    assert checks.contract_report(d, d.schema).count() == 0


def test_forbidden_keys_at_any_depth(spark):
    deep = '{"a":' * 1000 + '{"Odds":[{"label":1}]}' + "}" * 1000
    mixed = "[" * 30_000 + '{"x":{"odds":1}}' + "]" * 30_000
    docs = ['{"a": 1}', '{"a": {"b": [{"x": 1}, {" Odds": 2}]}, "result": {"ev": 3}}', "[[[{\"label\": null}]]]", "no json", None, deep, '{"a":1,}', '{"odds":1}}', ' "odds" ', '{"\\u006fdds":"\\"odds\\":", "ev":[], "ev":{}}', "", '{"label":01}']
    d = spark.createDataFrame([*enumerate(docs), (99, mixed)], "k int, doc string")
    out = checks.forbidden_keys(d, ["k"], "doc")
    got = sorted(((r.k, r.path, r.key) for r in out.collect()), key=str)
    broken = [(k, "$", None) for k in (3, 6, 7, 10, 11)]
    want = [(1, "$", "result"), (1, "$.a.b[1]", " Odds"), (1, "$.result", "ev"), (2, "$[0][0][0]", "label"), (5, "$" + ".a" * 1000, "Odds"), (5, "$" + ".a" * 1000 + ".Odds[0]", "label"), (9, "$", "odds"), (9, "$", "ev"), (9, "$", "ev"), (99, "$" + "[0]" * 30_000 + ".x", "odds")]
    assert got == sorted(broken + want, key=str)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + out._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") <= 1


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from(["a", "odds", " EV ", "é", "q\"\\\n"]), x, max_size=4), max_leaves=20), st.integers(0, 3))
def test_keys_of_any_document(value, indent):
    def walk(x, path):
        if isinstance(x, dict):
            for k, v in x.items():
                if k.strip(" ").lower() in {"odds", "ev"}:
                    yield path, k
                yield from walk(v, f"{path}.{k}")
        elif isinstance(x, list):
            for i, v in enumerate(x):
                yield from walk(v, f"{path}[{i}]")

    text = json.dumps(value, indent=indent or None, ensure_ascii=indent > 1)
    assert sorted(json_keys.forbidden_in(text, {"odds", "ev"})) == sorted(walk(value, "$"))
    broken = text[:-1]
    try:
        json.loads(broken)
    except ValueError:
        assert json_keys.forbidden_in(broken, {"odds"}) == [("$", None)]


def test_scores_by_a_registry_of_models(spark):
    shape = "model_id string, feature_names array<string>, coefficients array<double>, classes array<int>, positive_class int, intercept double, contract_features array<string>, vocabularies map<string,array<string>>, vocabulary_coefficients map<string,array<double>>"
    good = {"feature_names": ["x", "y"], "coefficients": [2.0, -1.0], "classes": [0, 1], "positive_class": 1, "intercept": 0.5, "contract_features": ["x", "y"], "vocabularies": {"c": ["?", "a", "b"]}, "vocabulary_coefficients": {"c": [0.0, 1.0, 2.0]}}
    faults = {
        "coefficient_count": {"coefficients": [1.0]}, "repeated_names": {"feature_names": ["x", "x"], "contract_features": ["x", "x"]}, "not_finite": {"intercept": float("inf")}, "positive_class": {"positive_class": 0}, "feature_order": {"contract_features": ["y", "x"]},
        "vocabulary_size": {"vocabulary_coefficients": {"c": [0.0]}}, "repeated_entries": {"vocabularies": {"c": ["?", "a", "a"]}}, "vocabulary_not_finite": {"vocabulary_coefficients": {"c": [0.0, None, 2.0]}},
    }
    other = {"feature_names": ["y"], "coefficients": [3.0], "contract_features": ["y"], "vocabularies": {}, "vocabulary_coefficients": {}, "intercept": -1.0}
    records = {"good": good, "other": good | other, "far": good | {"intercept": 100.0}, **{k: good | v for k, v in faults.items()}}
    models = spark.createDataFrame([(k, *r.values()) for k, r in records.items()] + [("twice", *good.values())] * 2, shape)
    rows = [(m, 1.0, 0.25, "b") for m in [*records, "twice", "none", None]] + [("good", 1.0, 0.25, "z"), ("good", None, 1.0, "a"), ("good", 1.0, 1.0, ""), ("other", None, 1.0, "")]
    d = spark.createDataFrame(rows, "model_id string, x double, y double, c string")
    got = scoring.score_by_models(d, models, ["c"]).collect()
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    assert len(got) == len(rows)
    assert {r.model_id: r.refused for r in got if r.refused} == {k: k for k in faults} | {"twice": "repeated_records", "none": "unknown_model", None: "unknown_model"}
    assert all((r.probability is None) == (r.refused is not None) for r in got if r.c == "b")
    p = {(r.model_id, r.x, r.c): r.probability for r in got}
    assert p["good", 1.0, "b"] == pytest.approx(sigmoid(0.5 + 2 - 0.25 + 2)) and p["good", 1.0, "z"] == pytest.approx(sigmoid(2.25)) and p["other", 1.0, "b"] == pytest.approx(sigmoid(-0.25)) and p["far", 1.0, "b"] == 1.0
    assert p["good", None, "a"] is None and p["good", 1.0, ""] is None and p["other", None, ""] == pytest.approx(sigmoid(2))


def test_examples_and_counts(spark):
    d = spark.createDataFrame([(s, f"{s}{i:03d}", "x" if i % 2 else None) for s in "ab" for i in range(200)], "s string, e string, c string")
    got = {r.s: r.details for r in checks.examples(d, ["s"], "check", F.col("e")).collect()}
    assert got == {s: [f"{s}{i:03d}" for i in range(10)] for s in "ab"}
    assert {r.s: r.n for r in checks.code_counts(d, ["s"], "c", "<NULL>", "n").collect()} == {s: {"x": 100, "<NULL>": 100} for s in "ab"}


@pytest.mark.parametrize("kind,message,explicit,want", [
    ("x.FileNotFoundError", "hash mismatch", None, "SKIPPED_PROGRAM_UNAVAILABLE"), ("E", "Unsupported contract", None, "SKIPPED_CONTRACT_VERSION_UNSUPPORTED"), ("E", "source fetched AFTER the cut-off", None, "SKIPPED_FETCHED_AFTER_AS_OF"),
    ("E", "sha256 mismatch of provenance missing", None, "SKIPPED_HASH_MISMATCH"), ("E", "sidecar missing", None, "SKIPPED_PROVENANCE_MISSING"), ("E", "not six boats", None, "SKIPPED_INVALID_RACE_STRUCTURE"), ("E", "odds feature", None, "SKIPPED_PROHIBITED_FEATURE"),
    ("E", "download failed", None, "SKIPPED_PROGRAM_UNAVAILABLE"), ("E", "manifest integrity", None, "SKIPPED_OUTPUT_INTEGRITY_ERROR"), ("E", "naive datetime", None, "SKIPPED_METADATA_INVALID"), ("E", "who knows", None, "SKIPPED_OUTPUT_INTEGRITY_ERROR"),
    (None, None, None, "SKIPPED_OUTPUT_INTEGRITY_ERROR"), ("E", "odds feature", "SKIPPED_HASH_MISMATCH", "SKIPPED_HASH_MISMATCH"), ("E", "odds feature", "ELIGIBLE", "SKIPPED_PROHIBITED_FEATURE"),
])
def test_failure_status(spark, kind, message, explicit, want):
    d = spark.createDataFrame([(kind, message, explicit)], "k string, m string, e string")
    assert d.select(pit.failure_status(F.col("k"), F.col("m"), F.col("e"))).first()[0] == want


def test_decisions(spark):
    shape = "status string, eligible boolean, reason string, race_date string, as_of_time string, record struct<status string, eligible boolean, reason string, as_of_time string>"
    row = lambda status="ELIGIBLE", eligible=True, reason="r", at="t", record=None: (status, eligible, reason, "2026-07-01", at, record or (status, eligible, reason, at))
    broken = lambda *rows: {r.rule for r in checks.violations(spark.createDataFrame(list(rows), shape), pit.decision_rules()).collect() if r.violations}
    assert broken(row(), row("SKIPPED_HASH_MISMATCH", False)) == set()
    assert broken(row(eligible=False)) == {"eligible_exactly_if_status"} == broken(row("SKIPPED_HASH_MISMATCH", True))
    assert broken(row("OTHER", False)) == {"status_known"} and broken(row(reason=" ")) == {"reason_given"} and broken(row(at=None)) == {"as_of_time_given"}
    assert broken(row(record=("ELIGIBLE", True, "other", "t"))) == {"record_reason"}


def test_research_only_archives(spark):
    a = spark.createDataFrame([("p", 1, "AB"), ("p", 2, "ab"), ("q", 1, "ab")], "path string, length long, sha256 string")
    e = spark.createDataFrame([("p", 1, "ab")], "path string, length long, sha256 string")
    assert [r.use for r in pit.research_only(a, e).orderBy("path", "length").collect()] == ["RESEARCH_ONLY", "EXCEPTION_DIFFERS", "PRODUCTION"]


def test_groups_of_any_size(spark):
    rows = [("hot", i) for i in range(1000)] + [("cold", 1), (None, 2)]
    d = spark.createDataFrame(rows, "k string, v int")
    got = {r.k: r.digest for r in lineage.bucketed_digest(d, ["k"], F.col("v").cast("string")).collect()}
    again = {r.k: r.digest for r in lineage.bucketed_digest(d.orderBy(F.desc("v")), ["k"], F.col("v").cast("string")).collect()}
    less = {r.k: r.digest for r in lineage.bucketed_digest(d.filter("v <> 500"), ["k"], F.col("v").cast("string")).collect()}
    assert got == again and got["hot"] != less["hot"] and got["cold"] == less["cold"] and len(got) == 3
    marked = reconcile.group_absence(d, ["k"], F.col("v") % 2 == 0)
    assert {(r.k, r.absence) for r in marked.collect()} == {("hot", "some"), ("cold", "none"), (None, "all")} and marked.columns == ["k", "v", "absence"]


def test_inventory_in_numeric_order(spark):
    e = spark.createDataFrame([("d", v) for v in ("01", "02", "10")], "d string, v string")
    a = spark.createDataFrame([("d", v) for v in ("02", "9", "11")], "d string, v string")
    r = reconcile.inventory(e, a, ["d", "v"], ["d"], F.col("v").cast("int")).first()
    assert (r.present, r.missing, r.unexpected) == (1, ["01", "10"], ["9", "11"])


@pytest.mark.parametrize("vocabulary", [[], ["a", "a"]])
def test_vocabularies_are_checked(spark, vocabulary):
    with pytest.raises(ValueError):
        scoring.vocabulary_index(F.lit("a"), vocabulary)


@pytest.mark.parametrize("span", [4, 4096])
def test_digests_of_ordered_groups_of_any_size(spark, span):
    import hashlib

    sha = lambda *parts: hashlib.sha256(";".join(parts).encode()).hexdigest()

    def tree(parts):
        level = [sha(*parts[i : i + span]) for i in range(0, len(parts), span)]
        while len(level) > 1:
            level = [level[i] if len(level[i : i + span]) == 1 else sha(*level[i : i + span]) for i in range(0, len(level), span)]
        return level[0]

    groups = {"a": 1, "b": 4, "c": 5, "d": 17, "e": 60}
    rows = [(g, i, f"{g}{i * 7 % 13}") for g, n in groups.items() for i in range(1, n + 1)]
    d = spark.createDataFrame(rows[::-1], "g string, at int, x string")
    assert {r.g: r.digest for r in lineage.ordered_digest(d, ["g"], "at", F.col("x"), span=span).collect()} == {g: tree([x for k, _, x in rows if k == g]) for g in groups}
    # order counts: two parts that change places
    swapped = d.withColumn("at", F.when(F.col("at") == 2, 3).when(F.col("at") == 3, 2).otherwise(F.col("at")))
    same = {r.g: r.digest for r in lineage.ordered_digest(d, ["g"], "at", F.col("x"), span=span).collect()}
    assert {r.g for r in lineage.ordered_digest(swapped, ["g"], "at", F.col("x"), span=span).collect() if r.digest == same[r.g]} == {"a"}
    # sets: equal in any order, the parts joined where they are few, and no array longer than a bucket
    sets = lambda x: {r.g: r.digest for r in lineage.group_digest(x, ["g"], F.col("x"), span=span).collect()}
    got = sets(d)
    assert got == sets(d.orderBy("x")) and all(got[g] == sha(*sorted(x for k, _, x in rows if k == g)) for g, n in groups.items() if n <= span)
    changed = sets(d.withColumn("x", F.when((F.col("g") == "e") & (F.col("at") == 30), "new").otherwise(F.col("x"))))
    assert {g for g in groups if changed[g] != got[g]} == {"e"}
    # many rows of one place are told by their ends and number, not gathered
    many = spark.range(1000).select(F.lit("g").alias("g"), F.lit(1).alias("at"), F.col("id").cast("string").alias("x"))
    assert lineage.ordered_digest(many, ["g"], "at", F.col("x"), span=span).first().digest == sha("0#999#1000")
