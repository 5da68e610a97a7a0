"""Lineage jobs on small tables with one fault each."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racelake.operators import lineage
from racelake.plans import binding as B


def grid(spark, skip=None, racer=5000):
    rows = [("2026-07-01", v, r, b, f"{racer + b:04d}") for v in ("01", "02") for r in range(1, 13) for b in range(1, 7) if (v, r) != skip]
    return spark.createDataFrame(rows, "race_date string, venue_code string, race_no long, boat_no long, racer_id string")


def test_bindings(spark):
    deadlines = spark.createDataFrame([("2026-07-01", v, v * 32, "a" * 64) for v in ("01", "02")], "race_date string, venue_code string, deadline_sha256 string, program_sha256 string")
    one = {r.venue_code: r for r in B.bind_venues(grid(spark), deadlines).collect()}
    other = grid(spark).withColumn("racer_id", F.when(F.col("venue_code") == "02", F.lit("9999")).otherwise(F.col("racer_id"))).orderBy(F.desc("race_no"))
    two = {r.venue_code: r for r in B.bind_venues(other, deadlines).collect()}
    assert one["01"] == two["01"] and one["02"].binding_sha256 != two["02"].binding_sha256
    short = {r.venue_code: r.status for r in B.bind_venues(grid(spark, ("01", 12)), deadlines.filter("venue_code = '01'")).collect()}
    assert short == {"01": "RACES_INCOMPLETE", "02": "DEADLINE_MISSING"}
    c = B.collect_bindings(B.bind_venues(grid(spark), deadlines)).first()
    assert (c.entry_count, c.total_bytes, c.bad_sizes, c.bad_digests, c.bad_places) == (2, 128, 0, 0, 0)
    changed = B.collect_bindings(B.bind_venues(other, deadlines)).first()
    assert c.collection_sha256 != changed.collection_sha256
    entries = spark.createDataFrame([("d", 1, "a" * 64, 5), ("d", 3, "x", 0), ("d", 3, "b" * 64, 2)], "d string, at int, sha string, size int")
    bad = lineage.collection_digest(entries, ["d"], "at", "sha", "size").first()
    assert (bad.entry_count, bad.total_bytes, bad.bad_sizes, bad.bad_digests, bad.bad_places) == (3, 7, 1, 1, 2)
    ids = spark.createDataFrame([("2026-07-01", "c", "a"), ("2026-07-01", "c", "a"), ("2026-07-01", "c", "b")], "d string, commit string, a string")
    assert len({r[0] for r in ids.select(lineage.run_id("d", "commit", "a")).collect()}) == 2


def test_labels_need_a_source(spark):
    results = grid(spark)
    side = lambda *rows: spark.createDataFrame(list(rows), "race_date string, fetched_at string, source_sha256 string, source_url string, collector_version string, missing array<string>")
    good = ("2026-07-01", "2026-07-02T00:00:00+09:00", "d" * 64, "u", "c1", [])
    labels, report = B.build_labels(results, side(good))
    assert report.first().status == "SUCCESS" and labels.count() == results.count()
    assert labels.columns == [*results.columns, *B.LABEL_PROVENANCE]
    r = labels.first()
    assert (r.label_source_fetched_at, r.label_source_max_time, r.label_contract_version, r.label_provenance_status) == ("2026-07-01T15:00:00Z", "2026-07-01T15:00:00Z", B.LABEL_CONTRACT, "VERIFIED")
    failures = lambda d, s, **k: B.build_labels(d, s, **k)[1].first().failures
    labels, report = B.build_labels(results.union(results.limit(1)), side(good).filter("false"))
    assert report.first().failures == "without_source,duplicates" and labels.count() == 0
    assert failures(results, side((*good[:5], ["source_url"]))) == "source_incomplete"
    assert failures(results, side((good[0], "2026-07-02T00:00:00", *good[2:]))) == "bad_source_time"
    found = spark.createDataFrame([("2026-07-01", ["sha256"])], "race_date string, differences array<string>")
    assert failures(results, side(good), differences=found) == "source_differs"
    assert failures(results.withColumn("racer_id", F.when(F.col("boat_no") > 1, F.col("racer_id"))), side(good)).startswith("null_keys")
    with pytest.raises(ValueError):
        B.build_labels(results.withColumn("as_of_time", F.lit(1)), side(good))


def evidence(spark, step=30, races=range(1, 13), code=200, kind="CLOSE", started="2026-06-30T23:59:00Z", digest="a" * 64, more=None, sha="a" * 64, venue="01"):
    at = lambda i: f"2026-07-01T{(60 + i * step) // 60:02d}:{(60 + i * step) % 60:02d}:00Z"
    doc = {"contract_version": "v", "source_name": "n", "source_authority": "a", "source_locator": "l", "source_timezone": "Asia/Tokyo", "request_started_at": started, "fetched_at": "2026-07-01T09:00:00+09:00", "http_status": code, "response_headers": {}, "raw_source_sha256": digest, "race_date": "2026-07-01", "venue_code": venue}
    doc["race_deadlines"] = [{"race_no": r, "deadline_kind": kind if r > 1 else "CLOSE", "scheduled_deadline_at": at(i)} for i, r in enumerate(races)]
    return spark.createDataFrame([(json.dumps(doc | (more or {})), sha)], "document string, sha256 string")


@pytest.mark.parametrize("fault,want", [
    ({}, ""), ({"step": 4}, "gaps"), ({"races": range(1, 12)}, "races"), ({"code": 500}, "bad_status"), ({"kind": "OPEN"}, "kinds"), ({"started": "2026-07-01T00:00:01Z"}, "started_late"),
    ({"started": "2026-07-01T00:00:00"}, "bad_times"), ({"digest": "b" * 64}, "bad_digest"), ({"more": {"extra": 1}}, "fields"), ({"more": {"source_name": " "}}, "fields"), ({"more": {"fetched_at": "2026-07-01T01:00:00Z"}}, "after_deadline"),
])
def test_deadlines(spark, fault, want):
    assert B.deadline_rules(B.read_deadlines(evidence(spark, **fault))).first().failures == want


def test_collected_deadlines(spark):
    docs = evidence(spark).union(evidence(spark, venue="10")).union(evidence(spark, venue="02", code=404))
    expected = spark.createDataFrame([("2026-07-01", v) for v in ("01", "02", "03")], "race_date string, venue_code string")
    r = B.collect_deadlines(B.read_deadlines(docs), expected).first()
    assert (r.present, r.missing, r.unexpected, r.entry_count) == (1, ["02", "03"], ["10"], 2)


def test_certificate(spark):
    d = grid(spark).withColumn("as_of", F.to_timestamp(F.lit("2026-06-30T12:30:00Z"))).withColumn("fetched", F.to_timestamp(F.lit("2026-06-30T12:30:00Z"))).withColumn("source_file", F.concat("venue_code", F.lit(".txt")))
    keys = ["race_date", "venue_code", "race_no", "boat_no"]
    failures = lambda x, contract=d.schema, **k: B.certify(x, contract, keys, ["course"], "as_of", "fetched", **k).first().failures
    assert B.certify(d, d.schema, keys, ["course"], "as_of", "fetched").first().status == "SUCCESS"
    bad = d.filter("not (race_no = 1 and boat_no = 1)").withColumn("course", F.lit(1))
    assert failures(bad) == "schema_differs,forbidden_columns,wrong_sizes,wrong_boats"
    strict = T.StructType([T.StructField(f.name, f.dataType, f.name == "racer_id") for f in d.schema])
    assert failures(d.withColumn("race_no", F.when(F.col("boat_no") > 0, F.col("race_no"))), strict) == "schema_differs"
    assert failures(d.select(*reversed(d.columns))) == "schema_differs"
    one = (F.col("race_no") == 1) & (F.col("boat_no") == 1) & (F.col("venue_code") == "01")
    assert failures(d.withColumn("source_file", F.when(one, "x").otherwise(F.col("source_file"))), one_value=["source_file"]) == "mixed_values"
    assert failures(d, fixed={"race_date": "2026-07-02"}) == "fixed_values"
    assert failures(d, manifest='{"a": [{"b": {" Payout ": 1}}]}') == "forbidden_keys"
    assert failures(d.withColumn("fetched", F.when(~one, F.col("fetched")))) == "late_rows"
    placed = d.withColumn("pos", F.when(one, 99).otherwise(F.col("race_no") * 6 + F.col("boat_no") - 6))
    assert failures(placed, placed.schema, position=["pos"]) == "order"
    assert failures(placed.withColumn("pos", F.col("race_no") * 6 + F.col("boat_no")), placed.schema, position=["pos"]) == ""


def test_certificate_of_a_dataset_as_it_is_written(spark, tmp_path):
    at = F.to_timestamp(F.lit("2026-06-30T12:30:00Z"))
    given = lambda c: F.when(F.col("boat_no") > 0, c)  # noqa: E731  may be null
    d = grid(spark).withColumns({"as_of": at, "fetched": at, "source_time": given(at), "age": given(30.0), "digest": given("d" * 64)}).coalesce(2)
    keys = ["race_date", "venue_code", "race_no", "boat_no"]
    rules = {"ranges": {"age": (15, 99), "race_no": (1, 12)}, "integers": ["age"], "texts": {"racer": F.col("racer_id").rlike("^[0-9]{4}$")}, "provenance": ["digest"], "same_times": [("fetched", "source_time")], "one_digest": ["digest"], "fixed": {"race_date": "2026-07-01"}}
    artifacts = spark.createDataFrame([("a", "program", ""), ("b", "dataset", "digest_differs")], "artifact_id string, kind string, failures string")
    n = iter(range(99))

    def failures(x, **k):
        path = str(tmp_path / str(next(n)))
        row = B.certify(x, d.schema, keys, ["course"], "as_of", "fetched", path=path, **rules, **k).first()
        assert row.failures == B.certify(x, d.schema, keys, ["course"], "as_of", "fetched", **rules, **k).first().failures and row.rows == x.count() == spark.read.parquet(path).count()
        return row.failures

    one = (F.col("race_no") == 1) & (F.col("boat_no") == 1) & (F.col("venue_code") == "01")
    with_odd = lambda c, v: d.withColumn(c, F.when(one, v).otherwise(F.col(c)).cast(d.schema[c].dataType))
    assert failures(d) == ""
    assert failures(with_odd("age", 14.0)) == "out_of_range" and failures(with_odd("age", float("nan"))) == "out_of_range,not_integral" and failures(with_odd("age", 30.5)) == "not_integral"
    assert failures(with_odd("racer_id", "12x4")) == "bad_text" and failures(with_odd("racer_id", None)) == "bad_text"
    assert failures(with_odd("digest", None)) == "null_provenance,mixed_digests" and failures(with_odd("digest", "e")) == "mixed_digests"
    assert failures(with_odd("source_time", F.to_timestamp(F.lit("2026-06-30T12:29:00Z")))) == "times_apart"
    assert failures(d, chain=artifacts) == "chain" and failures(d, chain=artifacts.filter("kind = 'program'")) == ""
    # the dataset is computed once, while it is stored
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    B.certify(d.mapInArrow(counted, d.schema), d.schema, keys, [], "as_of", "fetched", path=str(tmp_path / "once"), **rules).collect()
    assert seen.value == d.count()


def test_manifest_chain(spark):
    kinds = {"deadlines": [], "program": [], "binding": ["deadlines", "program"], "dataset": ["binding", "program"]}
    artifacts = [("d1", "deadlines", "v1", "1", "2026-07-01"), ("p1", "program", "v1", "2", "2026-07-01"), ("b1", "binding", "v1", "3", "2026-07-01"), ("s1", "dataset", "v2", "4", "2026-07-01")]
    references = [("b1", "deadlines", "d1", "1"), ("b1", "program", "p1", "2"), ("s1", "binding", "b1", "3"), ("s1", "program", "p1", "2")]

    def audit(arts, refs):
        a = spark.createDataFrame(arts, "artifact_id string, kind string, contract_version string, sha256 string, race_date string")
        r = spark.createDataFrame(refs, "artifact_id string, parent_kind string, parent_id string, recorded_sha256 string")
        versions = {"deadlines": "v1", "program": "v1", "binding": "v1", "dataset": "v2"}
        return {x.artifact_id: x.failures for x in lineage.manifest_chain(a, r, kinds, versions, ["race_date"]).collect() if x.failures}

    assert audit(artifacts, references) == {}
    assert audit(artifacts, references[1:]) == {"b1": "parents_differ"}
    assert audit([*artifacts[:3], ("s1", "dataset", "v1", "4", "2026-07-01")], references) == {"s1": "version_differs"}
    assert audit([*artifacts[:2], ("b1", "binding", "v1", "9", "2026-07-01"), artifacts[3]], references) == {"s1": "digest_differs"}
    assert audit([("d1", "deadlines", "v1", "1", "2026-07-02"), *artifacts[1:]], references) == {"b1": "identity_differs"}
    assert audit(artifacts, [*references[:3], ("s1", "program", "p1", "0")]) == {"s1": "digest_differs,references_disagree", "b1": "references_disagree"}
    assert audit(artifacts, [references[0], ("b1", "program", "d1", "1"), *references[2:]]) == {"b1": "parent_kind_differs"}
    assert audit(artifacts[1:], references) == {"b1": "parent_missing"}


def test_packages_and_records(spark):
    files = lambda rows: spark.createDataFrame(rows, "m string, name string, sha256 string")
    bound = lambda rows: spark.createDataFrame(rows, "m string, name string, recorded_sha256 string")
    state = lambda rows: spark.createDataFrame(rows, "m string, decision string, authority_status string")
    whole = [(m, n, f"{m}{n}") for m in "abcdef" for n in ("x", "y")]
    got = lineage.package_audit(
        files([f for f in whole if f != ("b", "y", "by")]), bound([(m, "x", f"{m}x" if m != "c" else "?") for m in "abcdefg"]), state([("a", "APPROVED", "ACTIVE"), ("b", "APPROVED", "ACTIVE"), ("c", "APPROVED", "ACTIVE"), ("d", "REJECTED", "ACTIVE"), ("e", "APPROVED", "REVOKED")]), ["m"], ["x", "y"]
    )
    assert {r.m: r.failures for r in got.collect()} == {"a": "", "b": "file_set", "c": "binding_differs", "d": "not_approved", "e": "not_active", "f": "approval_count", "g": "file_set,binding_differs,approval_count"}
    records = [(r, n, f"/{r}/{n}", 5, "AB") for r in ("1", "2", "3", "4", "5", "6") for n in ("x", "y")]
    records = [x for x in records if x[:2] != ("2", "y")]
    records = [("3", "x", " ", 5, "AB") if x[:2] == ("3", "x") else x for x in records]
    listing = [(f"/{r}/{n}", 6 if (r, n) == ("5", "x") else 5, "cd" if (r, n) == ("6", "x") else "ab") for r in "123456" for n in "xy" if (r, n) != ("4", "x")]
    got = lineage.artifact_records(spark.createDataFrame(records, "run string, name string, path string, size long, sha256 string"), spark.createDataFrame(listing, "path string, length long, sha256 string"), ["run"], ["x", "y"])
    assert {r.run: r.failures for r in got.collect()} == {"1": "", "2": "name_set", "3": "path_blank", "4": "file_missing", "5": "size_differs", "6": "digest_differs"}


def events(spark, *rows):
    full = [("l", s, k, "m", own, before, *times) for s, k, own, before, *times in rows]
    return spark.createDataFrame(full, "log_id string, sequence int, kind string, model_id string, event_sha256 string, previous_event_sha256 string, authorized_at int, published_at int, effective_at int")


@pytest.mark.parametrize("second,want", [
    ((2, "REVOKE", "b", "a", 2, 2, 2), ""), ((3, "ACTIVATE", "b", "a", 2, 2, 2), "numbering"), ((2, "ACTIVATE", "b", "x", 2, 2, 2), "chain"), ((2, "ACTIVATE", "b", "a", 0, 0, 2), "published_order"),
    ((2, "ACTIVATE", "b", "a", 3, 2, 2), "authorized_late"), ((2, "ACTIVATE", "b", "a", 2, 3, 2), "effective_early"), ((2, "ACTIVATE", "a", "a", 2, 2, 2), "repeated_ids"), ((2, "ACTIVATE", "b", "a", None, 2, 2), "authorized_late"),
])
def test_model_events(spark, second, want):
    assert B.audit_model_events(events(spark, (1, "APPROVE", "a", None, 1, 1, 1), second)).first().failures == want


def test_ended_models_and_states(spark):
    ended = events(spark, (1, "REVOKE", "a", None, 1, 1, 3), (2, "ACTIVATE", "b", "a", 2, 2, 2))
    assert B.audit_model_events(ended).first().failures == "effective_order,after_end"
    log = events(spark, (1, "APPROVE", "a", None, 1, 1, 1), (2, "ACTIVATE", "b", "a", 2, 2, 5))
    assert [(r.kind, r.sequence) for r in B.model_states(log).collect() + B.model_states(log, F.lit(4)).collect()] == [("ACTIVATE", 2), ("APPROVE", 1)]
