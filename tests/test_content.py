"""Read-back by content, and the label and snapshot jobs that end with it."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from test_binding import grid
from test_racing import day, files

from racelake.plans import publication as P
from racelake.plans import racing as R
from racelake.sources import content as C
from racelake.sources import text_files as S

ROWS = [("d1", 1, "a", 1.5, [1, 2], {"k": 1}), ("d1", 2, "b", 2.5, None, None), ("d1", 3, None, None, [], {}), ("d2", 1, "a", 1.5, [3], {"k": 1}), ("d2", 2, "c", 0.5, [4], {"j": 2})]
SHAPE = "day string, key int, x string, y double, z array<int>, m map<string,int>"


def differs(spark, rows, other=ROWS):
    digests = [C.column_digests(spark.createDataFrame(r, SHAPE), ["key"], ["day"]) for r in (other, rows)]
    return {r.day: r.differs for r in C.content_report(*digests, ["day"]).collect()}


def test_each_fault_is_named_by_its_column(spark):
    at = lambda i, k, v: [(*r[:k], v, *r[k + 1 :]) if j == i else r for j, r in enumerate(ROWS)]
    assert differs(spark, ROWS[::-1]) == {"d1": [], "d2": []}
    assert differs(spark, at(0, 2, "z")) == {"d1": ["x"], "d2": []}
    assert differs(spark, at(1, 4, [])) == {"d1": ["z"], "d2": []}
    assert differs(spark, at(4, 5, {"j": 3})) == {"d1": [], "d2": ["m"]}
    assert differs(spark, at(2, 3, 0.0)) == {"d1": ["y"], "d2": []}
    # two cells of a column change places: the column's values are the same, their rows are not
    swapped = at(0, 2, "b")
    swapped[1] = (*ROWS[1][:2], "a", *ROWS[1][3:])
    assert differs(spark, swapped) == {"d1": ["x"], "d2": []}
    assert differs(spark, ROWS[1:])["d1"] == ["day", "key", "m", "x", "y", "z", C.ROWS]
    assert C.ROWS in differs(spark, [*ROWS, ROWS[3]])["d2"] and differs(spark, ROWS[:3])["d2"][-1] == C.ROWS
    # a lost row that another one replaces
    assert differs(spark, [*ROWS[:4], ROWS[3]]) == {"d1": [], "d2": ["day", "key", "m", "x", "y", "z"]}
    # cells that change places between two rows of one key
    two = [("d1", 1, "a", 1.0, None, None), ("d1", 1, "b", 2.0, None, None)]
    assert differs(spark, [("d1", 1, "b", 1.0, None, None), ("d1", 1, "a", 2.0, None, None)], two) == {"d1": [C.ROW]}
    frame = spark.createDataFrame(ROWS, SHAPE)
    lacking = C.content_report(C.column_digests(frame, ["key"]), C.column_digests(frame.drop("y"), ["key"])).first()
    assert lacking.differs == ["y"] and lacking.status == "FAILED"
    none = C.content_report(C.column_digests(frame.filter("false"), ["key"]), C.column_digests(frame.filter("false"), ["key"])).first()
    assert (none.rows_written, none.status) == (0, "SUCCESS")


def test_written_days_are_read_back(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame(ROWS, SHAPE)
    path = str(tmp_path / "t")
    assert {r.day: r.status for r in C.write_checked(frame, path, ["key"], "day").collect()} == {"d1": "SUCCESS", "d2": "SUCCESS"}
    # a writer that spoils a cell of one day
    real = S.write_days
    monkeypatch.setattr(C, "write_days", lambda df, *a, **k: real(df.withColumn("x", F.when((F.col("day") == "d2") & (F.col("key") == 2), "odd").otherwise(F.col("x"))), *a, **k))
    got = C.write_checked(frame, str(tmp_path / "u"), ["key"], "day")
    assert {r.day: (r.status, r.differs) for r in got.collect()} == {"d1": ("SUCCESS", []), "d2": ("FAILED", ["x"])}


SOURCES = "race_date string, fetched_at string, source_sha256 string, source_url string, collector_version string, missing array<string>"


def test_labels_are_published_and_read_back(spark, tmp_path, monkeypatch):
    results = grid(spark)
    sources = spark.createDataFrame([("2026-07-01", "2026-07-02T00:00:00+09:00", "d" * 64, "u", "c1", [])], SOURCES)
    report = P.publish_labels(spark, results, sources, str(tmp_path / "a")).first()
    assert (report.status, report.read_back, report.read_back_differs) == ("SUCCESS", 0, [])
    assert spark.read.parquet(str(tmp_path / "a/labels")).count() == results.count()
    real = S.write_days
    monkeypatch.setattr(C, "write_days", lambda df, *a, **k: real(df.filter("boat_no <> 6"), *a, **k))
    report = P.publish_labels(spark, results, sources, str(tmp_path / "b")).first()
    assert (report.status, report.failures) == ("FAILED", "read_back") and report.read_back_differs[-1] == C.ROWS
    failed = P.publish_labels(spark, results, sources.withColumn("missing", F.array(F.lit("source_url"))), str(tmp_path / "c")).first()
    assert failed.failures == "source_incomplete" and failed.read_back == 0


@pytest.fixture(scope="module")
def downloads(spark, tmp_path_factory):
    """Files and sidecars of seven dates, a fault in all but the first: (program, sidecars, files)."""
    root = tmp_path_factory.mktemp("downloads")
    (root / "files").mkdir()
    (root / "cars").mkdir()
    programs = []
    for k in range(1, 8):
        body = b"\x1c\x2a-lh5-\x01" + f"file {k}".encode()
        if k != 3:
            (root / f"files/b2607{k:02d}.lzh").write_bytes(body if k != 4 else body.replace(b"file", b"life"))
        car = {"race_date": f"2026-07-{k:02d}", "source_file": f"b2607{k:02d}.lzh", "source_url": "u", "source_sha256": hashlib.sha256(body).hexdigest(), "source_bytes": len(body), "collector_version": "c1", "deadline_evidence_sha256": "e" * 64}
        car |= {x: "2026-06-30T21:00:00+09:00" if k != 6 else "2026-07-05T21:30:01+09:00" for x in ("fetched_at", "snapshot_at")}
        if k == 2:
            car["source_url"] = None
        if k == 5:
            car["fetched_at"] = "2026-07-04T10:00:00"
        if k != 7:
            (root / f"cars/b2607{k:02d}.json").write_text(json.dumps(car))
        programs.append((f"B2607{k:02d}.TXT", day(races=1)[0]))
    program, _ = R.parse_program(files(spark, *programs))
    shape = ", ".join(f"{c} {'long' if c == 'source_bytes' else 'string'}" for c in P.SIDECAR)
    cars = S.read_sidecars(spark, str(root / "cars"), spark.createDataFrame([], shape).schema, P.SIDECAR)
    there = spark.read.format("binaryFile").load(str(root / "files"))
    there = there.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content", "length", F.sha2("content", 256).alias("sha256"))
    return program, cars, there


def test_sidecars_name_their_path(downloads):
    _, cars, _ = downloads
    assert {r.file for r in cars.collect()} == {f"b2607{k:02d}.json" for k in range(1, 7)} and all(r.path.endswith(r.file) for r in cars.collect())
    assert {r.race_date: r.missing for r in cars.collect() if r.missing} == {"2026-07-02": ["source_url"]}


def test_snapshot_decides_each_date(spark, downloads, tmp_path, monkeypatch):
    program, cars, there = downloads
    root = str(tmp_path / "a")
    got = {r.race_date: r for r in P.publish_snapshot(spark, program, cars, there, root).collect()}
    assert {k: r.status for k, r in got.items()} == {
        "2026-07-01": "ELIGIBLE", "2026-07-02": "SKIPPED_PROVENANCE_MISSING", "2026-07-03": "SKIPPED_PROGRAM_UNAVAILABLE", "2026-07-04": "SKIPPED_HASH_MISMATCH", "2026-07-05": "SKIPPED_METADATA_INVALID",
        "2026-07-06": "SKIPPED_FETCHED_AFTER_AS_OF", "2026-07-07": "SKIPPED_PROVENANCE_MISSING",
    }
    assert all(r.violations == [] and r.eligible == (r.status == "ELIGIBLE") and r.record.reason == r.reason for r in got.values())
    stored = spark.read.parquet(f"{root}/snapshot")
    assert [str(r[0]) for r in stored.select("race_date").distinct().collect()] == ["2026-07-01"] and stored.count() == 6 and len(stored.columns) == 33
    # without rows of the program; with a stored cell that differs
    assert P.publish_snapshot(spark, program.filter("race_date > '2026-07-01'"), cars, there, str(tmp_path / "b")).filter("race_date = '2026-07-01'").first().status == "SKIPPED_PROGRAM_UNAVAILABLE"
    real = S.write_days
    monkeypatch.setattr(C, "write_days", lambda df, *a, **k: real(df.withColumn("motor_no", F.col("motor_no") + 1), *a, **k))
    r = P.publish_snapshot(spark, program, cars, there, str(tmp_path / "c")).filter("race_date = '2026-07-01'").first()
    assert (r.status, r.read_back_differs) == ("SKIPPED_OUTPUT_INTEGRITY_ERROR", ["motor_no"])


def test_archive_heads(spark):
    rows = [("a", b"..-LH5-..."), ("b", b"..-lhx-"), ("c", b"-lh"), ("d", b"-lh55-"), ("e", b"x" * 70 + b"-lh5-")]
    d = spark.createDataFrame(rows, "file string, content binary").withColumns({"length": F.length("content"), "sha256": F.lit("s")})
    assert {r.file: r.differences for r in S.audit_content(d, d.select("file", "length", "sha256")).collect()} == {"a": [], "b": [], "c": ["magic"], "d": ["magic"], "e": ["magic"]}
