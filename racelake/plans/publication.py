"""Publishing jobs: labels and snapshots, written, read back by content, and reported by date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, pit, reconcile
from ..sources import text_files as S
from ..sources.content import joined_status, write_checked
from . import binding, racing
from .racing import ENTRY, RACE


def _candidate(spark: SparkSession, df: DataFrame, root: str, name: str) -> DataFrame:
    """df written once under root/candidate, so that what is digested is what is stored."""
    df.write.mode("overwrite").parquet(f"{root}/candidate/{name}")
    return spark.read.schema(df.schema).parquet(f"{root}/candidate/{name}")


def publish_labels(spark: SparkSession, labels: DataFrame, sources: DataFrame, root: str, keys: Sequence[str] = ENTRY, differences: DataFrame | None = None, order: Sequence[str] = RACE) -> DataFrame:
    """binding.build_labels(), stored under root/labels by date and read back: its report with read_back among the failures of a date whose stored cells are not those that were built, or whose counts of rows and races differ."""
    good, report = binding.build_labels(labels, sources, keys, differences)
    report = _candidate(spark, report, root, "report")
    made = _candidate(spark, good, root, "labels")
    content = write_checked(made, f"{root}/labels", keys, order=order)
    content = _candidate(spark, content, root, "content")
    counts = made.groupBy("race_date").agg(F.count("*").alias("row_count"), F.count_distinct(F.struct(*RACE)).alias("race_count"))
    stored = spark.read.schema(made.schema).parquet(f"{root}/labels").select(made.columns)
    agrees = S.readback(stored, counts, races=RACE, schema=made.schema).select("race_date", "agrees")
    out = joined_status(report, content).join(agrees, "race_date", "left")
    lost = F.col("agrees").isNotNull() & ~F.col("agrees") & (F.col("read_back") == 0)
    out = out.withColumn("failures", F.when(lost, F.concat_ws(",", F.when(F.col("failures") != "", F.col("failures")), F.lit("read_back"))).otherwise(F.col("failures"))).drop("agrees")
    return out.withColumn("status", F.when(F.col("failures") == "", "SUCCESS").otherwise("FAILED"))


#: What ends a date, first that is found: measure, status, reason.
_ENDS = (
    ("without_sidecar", "SKIPPED_PROVENANCE_MISSING", "no sidecar, or several"),
    ("incomplete_sidecar", "SKIPPED_PROVENANCE_MISSING", "the sidecar lacks fields"),
    ("without_file", "SKIPPED_PROGRAM_UNAVAILABLE", "the sidecar's file is not there"),
    ("content_differs", "SKIPPED_HASH_MISMATCH", "the file is not the one that the sidecar describes"),
    ("bad_time", "SKIPPED_METADATA_INVALID", "a time without offset, or none"),
    ("late", "SKIPPED_FETCHED_AFTER_AS_OF", "fetched after the cut-off"),
    ("without_rows", "SKIPPED_PROGRAM_UNAVAILABLE", "the program has no row"),
    ("audit", pit.INTEGRITY, "the snapshot's audit fails"),
    ("read_back", pit.INTEGRITY, "what is stored differs from what was made"),
)
SIDECAR = ("race_date", "source_file", "source_url", "source_sha256", "source_bytes", "fetched_at", "snapshot_at", "collector_version", "deadline_evidence_sha256")


def decide(measures: DataFrame) -> DataFrame:
    """measures (race_date and the counts of _ENDS; null counts as fault) with status, eligible, reason, as_of_time, the record of these five, and the violated rules of a decision (none, if all is well)."""
    status, reason = F.lit(None), F.lit(None)
    for name, s, r in reversed(_ENDS):
        bad = F.coalesce(F.col(name), F.lit(1)) > 0
        status, reason = F.when(bad, s).otherwise(status), F.when(bad, r).otherwise(reason)
    d = measures.withColumn("status", F.coalesce(status, F.lit(pit.ELIGIBLE))).withColumn("reason", F.coalesce(reason, F.lit("fetched by the cut-off, stored as made")))
    d = d.withColumn("eligible", F.col("status") == pit.ELIGIBLE).withColumn("as_of_time", pit.as_of_instant(F.col("race_date")))
    d = d.withColumn("record", F.struct("status", "eligible", "reason", "race_date", "as_of_time"))
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in pit.decision_rules().items()]
    return d.withColumn("violations", F.filter(F.array(*broken), lambda x: x.isNotNull()))


def publish_snapshot(spark: SparkSession, program: DataFrame, sidecars: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """One decision for each date that the program, a sidecar or a file's sidecar names; the snapshots of eligible dates are stored under root/snapshot and read back.

    sidecars: SIDECAR fields (times as texts with an offset) and `missing`, as read_sidecars() gives them; files: file, length, sha256 and content,
    as read_encoded() does.  A sidecar needs its file (source_file) with the recorded size, digest and archive head; a date needs one sidecar."""
    n = checks.count_where
    cars = _candidate(spark, sidecars.select(*SIDECAR, "missing"), root, "sidecars")
    recorded = cars.select(F.col("source_file").alias("file"), F.col("source_bytes").alias("length"), F.col("source_sha256").alias("sha256")).dropDuplicates(["file", "length", "sha256"])
    wrong = S.audit_content(files, recorded).groupBy("file").agg(F.array_distinct(F.flatten(F.collect_list("differences"))).alias("_wrong"))
    cars = cars.join(wrong, cars["source_file"] == wrong["file"], "left").drop("file")
    fetched, made_at = pit.aware(F.col("fetched_at")), pit.aware(F.col("snapshot_at"))
    absent = F.coalesce(F.array_contains("_wrong", "absent"), F.lit(True))
    per = cars.groupBy("race_date").agg(
        (F.count("*") - 1).alias("without_sidecar"), n(F.size("missing") > 0).alias("incomplete_sidecar"), n(absent).alias("without_file"), n(~absent & (F.size("_wrong") > 0)).alias("content_differs"), n(fetched.isNull() | made_at.isNull()).alias("bad_time"),
        n(pit.eligibility(fetched, pit.as_of_instant(F.col("race_date"))) == pit.AFTER_AS_OF).alias("late"),
    )
    rows = program.groupBy("race_date").agg(F.lit(0).cast("long").alias("without_rows"))
    measures = reconcile.full_outer(per, rows, ["race_date"]).drop("side")
    sources = cars.select("race_date", fetched.alias("fetched_at"), made_at.alias("snapshot_at"), "source_url", "source_sha256", "collector_version", "deadline_evidence_sha256")
    zero = ["without_sidecar", "incomplete_sidecar", "without_file", "content_differs", "bad_time", "late", "without_rows"]
    measures = _candidate(spark, checks.gate(measures, zero), root, "measures")
    sound = F.broadcast(measures.filter("status = 'SUCCESS'").select("race_date"))  # a row for each date
    made = _candidate(spark, racing.snapshot(program.join(sound, "race_date", "left_semi"), sources.join(sound, "race_date", "left_semi")), root, "snapshot")
    audit = _candidate(spark, racing.snapshot_audit(made), root, "audit")
    good = made.join(F.broadcast(audit.filter("status = 'SUCCESS'").select("race_date")), "race_date", "left_semi")
    content = write_checked(good, f"{root}/snapshot", ENTRY, order=["venue_code", "race_no", "boat_no"])
    content = _candidate(spark, content, root, "content")
    audited = audit.select("race_date", (F.col("status") != "SUCCESS").cast("long").alias("audit"), F.col("failures").alias("audit_failures"))
    back = content.select("race_date", F.size("differs").cast("long").alias("read_back"), F.col("differs").alias("read_back_differs"))
    out = measures.select("race_date", *zero).join(audited, "race_date", "left").join(back, "race_date", "left")
    return decide(out)
