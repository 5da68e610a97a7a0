"""Point-in-time rules: what was known before a cut-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BY_AS_OF, AFTER_AS_OF = "FETCHED_BY_AS_OF", "FETCHED_AFTER_AS_OF"
_OFFSET = r"(Z|[+-]\d{2}:\d{2})$"


def as_of_local(day: Column) -> Column:
    """The evening before the day, 21:30, without zone."""
    return F.expr("INTERVAL '21:30' HOUR TO MINUTE") + F.date_sub(F.to_date(day), 1).cast("timestamp_ntz")


def as_of_instant(day: Column, zone: str = "Asia/Tokyo") -> Column:
    """The same as an instant (session zone UTC)."""
    return F.to_utc_timestamp(as_of_local(day).cast("timestamp"), zone)


def eligibility(fetched: Column, as_of: Column) -> Column:
    """Fetched at the cut-off itself is still in time."""
    return F.when(fetched <= as_of, BY_AS_OF).when(fetched > as_of, AFTER_AS_OF)


def aware(text: Column) -> Column:
    """An ISO-8601 text with an offset as an instant, else null; Spark alone would read a text without offset in the session zone."""
    return F.when(text.rlike(_OFFSET), F.try_to_timestamp(text))


# Statuses of a decision, and the words in an error's text that tell each skipped one; the first that is found decides.
ELIGIBLE, UNAVAILABLE, INTEGRITY = "ELIGIBLE", "SKIPPED_PROGRAM_UNAVAILABLE", "SKIPPED_OUTPUT_INTEGRITY_ERROR"
TAXONOMY = (
    ("SKIPPED_CONTRACT_VERSION_UNSUPPORTED", ("contract version", "contract_version", "unsupported contract", "version unsupported")),
    ("SKIPPED_FETCHED_AFTER_AS_OF", ("fetched after", "after as_of", "after as of", "future source", "future_source", "late live run")),
    ("SKIPPED_HASH_MISMATCH", ("hash mismatch", "sha256 mismatch", "sha-256 mismatch", "response_sha256 mismatch")),
    ("SKIPPED_PROVENANCE_MISSING", ("provenance missing", "missing provenance", "provenance_missing", "sidecar missing", "missing sidecar")),
    ("SKIPPED_INVALID_RACE_STRUCTURE", ("invalid race structure", "race structure", "six boats", "6 boats", "six racers", "duplicate boat", "duplicate racer")),
    ("SKIPPED_PROHIBITED_FEATURE", ("prohibited feature", "forbidden feature", "feature contract", "result feature", "payout feature", "odds feature", "exhibition feature")),
    ("SKIPPED_PROGRAM_UNAVAILABLE", ("program unavailable", "program not found", "archive unavailable", "source unavailable", "download failed", "filenotfounderror")),
    ("SKIPPED_OUTPUT_INTEGRITY_ERROR", ("output integrity", "output_integrity", "write integrity", "manifest integrity")),
    ("SKIPPED_METADATA_INVALID", ("metadata invalid", "invalid metadata", "timezone", "naive datetime", "race date mismatch", "source type mismatch")),
)
# End of the fixed values.


def classify(message: Column, rules: tuple[tuple[str, str], ...], rest: str) -> Column:
    """The name of the first rule (pattern, name) that the lower-case text meets, else rest."""
    text, out = F.lower(message), None
    for pattern, status in rules:
        out = F.when(text.rlike(pattern), status) if out is None else out.when(text.rlike(pattern), status)
    return out.otherwise(rest)


def failure_status(kind: Column, message: Column, explicit: Column | None = None) -> Column:
    """The skipped status of an error by its kind (class name) and text; one that the error names itself wins, unless it is ELIGIBLE or unknown; what no rule knows is an integrity error."""
    known = [status for status, _ in TAXONOMY]
    text = F.lower(F.concat_ws(": ", F.coalesce(kind, F.lit("")), F.coalesce(message, F.lit(""))))
    out = F.when(F.lower(kind).rlike(r"(^|\.)filenotfounderror$"), UNAVAILABLE)
    if explicit is not None:
        out = F.when(explicit.isin(*known), explicit).when(F.lower(kind).rlike(r"(^|\.)filenotfounderror$"), UNAVAILABLE)
    for status, words in TAXONOMY:
        met = F.lit(False)
        for w in words:
            met = met | text.contains(w)
        out = out.when(met, status)
    return out.otherwise(INTEGRITY)


def decision_rules() -> dict[str, Column]:
    """What a decision row must meet: status, eligible, reason, race_date, as_of_time, and the record (a struct of the same five) that it must equal."""
    c, status = F.col, F.col("status")
    text = lambda x: F.coalesce(F.trim(c(x).cast("string")), F.lit("")) != ""
    return {
        "status_known": status.isin(ELIGIBLE, *[s for s, _ in TAXONOMY]), "eligible_exactly_if_status": c("eligible") == (status == ELIGIBLE), "reason_given": text("reason"), "race_date_given": text("race_date"), "as_of_time_given": text("as_of_time"),
        **{f"record_{x}": c(f"record.{x}").eqNullSafe(c(x)) for x in ("status", "eligible", "reason", "as_of_time")},
    }


def research_only(archives: DataFrame, exceptions: DataFrame) -> DataFrame:
    """archives (path, length, sha256) with `use`: RESEARCH_ONLY if one is on the exception list (path, length, sha256; small) as it stands there, EXCEPTION_DIFFERS if only its path is (neither is fit for production), else PRODUCTION."""
    e = exceptions.select(F.col("path").alias("_path"), F.col("length").alias("_length"), F.lower("sha256").alias("_sha")).dropDuplicates()
    e = e.groupBy("_path").agg(F.collect_set(F.struct("_length", "_sha")).alias("_known"))
    j = archives.join(e, archives["path"] == e["_path"], "left")
    same = F.array_contains("_known", F.struct(F.col("length").alias("_length"), F.lower("sha256").alias("_sha")))
    return j.withColumn("use", F.when(F.col("_path").isNull(), "PRODUCTION").when(F.coalesce(same, F.lit(False)), "RESEARCH_ONLY").otherwise("EXCEPTION_DIFFERS")).drop("_path", "_known")
