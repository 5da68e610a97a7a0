"""The daily job: files in, tables and a quality report out, all days in one run.

A day is published in steps that any of which can be the last one to happen: its name is entered as BEGUN in the commit table, its parts of the four
tables are replaced (or, if it fails, withdrawn), its quality row is stored, and it is entered as DONE.  A day whose last entry is not DONE
is not published, whatever its tables hold: published() leaves it out, and the next run does it again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks
from ..sources import text_files as S
from . import racing as R

#: What fails a day beside the zero measures of its tables.
FILE_ZERO = ["undated_file_count", "unknown_kind_file_count", "program_file_count", "result_file_count", "program_unmatched_lines", "result_unmatched_lines", "payout_unmatched_lines", "program_without_rows", "result_without_rows", "payout_without_rows"]
TABLES = ("program", "result", "payout", "merged")
BEGUN, DONE = "BEGUN", "DONE"


def with_kinds(files: DataFrame) -> DataFrame:
    """files with their kind, by the first letter of the name."""
    kind = F.when(F.upper(F.substring("file", 1, 1)) == "B", "program").when(F.upper(F.substring("file", 1, 1)) == "K", "result")
    return files.withColumn("kind", kind)


def choose(listed: DataFrame) -> DataFrame:
    """The file of each day and kind. Of a day's result files one whose name begins with a small k comes first; several equally good ones are none."""
    known = listed.filter("kind is not null and race_date is not null")
    chosen, _ = S.one_file_each(known.select("race_date", "kind", "file"), ["race_date", "kind"], F.when(F.col("file").startswith("k"), 1).otherwise(0))
    return known.join(chosen, ["race_date", "kind", "file"], "left_semi")


def misfits_of(listed: DataFrame) -> DataFrame:
    """Per day, null for files without one: the files that fit no day or no kind, and the first ten of their names."""
    undated = F.col("race_date").isNull()
    odd = listed.filter(undated | F.col("kind").isNull())
    names = checks.top_examples(odd.select("race_date", "file"), ["race_date"], [F.col("file")], 10).groupBy("race_date").agg(F.array_sort(F.collect_list("file")).alias("misfit_files")).withColumnRenamed("race_date", "_day")
    counts = odd.groupBy("race_date").agg(checks.count_where(undated).alias("undated_file_count"), checks.count_where(F.col("kind").isNull()).alias("unknown_kind_file_count"))
    return counts.join(names, counts["race_date"].eqNullSafe(names["_day"])).drop("_day")


def states(spark: SparkSession, root: str) -> DataFrame | None:
    """(race_date, run_id, state) of the last entry of each day in the commit table, or None before the first run."""
    if not S.exists(spark, f"{root}/commits"):
        return None
    log = spark.read.schema("race_date string, run_id string, state string, entered_at timestamp").parquet(f"{root}/commits")
    return log.groupBy("race_date").agg(F.max(F.struct("entered_at", F.col("state") == DONE, "run_id", "state")).alias("_last")).select("race_date", "_last.run_id", "_last.state")


def finished(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored quality rows of days whose publication is done, or None before the first run. A quality table that is there but cannot be read is an error."""
    if not S.exists(spark, f"{root}/quality"):
        return None
    rows = spark.read.parquet(f"{root}/quality").withColumn("race_date", F.col("race_date").cast("string"))
    log = states(spark, root)
    return rows if log is None else rows.join(log.filter(F.col("state") == DONE).select("race_date"), "race_date", "left_semi")


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table's rows of the days that are published: SUCCESS, and done."""
    good = finished(spark, root).filter("status = 'SUCCESS'").select("race_date").distinct()
    rows = spark.read.parquet(f"{root}/{name}").withColumn("race_date", F.col("race_date").cast("string"))
    return rows.join(F.broadcast(good), "race_date", "left_semi")  # a row for each day


def _enter(days: DataFrame, root: str, run_id: str, state: str) -> None:
    days.select("race_date", F.lit(run_id).alias("run_id"), F.lit(state).alias("state"), F.current_timestamp().alias("entered_at")).coalesce(1).write.mode("append").parquet(f"{root}/commits")


def daily_etl(spark: SparkSession, files: DataFrame, root: str, overwrite: bool = False) -> DataFrame:
    """Parse, reconcile, audit and store the days of `files` (file, text, and race_date where it is to win over the name); the quality rows of the days that were processed, and one without a day for files that have none.

    Days with a stored SUCCESS whose publication is done are skipped unless overwrite.  The parsed tables are written once, under candidate/, and every measure reads
    those.  A day that fails any measure, has not exactly one file of each kind, a file of neither kind, lines that look like rows but are none, or a file without
    rows, has its quality row alone: what an earlier run stored of it is withdrawn. The others replace their day in program, result, payout and merged.
    Quality rows go to quality/ and, as JSON, to quality_json/."""
    explicit = F.col("race_date") if "race_date" in files.columns else None
    d = files.withColumn("race_date", S.date_from_name(F.col("file"), "[BK]", explicit)).select("file", "text", "race_date")
    if not overwrite and (done := finished(spark, root)) is not None:
        d = S.unfinished(d, done.select("race_date", "status"))
    listed = with_kinds(d)
    chosen, misfits = choose(listed), misfits_of(listed)
    kinds = {"program": ("program", R.parse_program), "result": ("result", R.parse_results), "payout": ("result", R.parse_payouts)}
    source = {"program": "source_file", "result": "source_file_result", "payout": "source_file"}
    tables, counts = {}, {}
    days = d.select("race_date").distinct()
    named = days.filter("race_date is not null")
    for kind in ("program", "result"):
        mine = chosen.filter(F.col("kind") == kind)
        counts[f"{kind}_file_count"] = named.join(mine.select("race_date", F.lit(0).alias("n")), "race_date", "left").select("race_date", F.coalesce("n", F.lit(1)).alias("n"))
    for name, (kind, parse) in kinds.items():
        mine = chosen.filter(F.col("kind") == kind).drop("kind")
        rows, bad = parse(mine)
        rows.write.mode("overwrite").parquet(f"{root}/candidate/{name}")
        tables[name] = spark.read.schema(rows.schema).parquet(f"{root}/candidate/{name}")
        counts[f"{name}_unmatched_lines"] = bad.groupBy("race_date").agg(F.count("*").alias("n"))
        empty = R.files_without_rows(mine, tables[name], source[name])
        counts[f"{name}_without_rows"] = mine.select("race_date", "file").join(empty, "file", "left_semi").groupBy("race_date").agg(F.count("*").alias("n"))
    tables["payout"] = R.scheduled_only(tables["payout"], tables["program"])
    merged = R.merge_days(tables["program"], tables["result"])
    merged.write.mode("overwrite").parquet(f"{root}/candidate/merged")
    merged = spark.read.schema(merged.schema).parquet(f"{root}/candidate/merged")
    tables["merged"] = merged.select(R.MERGED_COLUMNS)
    quality = days.join(R.daily_quality(tables["program"], tables["result"], tables["payout"], merged).drop("failures", "status"), "race_date", "left")
    for name, n in counts.items():
        quality = quality.join(n.withColumnRenamed("n", name), "race_date", "left")
    quality = quality.join(misfits.withColumnRenamed("race_date", "_day"), F.col("race_date").eqNullSafe(F.col("_day")), "left").drop("_day")
    quality = checks.gate(quality.fillna(0), [*FILE_ZERO, *R.ZERO]).withColumn("created_at", F.current_timestamp())
    quality.write.mode("overwrite").parquet(f"{root}/candidate/quality")
    quality = spark.read.schema(quality.schema).parquet(f"{root}/candidate/quality")
    publish(spark, {name: tables[name] for name in TABLES}, quality, root)
    return quality


def publish(spark: SparkSession, tables: dict[str, DataFrame], quality: DataFrame, root: str) -> None:
    """Store the days of quality (race_date, status): the parts of `tables` of those that succeeded, nothing of those that failed, and the quality rows, between an entry BEGUN and an entry DONE of each day. Whatever a run leaves undone, the next one of the day does."""
    days, run_id = quality.select("race_date"), uuid.uuid4().hex
    _enter(days, root, run_id, BEGUN)
    good = F.broadcast(quality.filter("status = 'SUCCESS'").select("race_date"))  # a row for each day
    failed = [r[0] for r in quality.filter("status <> 'SUCCESS' and race_date is not null").select("race_date").collect()]  # a row for each failed day
    for name, table in tables.items():
        order = ["venue_code", "race_no"] + ([] if name == "payout" else ["boat_no"])
        S.withdraw_days(spark, f"{root}/{name}", failed)
        S.write_days(table.join(good, "race_date", "left_semi"), f"{root}/{name}", order=order)
    S.write_days(quality, f"{root}/quality")
    S.write_reports(quality, f"{root}/quality_json")
    _enter(days, root, run_id, DONE)
