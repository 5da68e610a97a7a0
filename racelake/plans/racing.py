"""Race jobs over all files and days at once: fixed-layout text to tables, reconciliation, quality, roll-ups, features, scores.

Parsers work on lines. What a line means depends on the lines before it (venue, race, current bet), which is carried forward over a
file's lines. Files are whole texts (a task holds one file's lines at a time) or, however long, the line frames of read_lines(), whose chunks
go to different tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import checks, dealing, ordered, pit, reconcile, scoring
from ..sources.text_files import date_from_name, lines_of

# The layouts of the source files and the codes of their tables.
PROGRAM = r"^([1-6])\s(\d{4})(.{4})(\d{2})(.{2})(\d{2})([AB][12])\s*(\d\.\d{2})\s*(\d{1,3}\.\d{2})\s*(\d{1,2}\.\d{2})\s*(\d{1,3}\.\d{2})\s*(\d{1,2})\s*(\d{1,3}\.\d{2})\s*((?:\d{1,2}(?=100\.00)|1\d{2}|\d{1,2}))\s*((?:100\.00|\d{1,2}\.\d{2}))(.*)$"
PROGRAM_ROW = r"^[1-6]\s\d{4}"
RESULT = r"^\s*(\S+)\s+([1-6])\s+(\d{4})\s+(.+?)\s+(\d{1,2})\s+(\d{1,3})\s+(\d\.\d{2})\s+([1-6])\s+(\S+)\s+(.+?)\s*$"
SPECIAL_RESULT = r"(?i)^\s*(F|[KLS]\d?)\s+([1-6])\s+(\d{4})\s+(.+?)\s+(\d{1,2})\s+(\d{1,3})\s+(\S+)\s+(\S+)\s+(\S+)\s+(.+?)\s*$"
RESULT_ROW = r"(?i)^\s*(?:00|0[1-6]|[1-6]|F|L\d?|K\d?|S\d?)\s+[1-6]\s+\d{4}\s+"
PROGRAM_VENUE, RESULT_VENUE = r"(?i)^\s*(\d{2})BBGN\s*$", r"(?i)^\s*(\d{2})KBGN\s*$"
PROGRAM_RACE, RESULT_RACE = r"(?i)^\s*(\d{1,2})R\s+", r"(?i)^\s*(\d{1,2})R\s+.*H\d{4}m"
CANCELLED_LINE, UNAVAILABLE, SUMMARY, RACE_OFF = r"^\s*(\d{1,2})R\s+中\s*止\s*$", "データは、この場の全レース終了後に登録されます。", "[払戻金]", "レース不成立"
BET = r"^\s*(単勝|複勝|2連単|2連複|拡連複|3連単|3連複)\s+(.+?)\s*$"
COMBINATION, SIMPLE = r"([1-6](?:-[1-6]){1,2})\s+(\d+)\s+人気\s+(\d+)", r"([1-6])\s+(\d+)"
BET_TYPES = {"単勝": "WIN", "複勝": "PLACE", "2連単": "EXACTA", "2連複": "QUINELLA", "拡連複": "QUINELLA_PLACE", "3連単": "TRIFECTA", "3連複": "TRIO"}
PARTS = {"WIN": 1, "PLACE": 1, "EXACTA": 2, "QUINELLA": 2, "QUINELLA_PLACE": 2, "TRIFECTA": 3, "TRIO": 3}
RACE = ["race_date", "venue_code", "race_no"]
ENTRY = [*RACE, "boat_no", "racer_id"]
PAYOUT_GROUP, PAYOUT_KEY = [*RACE, "bet_type"], [*RACE, "bet_type", "selection_no", "payout_status"]
PROGRAM_COLUMNS = [*ENTRY, "racer_name", "age", "branch", "weight_kg", "class", "national_win_rate", "national_place2_rate_pct", "local_win_rate", "local_place2_rate_pct", "motor_no", "motor_place2_rate_pct", "boat_no_equipment", "boat_place2_rate_pct", "series_results_raw", "source_file"]
RESULT_COLUMNS = [*RACE, "finish_raw", "boat_no", "racer_id", "racer_name_result", "motor_no_result", "boat_no_equipment_result", "exhibition_time", "course", "start_timing_raw", "race_time_raw", "finish_position", "source_file_result"]
PAYOUT_COLUMNS = [*RACE, "bet_type", "bet_type_raw", "selection_no", "combination", "combination_raw", "payout_yen", "popularity", "payout_status", "is_ordered", "source_kind", "source_line_no", "source_file"]
ZERO = ["duplicate_keys", "program_duplicate_keys", "result_duplicate_keys", "right_only", "partial_result_missing", "invalid_race_size", "invalid_boat_sets", "name_unexplained_mismatch", "motor_mismatch", "boat_equipment_mismatch", "payout_missing_group_count", "payout_unexpected_group_count", "payout_duplicate_keys", "payout_invalid_combinations", "payout_invalid_amounts", "payout_invalid_popularity", "payout_summary_mismatch"]
PROVENANCE = ["as_of_time", "snapshot_at", "feature_version", "feature_contract_version", "feature_source_type", "feature_source_url", "feature_source_sha256", "feature_source_fetched_at", "feature_source_max_time", "source_max_time", "feature_collector_version", "provenance_status", "deadline_evidence_sha256"]
FEATURE_VERSION, FEATURE_CONTRACT, SOURCE_TYPE = "pre_night_program_snapshot_v1", "pre_night_program_parquet_v1", "program"
# End of the fixed values.


def _taken(line: Column, pattern: str, groups: int) -> Column:
    """All groups by one evaluation of the pattern: an array, null if the line doesn't match."""
    return F.when(line.rlike(pattern), F.split(F.regexp_replace(line, pattern, "\x01".join(f"${i + 1}" for i in range(groups))), "\x01", -1))


def _number(line: Column, pattern: str, low: int, high: int) -> Column:
    """The header's number if the line is one and the number is in range."""
    n = F.regexp_extract(line, pattern, 1).try_cast("int")
    return F.when(n.between(low, high), n)


def _lines(files: DataFrame, prefix: str) -> DataFrame:
    """race_date, file, line_no and raw (and the chunk, if the lines have one) of whole files (file, text) or of lines as read_lines() gives them; a race_date of their own wins."""
    date = date_from_name(F.col("file"), prefix, F.col("race_date") if "race_date" in files.columns else None).alias("race_date")
    if "raw" in files.columns:
        return ordered.numbered(files.select("file", "chunk", "place", "raw", date), ["file"], "place", "chunk")
    return lines_of(files.select("file", "text", date))


def _carried(lines: DataFrame, values: dict[str, Column]) -> DataFrame:
    return ordered.carried(lines, ["file"], "line_no", values, "chunk" if "chunk" in lines.columns else None)


def with_context(lines: DataFrame, venue: str, race: str) -> DataFrame:
    """lines with venue_code and race_no of the last valid headers; a venue header clears the race."""
    d = lines.withColumn("_v", _number(F.col("line"), venue, 1, 24)).withColumn("_r", _number(F.col("line"), race, 1, 12))
    header = F.when(F.col("_v").isNotNull() | F.col("_r").isNotNull(), F.struct(F.when(F.col("_v").isNull(), F.col("_r")).alias("race")))
    d = _carried(d, {"_venue": F.col("_v"), "_header": header})
    return d.withColumns({"venue_code": F.lpad(F.col("_venue").cast("string"), 2, "0"), "race_no": F.col("_header.race").cast("long")}).drop("_v", "_r", "_venue", "_header")


def _split_rows(files: DataFrame, prefix: str, venue: str, race: str, candidate: str, fields: Column) -> tuple[DataFrame, DataFrame]:
    lines = _lines(files, prefix).withColumn("line", X.narrow(F.col("raw")))
    d = with_context(lines, venue, race).filter(F.col("line").rlike(candidate)).withColumn("_f", fields)
    good = F.col("_f").isNotNull() & F.col("venue_code").isNotNull() & F.col("race_no").isNotNull()
    return d.filter(good), d.filter(~good).select("race_date", "file", "line_no", "raw")


def assert_all_matched(unmatched: DataFrame, limit: int = 10) -> None:
    """Strict mode: raise with the number of lines that look like rows but are none, and the first ones by file and line."""
    n = unmatched.count()
    if n:
        first = unmatched.orderBy("file", "line_no").limit(limit).collect()
        raise ValueError(f"{n} unmatched lines: {[(r['file'], r['line_no'], r['raw']) for r in first]}")


def files_without_rows(files: DataFrame, rows: DataFrame, source: str = "source_file") -> DataFrame:
    """(file) of the files that gave no row."""
    return files.select("file").join(rows.select(F.col(source).alias("file")).distinct(), "file", "left_anti")


def parse_program(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, unmatched lines) from files (file, text and, if it is to win, race_date)."""
    d, bad = _split_rows(files, "B", PROGRAM_VENUE, PROGRAM_RACE, PROGRAM_ROW, _taken(F.col("line"), PROGRAM, 16))
    f = lambda i: F.get("_f", F.lit(i))
    whole = {"boat_no": 0, "age": 3, "weight_kg": 5, "motor_no": 11, "boat_no_equipment": 13}
    rates = {"national_win_rate": 7, "national_place2_rate_pct": 8, "local_win_rate": 9, "local_place2_rate_pct": 10, "motor_place2_rate_pct": 12, "boat_place2_rate_pct": 14}
    d = d.withColumns({c: f(i).cast("long") for c, i in whole.items()} | {c: f(i).cast("double") for c, i in rates.items()})
    d = d.withColumns({"racer_id": X.pad_id(F.trim(f(1)), 4), "racer_name": X.squeeze_out(f(2)), "branch": X.squeeze_out(f(4)), "class": F.trim(f(6)), "series_results_raw": X.strip_all(f(15)), "source_file": F.col("file")})
    return d.select(PROGRAM_COLUMNS), bad


def parse_results(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, unmatched lines); special finishes have looser fields, so numbers that are none become null."""
    line = F.col("line")
    d, bad = _split_rows(files, "K", RESULT_VENUE, RESULT_RACE, RESULT_ROW, F.coalesce(_taken(line, RESULT, 10), _taken(line, SPECIAL_RESULT, 10)))
    f = lambda i: F.get("_f", F.lit(i))
    finish = F.upper(X.strip_all(f(0)))
    return d.withColumns({
        "finish_raw": finish, "boat_no": f(1).cast("long"), "racer_id": X.pad_id(F.trim(f(2)), 4), "racer_name_result": X.squeeze_out(f(3)), "motor_no_result": f(4).cast("long"), "boat_no_equipment_result": f(5).cast("long"),
        "exhibition_time": f(6).try_cast("double"), "course": f(7).try_cast("long"), "start_timing_raw": f(8), "race_time_raw": f(9), "finish_position": F.when(finish.rlike("^0?[1-6]$"), finish.cast("long")), "source_file_result": F.col("file"),
    }).select(RESULT_COLUMNS), bad


def _each_type(d: DataFrame) -> DataFrame:
    types = F.array(*[F.struct(F.lit(t).alias("bet_type"), F.lit(raw).alias("bet_type_raw"), F.lit(i).alias("_order")) for i, (raw, t) in enumerate(BET_TYPES.items())])
    return d.withColumn("_t", F.explode(types)).select("*", "_t.*").drop("_t")


def parse_payouts(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(payouts, unmatched lines). A line's kind follows a fixed precedence; the race, whether the summary has begun, and the current bet are the last events before it."""
    line = F.col("line")
    d = _lines(files, "K").withColumn("line", X.nfkc(F.col("raw")))
    d = d.withColumn("_v", _number(line, RESULT_VENUE, 1, 24))
    d = _carried(d, {"_venue": F.col("_v")}).withColumn("venue_code", F.lpad(F.col("_venue").cast("string"), 2, "0"))
    kind = F.when(line.rlike(RESULT_VENUE), F.when(F.col("_v").isNotNull(), "venue").otherwise("skip")).when(line.contains(UNAVAILABLE) & F.col("venue_code").isNotNull(), "unavailable").when(line.contains(SUMMARY), "summary")
    kind = kind.when(line.rlike(RESULT_RACE), F.when(_number(line, RESULT_RACE, 1, 12).isNotNull(), "race").otherwise("skip"))
    d = d.withColumn("_k", kind)
    event = F.col("_k").isin("venue", "unavailable", "summary", "race")
    state = F.struct(F.when(F.col("_k") == "race", _number(line, RESULT_RACE, 1, 12)).alias("race"), (F.col("_k") == "summary").alias("summary"))
    d = _carried(d, {"_s": F.when(event, state)}).withColumn("race_no", F.col("_s.race").cast("long"))
    inside = F.col("_k").isNull() & ~F.coalesce(F.col("_s.summary"), F.lit(False)) & F.col("venue_code").isNotNull() & F.col("race_no").isNotNull()
    rest = F.when(F.col("_k").isNull() & F.col("_s.summary") & F.col("venue_code").isNotNull() & _number(line, CANCELLED_LINE, 1, 12).isNotNull(), "cancelled")
    rest = rest.when(inside & line.contains(RACE_OFF), "race_off").when(inside & line.rlike(BET), "bet").when(inside & line.rlike(f"^\\s*{COMBINATION}\\s*$"), "more").when(inside & line.rlike(r"^\s*$"), "blank")
    d = d.withColumn("_k", F.coalesce("_k", rest))
    named = X.code_of(F.regexp_extract(line, BET, 1), BET_TYPES)
    bet = F.when(F.col("_k") == "bet", named).when(F.col("_k").isin("venue", "unavailable", "summary", "race", "race_off", "blank"), F.lit(""))
    d = _carried(d, {"bet_type": bet}).withColumn("_payload", F.when(F.col("_k") == "bet", F.regexp_extract(line, BET, 2)).otherwise(line))
    base = ["race_date", "file", "venue_code", "race_no", "line_no", "raw"]

    simple, pay = F.col("bet_type").isin("WIN", "PLACE"), F.col("_payload")
    row = lambda status, combo=None, yen=None, pop=None: F.struct(F.lit(status).alias("status"), (combo if combo is not None else F.lit(None)).cast("string").alias("combo"), (yen if yen is not None else F.lit(None)).try_cast("long").alias("yen"), (pop if pop is not None else F.lit(None)).try_cast("long").alias("pop"))
    all_of = lambda pattern, i: F.regexp_extract_all(pay, F.lit(pattern), F.lit(i))
    win = F.transform(F.arrays_zip(all_of(SIMPLE, 1).alias("c"), all_of(SIMPLE, 2).alias("y")), lambda x: row("NORMAL", x["c"], x["y"]))
    combo = F.transform(F.arrays_zip(all_of(COMBINATION, 1).alias("c"), all_of(COMBINATION, 2).alias("y"), all_of(COMBINATION, 3).alias("p")), lambda x: row("NORMAL", x["c"], x["y"], x["p"]))
    special = F.regexp_extract(pay, r"特払い\s+(\d+)", 1)
    found = F.when(F.col("_k") == "more", combo).when(pay == "不成立", F.array(row("NOT_ESTABLISHED"))).when(pay.startswith("特払い"), F.when(special != "", F.array(row("SPECIAL_PAYOUT", None, special))))
    found = found.when(pay.contains("返還"), F.array(row("REFUND"))).when(simple, win).otherwise(combo)
    bets = d.filter((F.col("_k") == "bet") | ((F.col("_k") == "more") & ~F.col("bet_type").isin("", "WIN", "PLACE"))).withColumn("_rows", found)
    unmatched = bets.filter(F.col("_rows").isNull() | (F.size("_rows") == 0)).select("race_date", "file", "line_no", "raw")
    raw_of = X.code_of(F.col("bet_type"), {v: k for k, v in BET_TYPES.items()})
    detail = bets.select(*base, "bet_type", raw_of.alias("bet_type_raw"), F.lit(0).alias("_order"), F.posexplode("_rows").alias("_pos", "_x"))
    detail = detail.select(*base, "bet_type", "bet_type_raw", "_order", "_pos", F.col("_x.combo").alias("combination"), F.col("_x.yen").alias("payout_yen"), F.col("_x.pop").alias("popularity"), F.col("_x.status").alias("payout_status"), F.lit("DETAIL").alias("source_kind"))

    empty = lambda x, status, source: _each_type(x).withColumns({"_pos": F.lit(0), "combination": F.lit(None).cast("string"), "payout_yen": F.lit(None).cast("long"), "popularity": F.lit(None).cast("long"), "payout_status": F.lit(status), "source_kind": F.lit(source)}).select(detail.columns)
    first = Window.partitionBy("file", "venue_code", "race_no").orderBy("line_no")
    off = d.filter("_k = 'race_off'").withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(base)
    one = d.filter("_k = 'cancelled'").withColumn("race_no", _number(line, CANCELLED_LINE, 1, 12).cast("long")).select(base)
    every = d.filter("_k = 'unavailable'").withColumn("race_no", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(12).cast("long")))).select(base)
    gone = one.unionByName(every).groupBy("race_date", "file", "venue_code", "race_no").agg(F.max("line_no").alias("line_no")).withColumn("raw", F.lit(None).cast("string")).select(base)
    rows = detail.unionByName(empty(off, "NOT_ESTABLISHED", "DETAIL")).unionByName(empty(gone, "CANCELLED", "SUMMARY"))
    number = Window.partitionBy("file", *PAYOUT_GROUP, "payout_status").orderBy("source_kind", "line_no", "_order", "_pos")
    rows = rows.withColumns({"selection_no": F.row_number().over(number).cast("long"), "combination_raw": F.col("combination"), "is_ordered": F.col("bet_type").isin("EXACTA", "TRIFECTA"), "source_line_no": F.col("line_no").cast("long"), "source_file": F.col("file")})
    return rows.select(PAYOUT_COLUMNS), unmatched


# --- days


def merge_days(program: DataFrame, results: DataFrame) -> DataFrame:
    """Entries with their results: 34 columns and `side`. A race without any result is cancelled; a race that lacks some is a partial error, told by absence, never by a null finish."""
    m = reconcile.full_outer(program, results, ENTRY)
    w = Window.partitionBy(*RACE)
    left = F.sum(F.when(F.col("side") == "left_only", 1).otherwise(0)).over(w)
    m = m.withColumns({"result_available": F.col("side") == "both", "race_cancelled": left == 6, "_left": left, "racer_name_program": F.col("racer_name")})
    return m.withColumn("racer_name_canonical", F.when(F.col("result_available"), F.col("racer_name_result")).otherwise(F.col("racer_name")))


MERGED_COLUMNS = [*PROGRAM_COLUMNS, *[c for c in RESULT_COLUMNS if c not in ENTRY], "result_available", "race_cancelled", "racer_name_program", "racer_name_canonical"]


def scheduled_only(payouts: DataFrame, program: DataFrame) -> DataFrame:
    """Without the cancelled groups of races that the program doesn't have."""
    return reconcile.conditional_anti(payouts, F.col("payout_status") == "CANCELLED", program.select(RACE), RACE)


def valid_combination() -> Column:
    """Normal rows: as many parts as the bet type asks for, all different, each 1 to 6."""
    parts = F.split("combination", "-")
    need = F.create_map(*[F.lit(x) for p in PARTS.items() for x in p])[F.col("bet_type")]
    ok = (F.size(parts) == need) & (F.size(F.array_distinct(parts)) == need) & F.forall(parts, lambda x: x.rlike("^[1-6]$"))
    return (F.col("payout_status") != "NORMAL") | F.coalesce(ok, F.lit(False))


def daily_quality(program: DataFrame, results: DataFrame, payouts: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """One row of measures for each date, with the failed ones and a status. payouts: after scheduled_only(); merged: merge_days() of the two, where it is already there. The frames are read several times, so they should be tables, not parsers' plans.

    Measures by code (side, finish, payout status, bet type) are maps; cancelled_races lists (venue_code, race_no)."""
    day, n = "race_date", checks.count_where
    m = merge_days(program, results) if merged is None else merged
    both = F.col("side") == "both"
    m = m.withColumn("_name", F.when(both, reconcile.name_match(m, "racer_name", "racer_name_result")))
    differs = lambda a, b: n(both & F.coalesce(F.col(a) != F.col(b), F.lit(True)))
    entries = m.groupBy(day).agg(
        F.count("*").alias("record_count"), F.count_distinct("venue_code").alias("venue_count"), n(F.col("side") == "left_only").alias("left_only"), n(F.col("side") == "right_only").alias("right_only"), n(F.col("side") == "left_only").alias("cancelled_entry_count"),
        n(both & (F.col("_name") != "exact")).alias("name_exact_mismatch"), n(both & F.col("_name").isin("prefix", "subsequence")).alias("name_expected_abbreviation"), n(both & (F.col("_name") == "unexplained")).alias("name_unexplained_mismatch"),
        differs("motor_no", "motor_no_result").alias("motor_mismatch"), differs("boat_no_equipment", "boat_no_equipment_result").alias("boat_equipment_mismatch"), n(both & F.col("finish_position").isNull()).alias("special_finish_count"),
    )
    sizes = [df.groupBy(day).agg(F.count("*").alias(name)) for df, name in ((program, "program_record_count"), (results, "result_record_count"))]
    races = m.dropna(subset=RACE).groupBy(*RACE).agg(F.count("*").alias("k"), F.max("_left").alias("gone"), (F.array_sort(F.collect_set("boat_no")) == F.array(*[F.lit(i).cast("long") for i in range(1, 7)])).alias("boats"))
    gone = F.array_sort(F.collect_list(F.when(F.col("gone") == 6, F.struct("venue_code", "race_no"))))
    per_race = races.groupBy(day).agg(F.count("*").alias("race_count"), n(F.col("gone").between(1, 5)).alias("partial_result_missing"), n(F.col("gone") == 6).alias("cancelled_race_count"), gone.alias("cancelled_races"), n(F.col("k") != 6).alias("invalid_race_size"), n(~F.col("boats")).alias("invalid_boat_sets"))
    surplus = lambda df, keys, name: checks.dup_surplus(df, keys, [day]).withColumnRenamed("surplus", name)
    status = F.col("payout_status")
    pays = payouts.groupBy(day).agg(
        F.count("*").alias("payout_record_count"), n(~valid_combination()).alias("payout_invalid_combinations"), n(status.isin("NORMAL", "SPECIAL_PAYOUT") & ~F.coalesce(F.col("payout_yen") > 0, F.lit(False))).alias("payout_invalid_amounts"),
        n((status == "NORMAL") & ~F.col("bet_type").isin("WIN", "PLACE") & ~F.coalesce(F.col("popularity") > 0, F.lit(False))).alias("payout_invalid_popularity"), n(status == "NOT_ESTABLISHED").alias("payout_not_established_count"), n(status == "SPECIAL_PAYOUT").alias("payout_special_count"),
    )
    groups = payouts.groupBy(*PAYOUT_GROUP).agg(F.max(F.coalesce(status == "CANCELLED", F.lit(False))).alias("c")).groupBy(day).agg(n(F.col("c")).alias("payout_cancelled_group_count"))
    expected = _each_type(races.select(RACE)).select(PAYOUT_GROUP)
    grid = reconcile.coverage(expected, payouts, PAYOUT_GROUP, [day]).select(day, F.col("expected").alias("payout_expected_group_count"), (F.col("present") + F.col("unexpected")).alias("payout_group_count"), F.col("missing").alias("payout_missing_group_count"), F.col("unexpected").alias("payout_unexpected_group_count"))
    cancelled = reconcile.full_outer(races.filter("gone = 6").select(RACE), payouts.filter("payout_status = 'CANCELLED'").select(RACE).distinct(), RACE).groupBy(day).agg(n(F.col("side") != "both").alias("payout_summary_mismatch"))
    counts = lambda df, column, null, name: checks.code_counts(df, [day], column, null, name)
    maps = [counts(m, "side", "-", "merge_counts"), counts(m, "finish_raw", "CANCELLED", "finish_status_counts"), counts(payouts, "payout_status", "<NULL>", "payout_status_counts"), counts(payouts, "bet_type", "<NULL>", "payout_bet_type_counts")]
    repeats = [surplus(m, ENTRY, "duplicate_keys"), surplus(program, ENTRY, "program_duplicate_keys"), surplus(results, ENTRY, "result_duplicate_keys"), surplus(payouts, PAYOUT_KEY, "payout_duplicate_keys")]
    out = entries
    for part in (*sizes, per_race, pays, groups, grid, cancelled, *repeats, *maps):
        out = out.join(part, day, "full")
    return checks.gate(out.fillna(0), ZERO)


def day_log(requested: DataFrame, quality: DataFrame) -> DataFrame:
    """Each requested day (race_date): SUCCESS, FAILED, or MISSING."""
    return requested.join(quality.select("race_date", "status", "failures", "record_count", "race_count", "venue_count"), "race_date", "left").withColumn("status", F.coalesce("status", F.lit("MISSING")))


def monthly_summary(log: DataFrame) -> DataFrame:
    """Per month: days by outcome and a status; SUCCESS needs every day, PARTIAL some."""
    n = checks.count_where
    g = log.groupBy(F.substring("race_date", 1, 7).alias("month")).agg(F.count("*").alias("days"), n(F.col("status") == "SUCCESS").alias("succeeded"), n(F.col("status") == "FAILED").alias("failed"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("record_count", "race_count", "venue_count")])
    return g.withColumn("status", F.when(F.col("succeeded") == F.col("days"), "SUCCESS").when(F.col("succeeded") > 0, "PARTIAL").otherwise("FAILED"))


def until_first_failure(log: DataFrame) -> DataFrame:
    """The days of each month up to its first failed one."""
    w = Window.partitionBy(F.substring("race_date", 1, 7))
    return log.withColumn("_stop", F.min(F.when(F.col("status") != "SUCCESS", F.col("race_date"))).over(w)).filter("_stop is null or race_date <= _stop").drop("_stop")


# --- audits

PLACEHOLDERS = ("CANCELLED", "NOT_ESTABLISHED", "SPECIAL_PAYOUT")
NORMAL_KEY = [*PAYOUT_GROUP, "combination"]
PAYOUT_NEEDS, PROGRAM_NEEDS = [*NORMAL_KEY, "payout_yen", "payout_status"], RACE


def _kinds(payouts: DataFrame) -> tuple[Column, Column, Column]:
    """Rows with a blank combination (an error), with one (normal), and without (placeholders)."""
    blank = F.coalesce(X.strip_all(F.col("combination")) == "", F.lit(False))
    return blank, F.col("combination").isNotNull() & ~blank, F.col("combination").isNull()


def _nulls(keys: Sequence[str], where: Column | None = None) -> Column:
    return sum((checks.count_where(F.col(c).isNull() if where is None else where & F.col(c).isNull()) for c in keys), F.lit(0))


def _blanks(keys: Sequence[str], where: Column) -> Column:
    return sum((checks.count_where(where & F.coalesce(X.strip_all(F.col(c).cast("string")) == "", F.lit(False))) for c in keys), F.lit(0))


def _missing_columns(frames: dict[str, tuple[DataFrame, Sequence[str]]]) -> dict[str, list[str]]:
    return {name: [c for c in needed if c not in df.columns] for name, (df, needed) in frames.items()}


def payout_audit(payouts: DataFrame, program: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """(check_name, actual, passed) of the payout table's meaning; all checks are made, none stops the rest. Without the columns it needs, only the checks of columns are made; without a program those of its races pass. rows: those of the payouts, where they are known."""
    lacks = _missing_columns({"payout_columns": (payouts, PAYOUT_NEEDS)} | ({"program_columns": (program, PROGRAM_NEEDS)} if program is not None else {}))
    found = payouts.sparkSession.createDataFrame([(name, len(columns)) for name, columns in ({"program_columns": []} | lacks).items()], "check_name string, actual long")
    if not any(lacks.values()):
        found = found.unionByName(_payout_checks(payouts, program, [], rows))
    return found.withColumn("passed", F.col("actual") == 0)


def _payout_checks(payouts: DataFrame, program: DataFrame | None, scope: Sequence[str], rows: int | None = None) -> DataFrame:
    """(*scope, check_name, actual) for each value of the scope columns."""
    n, scope = checks.count_where, list(scope)
    blank, normal, holder = _kinds(payouts)
    status, yen = F.upper(X.strip_all(F.col("payout_status"))), F.col("payout_yen")
    row = payouts.groupBy(*scope).agg(
        n(blank).alias("blank_combination"), _nulls(RACE).alias("null_race_keys"), _nulls(["bet_type"]).alias("null_bet_type"), _nulls(NORMAL_KEY, normal).alias("null_normal_keys"), _blanks(PAYOUT_GROUP, F.lit(True)).alias("blank_keys"),
        n(holder & ~F.coalesce(status.isin(*PLACEHOLDERS), F.lit(False))).alias("placeholder_status"), n(normal & ~F.coalesce(status == "NORMAL", F.lit(False))).alias("normal_status"),
        n(holder & status.isin("CANCELLED", "NOT_ESTABLISHED") & yen.isNotNull()).alias("placeholder_amount"), n(holder & (status == "SPECIAL_PAYOUT") & ~F.coalesce(yen == 70, F.lit(False))).alias("special_amount"),
    )
    long = checks.unpivot(row, scope, [c for c in row.columns if c not in scope], "check_name", "actual")
    for some, keys, name in ((payouts.filter(normal), NORMAL_KEY, "duplicate_normal"), (payouts.filter(holder), PAYOUT_GROUP, "duplicate_placeholder")):
        long = long.unionByName(checks.dup_groups(some, keys, scope).select(*scope, F.lit(name).alias("check_name"), F.col("dup_rows").alias("actual")))
    keys = [*scope, *RACE]
    sides = None
    if program is not None:
        # the races of both sides are one table, grouped where they are dealt out to, so no join sorts either
        left, right = (df.select(keys).distinct().select(*keys, F.lit(a).alias("_left"), F.lit(not a).alias("_right")) for df, a in ((program, True), (payouts, False)))
        sides = dealing.dealt(left.unionByName(right), keys, rows).groupBy(*keys).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right")).groupBy(*scope)
    for name, alone in (("program_only_races", ~F.col("_right")), ("payout_only_races", ~F.col("_left"))):
        one = row.select(*scope, F.lit(0).cast("long").alias("actual")) if sides is None else sides.agg(n(alone).alias("actual"))
        long = long.unionByName(one.withColumn("check_name", F.lit(name)))
    return long


FRAMES = ("program", "result", "merged", "payout")
_MONTH = r"^[0-9]{4}-(0[1-9]|1[0-2])$"


def _keyed(frames: Sequence[DataFrame]) -> dict[str, tuple[DataFrame, list[str]]]:
    """The frames whose keys must not repeat, with these keys."""
    program, result, merged, payout = frames
    _, normal, holder = _kinds(payout)
    return {"program": (program, ENTRY), "result": (result, ENTRY), "merged": (merged, ENTRY), "normal_payout": (payout.filter(normal), NORMAL_KEY), "placeholder": (payout.filter(holder), PAYOUT_GROUP)}


def repeated_keys(frames: dict[str, tuple[DataFrame, Sequence[str]]], limit: int = 10) -> DataFrame:
    """(scope, check_name, actual, details) of the keys that repeat within a month of a frame, or, in the scope PERIOD, in the frame: their rows, and up to `limit` of them.

    The keys of all frames are one table, dealt out once by frame and key to more tasks the more rows there are; a key's rows are counted by month there, and the sum over its months is the
    period's. The first keys in order are taken from the first ones of many parts of each scope, so no task sees all keys of one."""
    rows, known = None, 0
    for name, (df, keys) in frames.items():
        known += df.count()
        text = F.array(*[F.col(k).cast("string") for k in keys])
        part = df.select(F.lit(f"{name}_duplicate_rows").alias("check_name"), F.col("month").cast("string").alias("month"), text.alias("_key"))
        rows = part if rows is None else rows.unionByName(part)
    by_month = dealing.dealt(rows, ["check_name", "_key"], known).groupBy("check_name", "_key", "month").agg(F.count("*").alias("n"))
    whole = by_month.groupBy("check_name", "_key").agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") > 1, F.struct(F.col("month").alias("scope"), "n"))).alias("_months")).filter("n > 1")
    every = whole.select("check_name", "_key", F.inline(F.array_append("_months", F.struct(F.lit("PERIOD").alias("scope"), F.col("n").alias("n")))))
    text = F.array_join(F.transform("_key", lambda x: F.coalesce(x, F.lit("<NULL>"))), "/")
    every = every.select("scope", "check_name", "n", text.alias("_text"), F.pmod(F.xxhash64("_key"), F.lit(64)).alias("_part"))
    some = ["scope", "check_name", "_part"]
    # a part's rows are summed beside its first keys
    sums = every.groupBy(*some).agg(F.sum("n").alias("_rows"), F.min("_text").alias("_first"))
    first = checks.top_examples(every.select(*some, "_text"), some, [F.col("_text")], limit)
    parts = first.groupBy(*some).agg(F.collect_list("_text").alias("_texts")).join(sums, some)
    return parts.groupBy("scope", "check_name").agg(F.sum("_rows").alias("actual"), F.slice(F.array_sort(F.flatten(F.collect_list("_texts"))), 1, limit).alias("details"))


def period_metrics(program: DataFrame, result: DataFrame, merged: DataFrame, payout: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """(scope, check_name, actual) of every month (the frames' own label) and of the scope PERIOD: null, blank and repeated keys of each table, blank combinations; per month too races of one table only, months whose bet types are not the seven, races without just seven, and failed checks of payout_audit(). Keys repeated in two months show in PERIOD alone. repeated: repeated_keys() of the frames, where it is there."""
    n = checks.count_where
    blank, _, _ = _kinds(payout)
    tables = _keyed((program, result, merged, payout))
    parts = []
    counted = (repeated_keys(tables) if repeated is None else repeated).select(F.col("scope").alias("_scope"), F.col("check_name").alias("_check"), "actual")
    every = None
    for name, (df, keys) in tables.items():
        cells = df.groupBy("month").agg(_nulls(keys).alias(f"{name}_null_key_cells"), _blanks(keys, F.lit(True)).alias(f"{name}_blank_key_cells"))
        parts.append(checks.unpivot(cells, ["month"], cells.columns[1:], "check_name", "actual"))
        scopes = df.groupBy("month").agg(F.lit(0)).select("month").unionByName(df.sparkSession.createDataFrame([("PERIOD",)], "month string")).withColumn("check_name", F.lit(f"{name}_duplicate_rows"))
        every = scopes if every is None else every.unionByName(scopes)
    found = every.join(counted, (every["month"].eqNullSafe(counted["_scope"])) & (every["check_name"] == counted["_check"]), "left")
    parts.append(found.select("month", "check_name", F.coalesce("actual", F.lit(0)).alias("actual")))
    blanks = payout.groupingSets([["month"], []], "month").agg(n(blank).alias("actual"), F.grouping("month").alias("_all"))
    parts.append(blanks.select(F.when(F.col("_all") == 1, "PERIOD").otherwise(F.col("month")).alias("month"), F.lit("blank_combination_rows").alias("check_name"), "actual"))
    keys = ["month", *RACE]
    races = {k: df.select(keys).distinct() for k, df in (("program", program), ("merged", merged), ("payout", payout))}
    side = reconcile.full_outer(races["program"], races["payout"], keys).groupBy("month").agg(n(F.col("side") == "left_only").alias("program_only_races"), n(F.col("side") == "right_only").alias("payout_only_races"))
    parts.append(checks.unpivot(side, ["month"], side.columns[1:], "check_name", "actual"))
    parts.append(reconcile.full_outer(races["program"], races["merged"], keys).groupBy("month").agg(n(F.col("side") != "both").alias("actual")).withColumn("check_name", F.lit("program_merged_race_set")))
    types = payout.select(*keys, F.upper(X.strip_all(F.col("bet_type"))).alias("_type")).distinct()
    # a null type is a group of its own for a race, but no member of a month's set
    parts.append(types.groupBy(*keys).agg(F.count("*").alias("k")).groupBy("month").agg(n(F.col("k") != 7).alias("actual")).withColumn("check_name", F.lit("races_without_exactly_7_bet_types")))
    wanted = F.array_sort(F.array(*[F.lit(t) for t in PARTS]))
    parts.append(types.groupBy("month").agg((F.array_sort(F.collect_set("_type")) != wanted).cast("long").alias("actual")).withColumn("check_name", F.lit("bet_type_set")))
    parts.append(_payout_checks(payout, program, ["month"]).groupBy("month").agg(n(F.col("actual") != 0).alias("actual")).withColumn("check_name", F.lit("payout_semantic_audit")))
    out = None
    for part in parts:
        part = part.select(F.col("month").alias("scope"), "check_name", F.col("actual").cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


def period_audit(program: DataFrame, result: DataFrame, merged: DataFrame, payout: DataFrame) -> DataFrame:
    """(scope, check_name, expected, actual, details) of the failed checks of period_metrics(), details with up to ten examples; a frame without the columns it needs, or with a month that is no YYYY-MM, fails in the scope PERIOD, and columns stop the rest."""
    frames = dict(zip(FRAMES, (program, result, merged, payout), strict=True))
    needs = {"program": ENTRY, "result": ENTRY, "merged": ENTRY, "payout": PAYOUT_NEEDS}
    lacks = _missing_columns({k: (df, ["month", *needs[k]]) for k, df in frames.items()})
    shape = "scope string, check_name string, expected long, actual long, details array<string>"
    if any(lacks.values()):
        return program.sparkSession.createDataFrame([("PERIOD", f"{k}_required_columns", 0, len(c), c[:10]) for k, c in lacks.items() if c], shape)
    repeated = repeated_keys(_keyed((program, result, merged, payout)))
    failed = period_metrics(*frames.values(), repeated).filter("actual <> 0")
    race = F.concat_ws("/", *[F.col(k).cast("string") for k in RACE])
    keys = ["month", *RACE]
    sides = reconcile.full_outer(program.select(keys).distinct(), payout.select(keys).distinct(), keys)
    shown = [checks.examples(sides.filter(F.col("side") == side), ["month"], name, race) for name, side in (("program_only_races", "left_only"), ("payout_only_races", "right_only"))]
    kinds = _payout_checks(payout, program, ["month"]).filter("actual <> 0")
    shown.append(checks.examples(kinds, ["month"], "payout_semantic_audit", F.col("check_name")))
    shown.append(repeated.select(F.col("scope").alias("month"), "details", "check_name"))
    details = shown[0]
    for x in shown[1:]:
        details = details.unionByName(x)
    details = details.withColumnRenamed("month", "_scope").withColumnRenamed("check_name", "_check")
    out = failed.join(details, failed["scope"].eqNullSafe(details["_scope"]) & (failed["check_name"] == details["_check"]), "left").select("scope", "check_name", F.lit(0).cast("long").alias("expected"), "actual", F.coalesce("details", F.array().cast("array<string>")).alias("details"))
    labels = [df.select("month").filter(~F.coalesce(F.col("month").rlike(_MONTH), F.lit(False))).withColumn("_frame", F.lit(k)) for k, df in frames.items()]
    odd = labels[0].unionByName(labels[1]).unionByName(labels[2]).unionByName(labels[3]).groupBy("_frame").agg(F.count("*").alias("actual"))
    return out.unionByName(odd.select(F.lit("PERIOD").alias("scope"), F.concat("_frame", F.lit("_month_label")).alias("check_name"), F.lit(0).cast("long").alias("expected"), "actual", F.array().cast("array<string>").alias("details")))


# --- point in time, features, scores

FEATURES = ["age", "weight_kg", "national_win_rate", "national_place2_rate_pct", "local_win_rate", "local_place2_rate_pct", "motor_place2_rate_pct", "boat_place2_rate_pct"]
FEATURE_COLUMNS = [*RACE, "boat_no", *FEATURES, "branch", "class", "racer_id", "racer_name", "motor_no", "boat_no_equipment", "source_file"]
LEAKS = frozenset((*checks.RESULT_COLUMNS, *checks.SNAPSHOT_PROHIBITED, "start_timing_raw", "exhibition_time", "course"))


def snapshot(program: DataFrame, sources: DataFrame) -> DataFrame:
    """Entries with the 13 provenance columns: 33 in all. sources has a row for each date: race_date, fetched_at and snapshot_at (instants), source_url, source_sha256, collector_version, deadline_evidence_sha256. The status tells whether the source came by the cut-off; an entry without a source has nulls, which the audit finds."""
    if leaked := [c for c in program.columns if c.strip().casefold() in LEAKS]:
        raise ValueError(f"columns known only after the race: {leaked}")
    d = program.select(PROGRAM_COLUMNS).join(sources, "race_date", "left").withColumn("as_of_time", pit.as_of_instant(F.col("race_date")))
    fetched = F.col("fetched_at")
    return d.withColumns({
        "feature_version": F.lit(FEATURE_VERSION), "feature_contract_version": F.lit(FEATURE_CONTRACT), "feature_source_type": F.lit(SOURCE_TYPE), "feature_source_url": F.col("source_url"), "feature_source_sha256": F.col("source_sha256"),
        "feature_source_fetched_at": fetched, "feature_source_max_time": fetched, "source_max_time": fetched, "feature_collector_version": F.col("collector_version"),
        "provenance_status": F.when(pit.eligibility(fetched, F.col("as_of_time")) == pit.BY_AS_OF, pit.ELIGIBLE).otherwise(pit.AFTER_AS_OF),
    }).select(*PROGRAM_COLUMNS, *PROVENANCE)


def snapshot_audit(frame: DataFrame) -> DataFrame:
    """Per date, gated: null provenance cells, times that are none (of text columns), sources from after the cut-off, the two source times apart, rows not eligible, and other than one digest of the source and one of the deadline evidence (null is one)."""
    if lacking := [c for c in PROVENANCE if c not in frame.columns]:
        raise ValueError(f"provenance columns missing: {lacking}")
    n = checks.count_where
    at = {c: F.col(c) if dict(frame.dtypes)[c].startswith("timestamp") else pit.aware(F.col(c)) for c in ("as_of_time", "feature_source_max_time", "source_max_time")}
    as_of, source, alias = at.values()
    one = lambda c: (F.count_distinct(F.struct(c)) != 1).cast("long")
    g = frame.groupBy("race_date").agg(
        F.count("*").alias("rows"), _nulls(PROVENANCE).alias("null_provenance"), sum((n(F.col(c).isNotNull() & t.isNull()) for c, t in at.items()), F.lit(0)).alias("invalid_timestamps"), n(source > as_of).alias("future_source_rows"),
        n(F.coalesce(source != alias, F.lit(False))).alias("source_alias_mismatches"), n(~F.coalesce(F.col("provenance_status") == pit.ELIGIBLE, F.lit(False))).alias("ineligible_status_rows"), one("feature_source_sha256").alias("source_digests"), one("deadline_evidence_sha256").alias("deadline_digests"),
    )
    return checks.gate(g, g.columns[2:])


def build_features(program: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features of the dates that pass every rule, in key order within files; violations by date). Columns known after the race are refused; rows without a date fail as a date of their own, null."""
    if leaked := [c for c in program.columns if c.strip().casefold() in LEAKS]:
        raise ValueError(f"columns known only after the race: {leaked}")
    n = checks.count_where
    rates = [c for c in FEATURES if c.endswith(("rate", "pct"))]
    in_range = [checks.between("age", 15, 99), checks.between("weight_kg", 30, 99), *[checks.between(c, 0, 100) for c in rates]]
    bad = ~F.coalesce(_all(in_range), F.lit(False))
    text = F.col("racer_id").rlike("^[0-9]{4}$") & F.col("venue_code").rlike("^[0-9]{2}$") & F.col("venue_code").try_cast("int").between(1, 24) & (X.strip_all(F.col("racer_name")) != "")
    rows = program.groupBy("race_date").agg(n(F.col("race_date").isNull()).alias("null_date"), n(bad).alias("out_of_range"), n(~F.coalesce(text, F.lit(False))).alias("bad_text"), scoring.blank_inputs(program, ["branch", "class"]).alias("blank_category"))
    races = program.groupBy(*RACE).agg(F.count("*").alias("k"), F.array_sort(F.collect_set("boat_no")).alias("b"), F.count_distinct(F.struct("source_file")).alias("s"))
    races = races.groupBy("race_date").agg(n(F.col("k") != 6).alias("race_size"), n(F.col("b") != F.array(*[F.lit(i).cast("long") for i in range(1, 7)])).alias("boat_sets"), n(F.col("s") != 1).alias("mixed_sources"))
    both = reconcile.full_outer(rows, races, ["race_date"]).drop("side")
    report = checks.gate(both, ["null_date", "out_of_range", "bad_text", "blank_category", "race_size", "boat_sets", "mixed_sources"])
    good = program.join(report.filter("status = 'SUCCESS'").select("race_date"), "race_date", "left_semi")
    return good.select(FEATURE_COLUMNS), report


def matrix_audit(matrix: DataFrame, position: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Per date, gated: rows that are no multiple of 6, null cells, repeated keys, numbers that are not finite, and, where `position` names columns that tell the stored order, rows not after the one above them in key order (order_falls(): no task holds a date). rows: those of the matrix, where they are known."""
    if matrix.columns[: len(FEATURE_COLUMNS)] != FEATURE_COLUMNS:
        raise ValueError(f"columns of the matrix: {matrix.columns}")
    n = checks.count_where
    key = [*RACE, "boat_no"]
    finite = _all([~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) != float("inf")) for c in FEATURES])
    g = matrix.groupBy("race_date").agg(F.count("*").alias("rows"), (F.count("*") % 6 != 0).cast("long").alias("row_count"), _nulls(FEATURE_COLUMNS).alias("nulls"), n(~F.coalesce(finite, F.lit(True))).alias("not_finite"))
    if position:
        falls = ordered.order_falls(matrix.withColumn("_venue", F.col("venue_code").cast("int")), position, ["_venue", "race_no", "boat_no"], ["race_date"], strict=True, rows=rows)
        g = g.join(falls.groupBy("race_date").agg(F.count("*").alias("order")), "race_date", "left").fillna(0, ["order"])
    else:
        g = g.withColumn("order", F.lit(0).cast("long"))
    g = g.join(checks.dup_surplus(matrix, key, ["race_date"]).withColumnRenamed("surplus", "repeated_keys"), "race_date", "left")
    return checks.gate(g, ["row_count", "nulls", "not_finite", "order", "repeated_keys"])


def build_feature_matrix(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the 19-column matrix of the dates of a snapshot that pass everything, a report by date): the snapshot's audit, the feature rules, the matrix audit, and the fingerprint of the matrix's schema."""
    features, rules = build_features(frame.select(PROGRAM_COLUMNS))
    parts = {"snapshot": snapshot_audit(frame), "features": rules, "matrix": matrix_audit(features)}
    report = None
    for name, part in parts.items():
        part = part.select("race_date", F.col("failures").alias(name))
        report = part if report is None else reconcile.full_outer(report, part, ["race_date"]).drop("side")
    failed = F.array_join(F.filter(F.array(*[F.when(F.coalesce(F.col(k), F.lit("")) != "", F.concat(F.lit(f"{k}: "), F.col(k))) for k in parts]), lambda x: x.isNotNull()), "; ")
    report = report.select("race_date", failed.alias("failures"), F.sha2(F.lit(features.schema.json()), 256).alias("schema_sha256")).withColumn("status", F.when(F.col("failures") == "", "SUCCESS").otherwise("FAILED"))
    return features.join(report.filter("status = 'SUCCESS'").select("race_date"), "race_date", "left_semi").select(FEATURE_COLUMNS), report


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _places(model: dict) -> dict[str, Column]:
    return {c: scoring.vocabulary_index(X.nfc(F.col(c)), model[f"{c}_vocabulary"]) for c in ("branch", "class")}


def score_entries(features: DataFrame, model: dict) -> DataFrame:
    """features with `probability` (decimal, 15 places) by a model of intercept, coefficients of FEATURES in order, and of branch and class vocabularies (entry 0 unknown). An entry with a blank category has none. Doubles; exact_scores() has 50 digits."""
    terms = list(zip(map(float, model["coefficients"]), [F.col(c).cast("double") for c in FEATURES], strict=True))
    score = scoring.linear(float(model["intercept"]), terms)
    for column, place in _places(model).items():
        weights = F.array(*[F.lit(float(w)) for w in model[f"{column}_coefficients"]])
        score = score + F.get(weights, place)
    blank = (F.coalesce(F.col("branch"), F.lit("")) == "") | (F.coalesce(F.col("class"), F.lit("")) == "")
    return features.withColumn("probability", F.when(~blank, F.bround(scoring.probability(score), 15).cast("decimal(16,15)")))


def score_by_registry(features: DataFrame, assigned: DataFrame, models: DataFrame) -> DataFrame:
    """features of each date under each model that is assigned to it (race_date, model_id), with probability (decimal, 15 places) and refused: records that fail a rule of scoring.model_report(), or whose features are not FEATURES in order, score nothing and are named."""
    contract = F.array(*[F.lit(c) for c in FEATURES])
    d = features.join(assigned.select("race_date", "model_id").distinct(), "race_date").withColumns({c: X.nfc(F.col(c)) for c in ("branch", "class")})
    return scoring.score_by_models(d, models.withColumn("contract_features", contract), ["branch", "class"], 15)


def exact_scores(features: DataFrame, model: dict) -> DataFrame:
    """score_entries() in decimals of 50 digits; the model's numbers are decimal texts."""
    inputs, weights = [F.col(c) for c in FEATURES], list(model["coefficients"])
    for column, place in _places(model).items():
        blank = F.coalesce(F.col(column), F.lit("")) == ""
        inputs += [F.when(~blank, x) for x in scoring.one_hot(place, len(model[f"{column}_vocabulary"]))]
        weights += model[f"{column}_coefficients"]
    return features.withColumn("probability", scoring.exact_probability(model["intercept"], weights, inputs))
