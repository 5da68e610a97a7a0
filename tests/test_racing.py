"""Race jobs: layouts line by line, whole synthetic days, and one fault for each check."""

import json
import math
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from racelake.operators import scoring
from racelake.plans import daily as D
from racelake.plans import racing as R
from racelake.sources import text_files as S
from racelake.streaming.days import run_on_arrival

NAMES = ["山田太郎", "鈴木一郎", "佐藤次郎", "高橋三郎", "田中四郎", "伊藤五郎"]


def files(spark, *pairs):
    return spark.createDataFrame(list(pairs), "file string, text string")


def entry_line(boat, name="山田太郎", motor=11, equipment=21):
    return f"{boat} {5000 + boat:04d}{name}32東京52A1 6.31 52.47 8.92100.00 {motor:2d} 38.05 {equipment:2d} 29.53             10"


def result_line(boat, finish=None, name="山田太郎", motor=11, equipment=21):
    return f"  {finish or f'{boat:02d}'}  {boat} {5000 + boat:04d} {name}  {motor}   {equipment}  6.80   {boat}    0.12     1.50.1"


PAYS = [" 単勝 4 560", " 複勝 4 270 6 340", " 2連単 4-6 2480 人気 9", " 2連複 4-6 1130 人気 6", " 拡連複 4-6 490 人気 8", " 3連単 4-6-2 9750 人気 44", " 3連複 2-4-6 2060 人気 10"]


def day(races=2, cancelled=(), partial=(), venue="24", equipment=21, name=None, pays=PAYS):
    program, result = [f"{venue}BBGN"], [f"{venue}KBGN", "[払戻金] 3連単"]
    result += [f"{r:>2d}R 中　止" for r in cancelled]
    for r in range(1, races + 1):
        program.append(f"　{r}R  一般  Ｈ1800ｍ".replace("　", " "))
        program += [entry_line(b) for b in range(1, 7)]
        if r in cancelled:
            continue
        result.append(f" {r}R  一般  H1800m")
        result += [result_line(b, equipment=equipment, name=name or "山田太郎") for b in range(1, 7) if not (r in partial and b == 6)]
        result += pays
    return "\n".join(program), "\n".join(result)


def change(df, on, **values):
    """Rows that meet `on` with other values."""
    for c, v in values.items():
        v = v if isinstance(v, F.Column) else F.lit(v)
        df = df.withColumn(c, F.when(F.expr(on), v.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return df


def again(df, on):
    return df.unionByName(df.filter(on))


PARSED = [
    ({"races": 3, "cancelled": (2,)}, ""),
    ({"races": 2, "cancelled": (9,)}, ""),
    ({"partial": (1,)}, "partial_result_missing"),
    ({"equipment": 22}, "boat_equipment_mismatch"),
    ({"name": "木村太郎"}, "name_unexplained_mismatch"),
    ({"pays": PAYS[:-1]}, "payout_missing_group_count"),
    ({"pays": [*PAYS, " 単勝 3 0"]}, "payout_invalid_amounts"),
    ({"pays": [*PAYS[:-1], " 3連複 4-4-6 2060 人気 10"]}, "payout_invalid_combinations"),
]
#: Faults that no file can hold, or not alone: made in the parsed tables of a clean day (program, results, payouts).
MADE = [
    (lambda p, r, y: (again(p, "race_no = 1 and boat_no = 1"), r, y), {"duplicate_keys", "program_duplicate_keys", "invalid_race_size"}),
    (lambda p, r, y: (p, again(r, "race_no = 1 and boat_no = 1"), y), {"duplicate_keys", "result_duplicate_keys", "invalid_race_size"}),
    (lambda p, r, y: (p, change(r, "race_no = 1 and boat_no = 6", racer_id="9999"), y), {"right_only", "partial_result_missing", "invalid_race_size"}),
    (lambda p, r, y: (change(p, "race_no = 1 and boat_no = 6", boat_no=7), change(r, "race_no = 1 and boat_no = 6", boat_no=7), y), {"invalid_boat_sets"}),
    (lambda p, r, y: (p, change(r, "race_no = 1 and boat_no = 2", motor_no_result=12), y), {"motor_mismatch"}),
    (lambda p, r, y: (p, r, y.unionByName(y.filter("race_no = 1 and bet_type = 'WIN'").withColumn("bet_type", F.lit("OTHER")))), {"payout_unexpected_group_count", "payout_invalid_combinations", "payout_invalid_popularity"}),
    (lambda p, r, y: (p, r, again(y, "race_no = 1 and bet_type = 'WIN'")), {"payout_duplicate_keys"}),
    (lambda p, r, y: (p, r, change(y, "race_no = 1 and bet_type = 'TRIO'", popularity=0)), {"payout_invalid_popularity"}),
    (lambda p, r, y: (p, r, change(y, "race_no = 1 and bet_type = 'TRIO'", payout_status="CANCELLED")), {"payout_summary_mismatch"}),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Program, results and payouts of one day for each fault, parsed together and written, as the daily job does."""
    days = [day(**fault) for fault, _ in PARSED]
    made = (R.parse_program(files(spark, *[(f"B2606{i + 1:02d}.TXT", p) for i, (p, _) in enumerate(days)])), *[f(files(spark, *[(f"K2606{i + 1:02d}.TXT", k) for i, (_, k) in enumerate(days)])) for f in (R.parse_results, R.parse_payouts)])
    out = []
    for i, (d, bad) in enumerate(made):
        path = str(tmp_path_factory.mktemp("tables") / str(i))
        assert bad.count() == 0
        S.write_days(d, path)
        out.append(S.read_days(spark, path, d.schema))
    return out


def first_day(d):
    return d.filter("race_date = '2026-06-01'")


@pytest.mark.parametrize("line,want", [
    ("1 5101甲乙丙丁29東京51A1 6.02 41.17 8.44100.00 58 33.21 64 40.05             11", ("甲乙丙丁", 8.44, 100.0, 58, 64, 40.05)),
    ("3 5102甲　　乙44大阪53B1 5.25 35.10 4.75 30.42 61 25.33152 27.18 456 12       5", ("甲乙", 4.75, 30.42, 61, 152, 27.18)),
    ("1 5103丙丁戊己33愛知52A1 6.50 50.12 8.03100.00 44 38.09 57100.00             10", ("丙丁戊己", 8.03, 100.0, 44, 57, 100.0)),
    ("2 5104戊己　庚27広島54A1 7.02 51.6610.11 80.25 38 30.47128 33.94              7", ("戊己庚", 10.11, 80.25, 38, 128, 33.94)),
])
def test_program_boundaries(spark, line, want):
    d, bad = R.parse_program(files(spark, ("B260701.TXT", f"24BBGN\n 1R  一般  Ｈ1800ｍ\n{line}\n")))
    r = d.first()
    assert (r.racer_name, r.local_win_rate, r.local_place2_rate_pct, r.motor_no, r.boat_no_equipment, r.boat_place2_rate_pct) == want
    assert (r.race_date, r.venue_code, r.race_no) == ("2026-07-01", "24", 1) and bad.count() == 0


def test_rows_without_context_are_reported(spark):
    d, bad = R.parse_program(files(spark, ("B260701.TXT", f"99BBGN\n1R x\n{entry_line(1)}\n24BBGN\n{entry_line(2)}\n13R x\n{entry_line(3)}\n2R x\n{entry_line(4)}\n1 1234bad")))
    assert [(r.race_no, r.boat_no) for r in d.collect()] == [(2, 4)]
    assert [r.line_no for r in bad.orderBy("line_no").collect()] == [3, 5, 7, 10]


def test_results_with_special_finishes(spark):
    lines = ["24KBGN", " 1R  一般  H1800m", result_line(1), result_line(2, "F "), result_line(3, "S0"), "  K0  4 5104 戊 己    庚 41   66 K .         K .        .  . ", result_line(5, "00")]
    d, bad = R.parse_results(files(spark, ("K260601.TXT", "\n".join(lines))))
    rows = {r.boat_no: r for r in d.collect()}
    assert bad.count() == 0 and sorted(rows) == [1, 2, 3, 4, 5]
    assert [rows[b].finish_position for b in range(1, 6)] == [1, None, None, None, None]
    assert (rows[4].exhibition_time, rows[4].course, rows[4].racer_name_result, rows[4].finish_raw) == (None, None, "戊己庚", "K0")


def test_payouts(spark):
    # two boats share the second place; a combination after a blank line belongs to no bet
    text = "\n".join(["09KBGN", "5R 選抜 H1800m", " 単勝 3 430", " 複勝 3 240 4 170", " 2連単 3-4 990 人気 7", "        3-6 1260 人気 10", " 2連複 3-4 650 人気 5", " 拡連複 3-4 280 人気 4", "        3-6 530 人気 9", "        4-6 370 人気 5", " 3連単 3-4-6 4020 人気 21", "        3-6-4 4880 人気 26", " 3連複 3-4-6 1720 人気 8", "        3-5-6 2350 人気 13", "", "        1-3-5 2350 人気 13"])
    d, bad = R.parse_payouts(files(spark, ("K260718.TXT", text)))
    rows = d.collect()
    assert len(rows) == 13 and bad.count() == 0
    assert [r.selection_no for r in sorted(rows, key=lambda r: r.selection_no) if r.bet_type == "QUINELLA_PLACE"] == [1, 2, 3]
    assert [r.combination for r in sorted(rows, key=lambda r: r.source_line_no) if r.bet_type == "TRIFECTA"] == ["3-4-6", "3-6-4"]
    assert {r.popularity for r in rows if r.bet_type in ("WIN", "PLACE")} == {None}


def test_payout_statuses(spark):
    texts = {
        "SPECIAL_PAYOUT 1": ["05KBGN", "4R 一般 H1800m", " 単勝 特払い 70"],
        "NOT_ESTABLISHED 1": ["06KBGN", "7R 一般 H1800m", " 3連複 不成立"],
        "NOT_ESTABLISHED 7": ["10KBGN", "11R 一般 H1200m", " レース不成立", " レース不成立"],
        "CANCELLED 7": ["17KBGN", "[払戻金] 3連単", "6R 中　止", "6R 中　止"],
        "CANCELLED 84": ["20KBGN", "データは、この場の全レース終了後に登録されます。", "20KEND"],
        "REFUND 1": ["22KBGN", "9R 一般 H1800m", " 単勝 返還"],
    }
    d, _ = R.parse_payouts(files(spark, *[(f"K26060{i}.TXT", "\n".join(x)) for i, x in enumerate(texts.values(), 1)]))
    got = d.groupBy("source_file", "payout_status").agg(F.count("*").alias("n"), F.count("combination").alias("c")).orderBy("source_file").collect()
    assert [f"{r.payout_status} {r.n}" for r in got] == list(texts) and not any(r.c for r in got)


def test_special_payout_without_amount_is_unmatched(spark):
    d, bad = R.parse_payouts(files(spark, ("K260606.TXT", "05KBGN\n4R 一般 H1800m\n 単勝 特払い")))
    assert d.count() == 0 and bad.first().line_no == 3


def test_clean_days_pass_and_each_fault_fails_its_check(tables):
    program, results, payouts = tables
    rows = {r.race_date: r for r in R.daily_quality(program, results, R.scheduled_only(payouts, program)).collect()}
    assert [rows[f"2026-06-{i + 1:02d}"].failures for i in range(len(PARSED))] == [f for _, f in PARSED]
    q = rows["2026-06-01"]
    assert (q.status, q.record_count, q.race_count, q.cancelled_race_count, q.left_only) == ("SUCCESS", 18, 3, 1, 6)
    assert q.payout_group_count == 21 and q.payout_expected_group_count == 21
    assert (q.program_record_count, q.result_record_count, q.cancelled_entry_count, q.payout_cancelled_group_count) == (18, 12, 6, 7)
    assert q.merge_counts == {"both": 12, "left_only": 6} and q.finish_status_counts["CANCELLED"] == 6 and q.finish_status_counts["01"] == 2
    assert [tuple(x) for x in q.cancelled_races] == [("24", 2)]
    assert q.payout_status_counts == {"CANCELLED": 7, "NORMAL": 16} and q.payout_bet_type_counts["PLACE"] == 5 and len(q.payout_bet_type_counts) == 7


def test_every_zero_measure_has_a_fault(spark, tables):
    """Each fault on a day of its own, made in the tables of the first clean day."""
    clean = [first_day(t).filter("race_no in (1, 3)") for t in tables]
    made, want = None, {}
    for i, (fault, failing) in enumerate(MADE):
        date = f"2026-07-{i + 1:02d}"
        frames = [t.withColumn("race_date", F.lit(date)) for t in fault(*clean)]
        made = frames if made is None else [a.unionByName(b) for a, b in zip(made, frames, strict=True)]
        want[date] = failing
    got = {r.race_date: set(r.failures.split(",")) for r in R.daily_quality(*made).collect()}
    assert got == want
    assert set().union(*want.values(), {f for _, f in PARSED if f}) == set(R.ZERO)


def test_daily_job(spark, tmp_path):
    root = str(tmp_path / "store")
    good, bad, lines = day(), day(equipment=22), day()
    broken = lines[0] + "\n1 1234 no row"
    listed = [("B260601.TXT", good[0]), ("K260601.TXT", good[1]), ("B260602.TXT", bad[0]), ("K260602.TXT", bad[1]), ("B260603.TXT", broken), ("K260603.TXT", lines[1]), ("B260604.TXT", good[0]), ("b260604.TXT", good[0]), ("K260604.TXT", good[1])]
    listed += [("B260605.TXT", good[0]), ("K260605.TXT", "24KBGN\n"), ("B260606.TXT", good[0]), ("K260606.TXT", good[1]), ("k260606.TXT", good[1])]
    got = {r.race_date: (r.status, r.failures) for r in D.daily_etl(spark, files(spark, *listed), root).collect()}
    assert got["2026-06-01"] == ("SUCCESS", "") == got["2026-06-06"]
    assert got["2026-06-02"][1] == "boat_equipment_mismatch" and got["2026-06-03"][1] == "program_unmatched_lines" and "program_file_count" in got["2026-06-04"][1]
    assert {"result_without_rows", "payout_without_rows"} <= set(got["2026-06-05"][1].split(","))
    days = lambda name: sorted(str(r[0]) for r in spark.read.parquet(f"{root}/{name}").select("race_date").distinct().collect())
    assert all(days(name) == ["2026-06-01", "2026-06-06"] for name in D.TABLES) and len(days("quality")) == 6
    merged = spark.read.parquet(f"{root}/merged")
    assert merged.count() == 24 and len(merged.columns) == 34
    said = spark.read.json(f"{root}/quality_json")
    assert said.filter("status = 'SUCCESS'").count() == 2 and "merge_counts" in said.columns
    # a second run skips what succeeded and mends what did not
    mended = [("B260602.TXT", good[0]), ("K260602.TXT", good[1]), ("B260601.TXT", bad[0]), ("K260601.TXT", bad[1])]
    again = D.daily_etl(spark, files(spark, *mended), root).collect()
    assert [(r.race_date, r.status) for r in again] == [("2026-06-02", "SUCCESS")] and days("program") == ["2026-06-01", "2026-06-02", "2026-06-06"]


def test_files_without_a_day_or_kind_are_failed_rows(spark, tmp_path):
    root, good = str(tmp_path / "store"), day(races=1)
    listed = [("B260601.TXT", good[0], None), ("K260601.TXT", good[1], None), ("notes.txt", "x", None), ("B26060.TXT", good[0], None), ("B260602.TXT", good[0], None), ("K260602.TXT", good[1], None), ("X.TXT", "x", "2026-06-02")]
    d = spark.createDataFrame(listed, "file string, text string, race_date string")
    got = {r.race_date: r for r in D.daily_etl(spark, d, root).collect()}
    assert {k: (r.status, r.failures) for k, r in got.items()} == {"2026-06-01": ("SUCCESS", ""), "2026-06-02": ("FAILED", "unknown_kind_file_count"), None: ("FAILED", "undated_file_count,unknown_kind_file_count")}
    assert got[None].misfit_files == ["B26060.TXT", "notes.txt"] and (got[None].undated_file_count, got[None].unknown_kind_file_count) == (2, 1) and got["2026-06-02"].misfit_files == ["X.TXT"]
    assert spark.read.parquet(f"{root}/quality").filter("race_date is null").count() == 1
    # an unreadable quality table is an error, not a first run
    (tmp_path / "odd/quality").mkdir(parents=True)
    (tmp_path / "odd/quality/part.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="quality|footer|Parquet|parquet"):
        D.daily_etl(spark, d, str(tmp_path / "odd"))


def test_a_day_that_fails_again_is_withdrawn(spark, tmp_path):
    root, good, bad = str(tmp_path / "store"), day(races=1), day(races=1, equipment=22)
    two = [("B260601.TXT", good[0]), ("K260601.TXT", good[1]), ("B260602.TXT", good[0]), ("K260602.TXT", good[1])]
    D.daily_etl(spark, files(spark, *two), root)
    assert {D.published(spark, root, name).select("race_date").distinct().count() for name in D.TABLES} == {2}
    again = D.daily_etl(spark, files(spark, ("B260602.TXT", bad[0]), ("K260602.TXT", bad[1])), root, overwrite=True).collect()
    assert [(r.race_date, r.status) for r in again] == [("2026-06-02", "FAILED")]
    for name in D.TABLES:
        assert [str(r[0]) for r in spark.read.parquet(f"{root}/{name}").select("race_date").distinct().collect()] == ["2026-06-01"]
    assert {r.race_date: r.state for r in D.states(spark, root).collect()} == {"2026-06-01": "DONE", "2026-06-02": "DONE"}


@pytest.mark.parametrize("step", ["result", "merged", "quality", "DONE"])
def test_a_run_killed_between_two_steps_is_repaired(spark, tmp_path, monkeypatch, step):
    root, good, other = str(tmp_path / "store"), day(races=1), day(races=2)
    D.daily_etl(spark, files(spark, ("B260601.TXT", good[0]), ("K260601.TXT", good[1])), root)
    real, enter = S.write_days, D._enter

    def write(df, path, *a, **k):
        if path.endswith(f"/{step}"):
            raise KeyboardInterrupt
        real(df, path, *a, **k)

    def entered(days, where, run_id, state):
        if state == step:
            raise KeyboardInterrupt
        enter(days, where, run_id, state)

    monkeypatch.setattr(S, "write_days", write)
    monkeypatch.setattr(D, "_enter", entered)
    mended = files(spark, ("B260601.TXT", other[0]), ("K260601.TXT", other[1]))
    with pytest.raises(KeyboardInterrupt):
        D.daily_etl(spark, mended, root, overwrite=True)
    monkeypatch.undo()
    # half of the day is new and its old quality row may say SUCCESS, but it is not published
    assert D.published(spark, root, "program").count() == 0 and D.finished(spark, root).count() == 0
    again = D.daily_etl(spark, mended, root).collect()
    assert [r.status for r in again] == ["SUCCESS"] and {name: D.published(spark, root, name).count() for name in D.TABLES} == {"program": 12, "result": 12, "payout": 16, "merged": 12}
    assert D.daily_etl(spark, mended, root).count() == 0


def test_strict_parsing(spark):
    rows, bad = R.parse_program(files(spark, ("B260601.TXT", "24BBGN\n1R x\n1 1234 no row"), ("B260602.TXT", day()[0])))
    with pytest.raises(ValueError, match="1 unmatched lines.*no row"):
        R.assert_all_matched(bad)
    R.assert_all_matched(bad.filter("false"))
    assert [r.file for r in R.files_without_rows(files(spark, ("B260601.TXT", ""), ("B260602.TXT", "")), rows).collect()] == ["B260601.TXT"]


def test_month_and_audits(spark, tables):
    program, payouts = first_day(tables[0]), first_day(tables[2])
    log = spark.createDataFrame([("2026-06-01", "SUCCESS", "", 6, 1, 1), ("2026-06-02", "FAILED", "x", 6, 1, 1), ("2026-06-03", "SUCCESS", "", 6, 1, 1)], "race_date string, status string, failures string, record_count long, race_count long, venue_count long")
    requested = spark.createDataFrame([("2026-06-01",), ("2026-06-02",), ("2026-06-03",), ("2026-07-01",)], "race_date string")
    whole = {r.month: (r.days, r.succeeded, r.failed, r.status) for r in R.monthly_summary(R.day_log(requested, log)).collect()}
    assert whole == {"2026-06": (3, 2, 1, "PARTIAL"), "2026-07": (1, 0, 0, "FAILED")}
    m = R.monthly_summary(log).first()
    assert (m.days, m.succeeded, m.failed, m.status, m.record_count) == (3, 2, 1, "PARTIAL", 18)
    assert R.until_first_failure(log).count() == 2
    audit = R.payout_audit(payouts, program)
    assert audit.filter("not passed").count() == 0 and audit.count() >= 13
    assert R.payout_audit(payouts).filter("not passed").count() == 0
    short = R.payout_audit(payouts.drop("payout_yen"), program.drop("race_no"))
    assert {r.check_name: r.actual for r in short.collect()} == {"payout_columns": 1, "program_columns": 1}


@pytest.fixture(scope="module")
def months(tables):
    program, results, payouts = (first_day(t) for t in tables)
    merged = R.merge_days(program, results).select(R.MERGED_COLUMNS)
    label = lambda df: df.withColumn("month", F.lit("2026-06")).cache()
    return [label(x) for x in (program, results, merged, payouts)]


def found(frames):
    return {(r.scope, r.check_name): (r.actual, r.details) for r in R.period_audit(*frames).collect()}


def test_period_audit(months):
    assert found(months) == {}
    july = [df.withColumn("month", F.lit("2026-07")) for df in months]
    twice = found([a.unionByName(b) for a, b in zip(months, july, strict=True)])
    assert set(twice) == {("PERIOD", f"{t}_duplicate_rows") for t in ("program", "result", "merged", "normal_payout", "placeholder")}
    assert twice["PERIOD", "program_duplicate_rows"][0] == 36 and len(twice["PERIOD", "program_duplicate_rows"][1]) == 10


@pytest.mark.parametrize("table,make,want", [
    (0, lambda d: change(d, "race_no = 1 and boat_no = 1", racer_id=None), {"program_null_key_cells"}),
    (0, lambda d: change(d, "race_no = 1 and boat_no = 1", racer_id=" "), {"program_blank_key_cells"}),
    (1, lambda d: again(d, "race_no = 1 and boat_no = 1"), {"result_duplicate_rows"}),
    (2, lambda d: d.filter("race_no <> 1"), {"program_merged_race_set"}),
    (3, lambda d: d.filter("race_no <> 1"), {"program_only_races", "payout_semantic_audit"}),
    (3, lambda d: change(d, "race_no = 1", race_no=4), {"program_only_races", "payout_only_races", "payout_semantic_audit"}),
    (3, lambda d: d.filter("not (race_no = 1 and bet_type = 'WIN')"), {"races_without_exactly_7_bet_types"}),
    (3, lambda d: d.filter("bet_type <> 'WIN'"), {"races_without_exactly_7_bet_types", "bet_type_set"}),
    (3, lambda d: change(d, "race_no = 1 and bet_type = 'WIN'", combination="\t"), {"blank_combination_rows", "payout_semantic_audit"}),
    (3, lambda d: change(d, "race_no = 2 and bet_type = 'WIN'", payout_yen=1), {"payout_semantic_audit"}),
    (3, lambda d: again(d, "race_no = 2 and bet_type = 'WIN'"), {"placeholder_duplicate_rows", "payout_semantic_audit"}),
])
def test_each_period_check(months, table, make, want):
    got = found([make(df) if i == table else df for i, df in enumerate(months)])
    assert {check for scope, check in got if scope == "2026-06"} == want


def test_period_audit_of_frames_that_lack_something(months):
    assert found([months[0].drop("racer_id"), *months[1:]]) == {("PERIOD", "program_required_columns"): (1, ["racer_id"])}
    odd = found([months[0].withColumn("month", F.lit("2026-13")), *months[1:]])
    assert odd["PERIOD", "program_month_label"][0] == 18


@pytest.mark.parametrize("change,check", [
    ({"payout_status": "REFUND", "combination": None, "payout_yen": None}, "placeholder_status"),
    ({"payout_status": "CANCELLED", "combination": None, "payout_yen": 100}, "placeholder_amount"),
    ({"payout_status": "SPECIAL_PAYOUT", "combination": None, "payout_yen": 100}, "special_amount"),
    ({"combination": "\t　"}, "blank_combination"),
    ({"payout_status": "CANCELLED"}, "normal_status"),
])
def test_payout_meaning(tables, change, check):
    program, payouts = first_day(tables[0]), first_day(tables[2])
    win = (F.col("bet_type") == "WIN") & (F.col("race_no") == 1)
    for c, v in change.items():
        payouts = payouts.withColumn(c, F.when(win, F.lit(v).cast(payouts.schema[c].dataType)).otherwise(F.col(c)))
    assert [r.check_name for r in R.payout_audit(payouts, program).filter("not passed").collect()] == [check]


def test_point_in_time_features_and_scores(spark):
    p, _ = day(races=1)
    program, _ = R.parse_program(files(spark, ("B260701.TXT", p)))
    features, report = R.build_features(program)
    assert report.first().status == "SUCCESS" and features.columns == R.FEATURE_COLUMNS
    assert R.build_features(program.filter("boat_no < 6"))[0].count() == 0
    with pytest.raises(ValueError):
        R.build_features(program.withColumn("course", F.lit(1)))
    odd = R.build_features(change(program, "boat_no = 6", race_date=None))[1]
    assert {r.race_date: r.failures for r in odd.collect()} == {"2026-07-01": "race_size,boat_sets", None: "null_date,race_size,boat_sets"}
    assert R.build_features(change(program, "boat_no = 2", branch=""))[1].first().failures == "blank_category"
    model = {"intercept": "0", "coefficients": ["0"] * 8, "branch_vocabulary": ["__UNKNOWN__", "大阪"], "branch_coefficients": ["0", "5"], "class_vocabulary": ["__UNKNOWN__", "B1"], "class_coefficients": ["0", "5"]}
    for scores in (R.score_entries, R.exact_scores):
        p = lambda i, f=scores, d=features: f(d, model | {"intercept": i}).first().probability
        assert [p("0"), p("36"), p("-36")] == [Decimal("0.5"), 1, 0]
        assert scores(change(features, "true", branch=""), model).first().probability is None


def test_exact_scores_keep_digits_that_doubles_lose(spark):
    d = spark.createDataFrame([(1, 1e17, 1.0, 0.1), (2, 0.0, 0.0, 0.1), (3, None, 1.0, 1.0), (4, float("nan"), 1.0, 1.0), (5, 0.0, -800.0, 0.0)], "k int, a double, b double, c double")
    got = {r.k: r.p for r in d.select("k", scoring.exact_probability("0.25", ["1", "1", "3"], [F.col(c) for c in "abc"]).alias("p")).collect()}
    with localcontext() as ctx:
        ctx.prec = 60
        by_hand = lambda z: (1 / (1 + (-z).exp())).quantize(Decimal("1e-15"))
        assert got == {1: 1, 2: by_hand(Decimal("0.25") + 3 * Decimal(0.1)), 3: None, 4: None, 5: 0}
    # 1e17 + 1 - 1e17 is 0 in doubles
    e = spark.createDataFrame([(1e17, 1.0)], "a double, b double")
    exact = e.select(scoring.exact_probability("0", ["1", "1", "-1"], [F.col("a"), F.col("b"), F.col("a")]).alias("p")).first().p
    assert exact == Decimal(str(round(1 / (1 + math.exp(-1)), 15)))


def test_model_rules(spark):
    good = ("m", ["a", "b"], [0.5, -1.0], [0, 1], 1, 0.25, ["a", "b"])
    rows = [good, ("count", ["a", "b"], [0.5], *good[3:]), ("names", ["a", "a"], *good[2:6], ["a", "a"]), ("finite", good[1], [0.5, float("nan")], *good[3:]), ("class", *good[1:4], 0, *good[5:]), ("order", *good[1:6], ["b", "a"])]
    d = spark.createDataFrame(rows, "model_id string, feature_names array<string>, coefficients array<double>, classes array<int>, positive_class int, intercept double, contract_features array<string>")
    assert {r.model_id: r.failures for r in scoring.model_report(d).collect()} == {"m": "", "count": "coefficient_count", "names": "repeated_names", "finite": "not_finite", "class": "positive_class", "order": "feature_order"}
    x = d.select(*[c.alias(f"x{i}") for i, c in enumerate(scoring.one_hot(scoring.vocabulary_index(F.lit("b"), ["?", "a", "b"]), 3))]).first()
    assert tuple(x) == (0.0, 0.0, 1.0)


SOURCE = ("2026-07-01", "2026-06-30T12:30:00Z", "http://x", "d" * 64, "c1", "e" * 64)


def sources(spark, *rows):
    d = spark.createDataFrame(list(rows), "race_date string, t string, source_url string, source_sha256 string, collector_version string, deadline_evidence_sha256 string")
    return d.select("race_date", F.to_timestamp("t").alias("fetched_at"), F.to_timestamp("t").alias("snapshot_at"), "source_url", "source_sha256", "collector_version", "deadline_evidence_sha256")


def test_snapshot_and_its_audit(spark):
    program, _ = R.parse_program(files(spark, ("B260701.TXT", day(races=1)[0])))
    frame = R.snapshot(program, sources(spark, SOURCE))
    assert len(frame.columns) == 33 and R.snapshot_audit(frame).first().failures == ""
    late = R.snapshot(program, sources(spark, (SOURCE[0], "2026-06-30T12:30:01Z", *SOURCE[2:])))
    assert R.snapshot_audit(late).first().failures == "future_source_rows,ineligible_status_rows"
    assert "null_provenance" in R.snapshot_audit(R.snapshot(program, sources(spark, ("2026-07-02", *SOURCE[1:])))).first().failures
    text = frame.withColumn("source_max_time", F.lit("2026-06-30T12:30:00"))
    faults = {
        "source_alias_mismatches": change(frame, "boat_no = 1", source_max_time=F.to_timestamp(F.lit("2026-06-30T12:00:00Z"))), "source_digests": change(frame, "boat_no = 1", feature_source_sha256="f"),
        "deadline_digests": change(frame, "boat_no = 1", deadline_evidence_sha256="f"), "ineligible_status_rows": change(frame, "boat_no = 1", provenance_status="OTHER"), "invalid_timestamps": text, "null_provenance": change(frame, "boat_no = 1", feature_source_url=None),
    }
    assert {k: R.snapshot_audit(d).first().failures for k, d in faults.items()} == {k: k for k in faults}
    with pytest.raises(ValueError):
        R.snapshot_audit(frame.drop("snapshot_at"))
    with pytest.raises(ValueError):
        R.snapshot(program.withColumn("Payout_yen", F.lit(1)), sources(spark, SOURCE))


def test_feature_matrix(spark, tmp_path):
    program, _ = R.parse_program(files(spark, ("B260701.TXT", day(races=2)[0]), ("B260702.TXT", day(races=2)[0])))
    frame = R.snapshot(program, sources(spark, SOURCE, ("2026-07-02", "2026-07-01T12:30:01Z", *SOURCE[2:])))
    matrix, report = R.build_feature_matrix(frame)
    rows = {r.race_date: r for r in report.collect()}
    assert rows["2026-07-01"].status == "SUCCESS" and rows["2026-07-02"].failures == "snapshot: future_source_rows,ineligible_status_rows"
    assert matrix.columns == R.FEATURE_COLUMNS and matrix.count() == 12 and len(rows["2026-07-01"].schema_sha256) == 64
    checked = lambda d, **k: R.matrix_audit(d, **k).first().failures
    assert checked(matrix) == "" and checked(matrix.filter("boat_no <> 1 or race_no <> 1")) == "row_count"
    assert checked(change(matrix, "boat_no = 1", age=None)) == "nulls" and checked(change(matrix, "boat_no = 1", local_win_rate=F.lit(float("inf")))) == "not_finite"
    assert checked(change(matrix, "boat_no = 1", boat_no=2)) == "repeated_keys"
    # the stored order, by place in the file
    S.write_days(matrix, str(tmp_path / "m"), order=["venue_code", "race_no", "boat_no"])
    stored = lambda path: spark.read.schema(matrix.schema).parquet(path).select(*R.FEATURE_COLUMNS, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    assert checked(stored(str(tmp_path / "m")), position=["_file", "_row"]) == ""
    matrix.coalesce(1).orderBy(F.desc("boat_no")).coalesce(1).write.parquet(str(tmp_path / "n"))
    assert checked(stored(str(tmp_path / "n")), position=["_file", "_row"]) == "order"


def test_encoded_files_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    p, k = day(races=1)
    (tmp_path / "in/B260601.TXT").write_bytes(p.encode("cp932"))
    f = S.read_encoded(spark, str(tmp_path / "in"))
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"
    program, _ = R.parse_program(f)
    assert program.count() == 6 and program.first().branch == "東京"
    out = str(tmp_path / "days")
    S.write_days(program, out)
    S.write_days(program.withColumn("race_date", F.lit("2026-06-02")).limit(2), out)
    back = S.read_days(spark, out, program.schema)
    assert sorted((r.race_date, r["n"]) for r in back.groupBy("race_date").agg(F.count("*").alias("n")).collect()) == [("2026-06-01", 6), ("2026-06-02", 2)]
    assert back.first().venue_code == "24"
    manifest = spark.createDataFrame([("2026-06-01", 6), ("2026-06-02", 3)], "race_date string, row_count long")
    assert {r.race_date: r.agrees for r in S.readback(back, manifest).collect()} == {"2026-06-01": True, "2026-06-02": False}
    full = spark.createDataFrame([("2026-06-01", 6, 1, "24"), ("2026-06-02", 2, 1, "23")], "race_date string, row_count long, race_count long, venue_code string")
    kept = S.readback(back, full, races=R.RACE, constants=["venue_code"], schema=back.schema)
    assert {r.race_date: r.agrees for r in kept.collect()} == {"2026-06-01": True, "2026-06-02": False}
    assert not S.readback(back.withColumn("age", F.col("age").cast("int")), full, schema=back.schema).first().agrees
    (tmp_path / "in/B260602.TXT").write_bytes(b"\x81")
    with pytest.raises(Exception):  # noqa: B017
        S.read_encoded(spark, str(tmp_path / "in/B260602.TXT")).select("text").collect()


def test_sidecars_content_and_choice(spark, tmp_path):
    import hashlib

    (tmp_path / "a").mkdir()
    whole = b"xx-lh5-" + b"z" * 100
    (tmp_path / "a/one.lzh").write_bytes(whole)
    (tmp_path / "a/two.lzh").write_bytes(b"no magic")
    (tmp_path / "a/three.lzh").write_bytes(b"")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    d = spark.read.format("binaryFile").load(str(tmp_path / "a")).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content", "length", F.sha2("content", 256).alias("sha256"))
    recorded = spark.createDataFrame([("one.lzh", len(whole), sha(whole)), ("two.lzh", 9, "0"), ("three.lzh", 0, sha(b"")), ("four.lzh", 1, "0")], "file string, length long, sha256 string")
    # Spark lists no empty file
    assert {r.file: r.differences for r in S.audit_content(d, recorded).collect()} == {"one.lzh": [], "two.lzh": ["length", "sha256", "magic"], "three.lzh": ["absent"], "four.lzh": ["absent"]}
    (tmp_path / "m").mkdir()
    for name, text in (("a", '{"race_date": "2026-07-01", "source_url": "u"}'), ("b", '{"race_date": "2026-07-02", "source_url": null}'), ("c", "{broken")):
        (tmp_path / f"m/{name}.json").write_text(text)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("race_date", T.StringType()), T.StructField("source_url", T.StringType())])
    got = S.read_sidecars(spark, str(tmp_path / "m"), schema, ["race_date", "source_url"])
    assert sorted((r.race_date or "", r.missing) for r in got.collect()) == [("", ["race_date", "source_url"]), ("2026-07-01", []), ("2026-07-02", ["source_url"])]
    listing = spark.createDataFrame([(1, "a"), (1, "kb"), (2, "a"), (2, "b"), (3, "c")], "u int, file string")
    chosen, errors = S.one_file_each(listing, ["u"], F.when(F.col("file").startswith("k"), 1).otherwise(0))
    assert {(r.u, r.file) for r in chosen.collect()} == {(1, "kb"), (3, "c")} and {(r.u, r.n) for r in errors.collect()} == {(2, 2)}


def test_a_later_file_of_a_day_adds_to_it(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / "in" / name).write_text(json.dumps({"file": name, "text": text}))
    job = lambda df: R.parse_program(df.select("file", "text"))[0]

    def run():
        stream = spark.readStream.schema("file string, text string").json(str(tmp_path / "in"))
        run_on_arrival(stream, job, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        back = spark.read.parquet(str(tmp_path / "out"))
        return sorted((str(r.race_date), r.source_file, r["n"]) for r in back.groupBy("race_date", "source_file").agg(F.count("*").alias("n")).collect())

    put("B260601.TXT", day(races=1)[0])
    assert run() == [("2026-06-01", "B260601.TXT", 6)]
    put("B260601b.TXT", day(races=2, venue="23")[0])
    assert run() == [("2026-06-01", "B260601.TXT", 6), ("2026-06-01", "B260601b.TXT", 12)]
