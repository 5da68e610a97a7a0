"""Order checks by stitched ranges, and context carried over the chunks of long files, against whole ones."""

import random

import pytest
from pyspark.sql import functions as F
from test_racing import day, files

from racelake.operators import ordered
from racelake.plans import racing as R
from racelake.sources import text_files as S


def brute(rows, strict, by):
    """rows of (group, position, value...) -> falls as (group, position, value, value above)."""
    low = lambda v: tuple((x is not None, x or 0) for x in v)
    rows = sorted(rows, key=lambda r: ((low(r[:1]) if by else ()), low(r[1:2])))
    out = []
    for a, b in zip(rows, rows[1:], strict=False):
        if by and a[0] != b[0]:
            continue
        x, y = low(a[2:]), low(b[2:])
        if x > y or strict and x == y:
            out.append((*(b[:1] if by else ()), b[1], *b[2:], *a[2:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_falls(spark, parts, strict, by):
    some = random.Random(parts)
    rows = [(some.choice(["a", "b", "c", None]), k, some.choice([None, 1, 2, 3]), some.choice(["x", "y", None])) for k in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = ordered.order_falls(spark.createDataFrame(rows, "g string, p int, v int, w string"), ["p"], ["v", "w"], by, strict)
        assert got.columns == [*by, "p", "v", "w", "before_v", "before_w"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, strict, by)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_rows_and_no_day_window(spark):
    d = spark.createDataFrame([], "p int, v int")
    assert ordered.order_falls(d, ["p"], ["v"]).count() == 0
    d = spark.range(1000).select("id", (F.lit(0) - F.col("id")).alias("v"))
    plan = ordered.order_falls(d, ["id"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and ordered.order_falls(d, ["id"], ["v"]).count() == 999


@pytest.fixture
def long_files(spark, tmp_path):
    """A program and a result file of many venues, read whole and in chunks of some hundred bytes."""
    venues = [day(races=12, venue=f"{v:02d}", cancelled=(v % 12 + 1,)) for v in range(1, 25)]
    texts = {"B260601.TXT": "\r\n".join(p for p, _ in venues), "K260601.TXT": "\n".join(k for _, k in venues) + "\n", "B260602.TXT": "\n1 1234 no row\n" + venues[0][0].replace("\n", "\x0b", 3)}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode("cp932"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 9000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield texts, str(tmp_path)
    for k, v in before.items():
        spark.conf.set(k, v)


def same(a, b):
    assert a.columns == b.columns
    x, y = (sorted((tuple(r) for r in d.collect()), key=str) for d in (a, b))
    assert x and x == y


def test_a_long_file_is_parsed_by_many_tasks(spark, long_files):
    texts, path = long_files
    whole = {k: files(spark, *[(n, t) for n, t in texts.items() if n[0] == k]) for k in "BK"}
    lines = {k: S.read_lines(spark, f"{path}/{k}*.TXT") for k in "BK"}
    chunks = lines["B"].groupBy("file").agg(F.count_distinct("chunk").alias("n")).filter("file = 'B260601.TXT'").first().n
    assert chunks > 10 and lines["B"].rdd.getNumPartitions() > 10
    for k, parse in (("B", R.parse_program), ("K", R.parse_results), ("K", R.parse_payouts)):
        (rows, bad), (long_rows, long_bad) = parse(whole[k]), parse(lines[k])
        same(rows, long_rows)
        assert sorted(map(str, bad.collect())) == sorted(map(str, long_bad.collect()))
    # the windows over lines are those of chunks, and of one row for each chunk
    plan = R.parse_program(lines["B"])[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "chunk" in plan


def test_carried_values_equal_one_window(spark):
    some = random.Random(3)
    rows = [(f, p, p // 5, some.choice([None, None, p]), some.choice([None, None, None, f"{p}"])) for f in "abc" for p in range(60)]
    d = spark.createDataFrame(rows, "f string, p int, c int, v int, w string")
    values = {"x": F.col("v"), "y": F.when(F.col("w").isNotNull(), F.struct("w"))}
    same(ordered.carried(d, ["f"], "p", values), ordered.carried(d, ["f"], "p", values, "c").select("f", "p", "c", "v", "w", "x", "y"))
    n = ordered.numbered(d.withColumn("p", F.col("p") * 7), ["f"], "p", "c")
    assert {(r.f, r.line_no) for r in n.collect()} == {(f, k) for f in "abc" for k in range(1, 61)} and n.filter("line_no <> p / 7 + 1").count() == 0
