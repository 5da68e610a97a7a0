"""The registered queries: each operator applied to whole tables of the star schema. A race is an order, an entry a line item, a payout an event, a source line a line of a document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import checks, dealing, lineage, ordered, pit, reconcile, scoring
from ..sources import content, text_files

from . import binding, racing
from . import daily as day_jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def n_where(c) -> F.Column:
    return checks.count_where(c)


# --- text


def _lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.explode(X.numbered_lines(F.col("text"))).alias("x"))
    return d.select("doc_id", F.col("x.no").alias("line_no"), F.col("x.line").alias("line"))


@query
def text_lines(spark, sf):
    return _lines(spark, sf)


ACCENTED, BARE = "áàâäãéèêëíìîïóòôöõúùûüçñÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑ", "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


@query
def normalize_text(spark, sf):
    return _lines(spark, sf).select("doc_id", "line_no", F.translate("line", ACCENTED, BARE).alias("norm"))


@query
def clean_text(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.squeeze_out(F.col("p_name")).alias("name"), F.upper(X.strip_all(F.col("p_type"))).alias("kind"), X.pad_id(F.col("p_partkey"), 8).alias("key8"))


@query
def unmatched_rows(spark, sf):
    bad = F.col("line").rlike("^[A-Z]") & ~F.col("line").rlike("\\.$")
    return _lines(spark, sf).filter(bad).groupBy("doc_id").agg(F.count("*").alias("n"), F.min("line_no").cast("long").alias("first_line"))


@query
def classify_lines(spark, sf):
    c = F.col("line")
    kind = F.when(c.rlike("^[ \\t]*$"), "blank").when(c.rlike("[0-9]{3}"), "digits").when(c.rlike("\\.$"), "sentence").when(c.contains("***") | c.contains("###"), "rule").otherwise("other")
    return _lines(spark, sf).groupBy("doc_id", kind.alias("kind")).agg(F.count("*").alias("n"))


@query
def explode_matches(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "url"))
    return p.select("page_id", (F.col("pos") + 1).alias("pos"), "url")


@query
def files_without_rows(spark, sf):
    found = _lines(spark, sf).filter(F.col("line").rlike("[0-9]{3}")).select("doc_id").distinct()
    return table(spark, sf, "documents").select("doc_id").join(found, "doc_id", "left_anti")


@query
def key_from_name(spark, sf):
    key = F.regexp_extract("c_name", "#([0-9]+)$", 1).cast("long")
    return table(spark, sf, "customer").select("c_custkey", key.alias("name_key"), (key == F.col("c_custkey")).alias("same"))


PRIORITIES = {"1-URGENT": "U", "2-HIGH": "H", "3-MEDIUM": "M", "4-NOT SPECIFIED": "N", "5-LOW": "L"}


@query
def code_map(spark, sf):
    return table(spark, sf, "orders").groupBy(X.code_of(F.col("o_orderpriority"), PRIORITIES).alias("code")).agg(F.count("*").alias("n"))


@query
def tolerant_cast(spark, sf):
    brand, kind = F.regexp_extract("p_brand", "#(.*)$", 1).try_cast("int"), F.col("p_type").try_cast("int")
    return table(spark, sf, "part").agg(F.sum(brand).alias("brand_sum"), n_where(brand.isNull()).alias("brand_nulls"), n_where(kind.isNull()).alias("type_nulls"))


@query
def status_case(spark, sf):
    c = F.col("o_orderstatus")
    return table(spark, sf, "orders").groupBy(F.when(c == "F", "FINISHED").when(c == "O", "OPEN").when(c == "P", "PARTIAL").alias("label")).agg(F.count("*").alias("n"))


@query
def context_ffill(spark, sf):
    # conversations in chunks of four turns, as long files are in chunks of lines
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.expr("turn div 4").alias("chunk"))
    head = F.when(F.col("role").isin("user", "system"), F.col("turn"))
    return ordered.carried(c, ["conv_id"], "turn", {"ctx_turn": head}, "chunk").select("conv_id", "turn", "ctx_turn")


@query
def selection_no(spark, sf):
    w = Window.partitionBy("user_id", "event_type", F.to_date("ts")).orderBy("ts", "event_id")
    return table(spark, sf, "events").select("event_id", F.row_number().over(w).alias("no"))


# --- sources and contracts


@query
def exactly_one_per_group(spark, sf):
    # the one open order of each customer, else its one other; customers with several equally good ones are errors
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("file"), "o_orderstatus")
    chosen, errors = text_files.one_file_each(o, ["o_custkey"], F.when(F.col("o_orderstatus") == "O", 1).otherwise(0))
    return chosen.select("o_custkey", "file", F.lit(1).cast("long").alias("n")).unionByName(errors.select("o_custkey", F.lit(None).cast("long").alias("file"), F.col("n").cast("long")))


@query
def daily_files(spark, sf):
    # an order is a file of its day; planted: names without a date, kinds that none reads, preferred ones, several of a kind
    k = F.col("o_orderkey")
    letter = F.when(k % 50 == 7, "X").when(k % 10 == 3, "k").when(k % 2 == 0, "B").otherwise("K")
    name = F.concat(letter, F.when(k % 97 == 5, "none").otherwise(F.date_format("o_orderdate", "yyMMdd")), F.lit("_"), k.cast("string"))
    o = table(spark, sf, "orders").select(name.alias("file"), F.when(k % 100 == 57, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("said"))
    listed = day_jobs.with_kinds(o.select("file", text_files.date_from_name(F.col("file"), "[BK]", F.col("said")).alias("race_date")))
    chosen = day_jobs.choose(listed).groupBy("race_date").agg(F.max(F.when(F.col("kind") == "program", F.col("file"))).alias("program"), F.max(F.when(F.col("kind") == "result", F.col("file"))).alias("result"))
    odd = day_jobs.misfits_of(listed).select("race_date", F.col("undated_file_count").alias("undated"), F.col("unknown_kind_file_count").alias("unknown"), F.array_join("misfit_files", ",").alias("misfits"))
    return reconcile.full_outer(chosen, odd, ["race_date"]).select("race_date", "program", "result", F.coalesce("undated", F.lit(0)).alias("undated"), F.coalesce("unknown", F.lit(0)).alias("unknown"), "misfits")


@query
def pair_completeness(spark, sf):
    d, l = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    side = F.when(F.col("side") == "both", "both").when(F.col("side") == "left_only", "doc_only").otherwise("label_only")
    return reconcile.full_outer(d, l, ["doc_id"]).groupBy(side.alias("status")).agg(F.count("*").alias("n"))


@query
def incremental_skip(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    done = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.lit("SUCCESS").alias("status")).distinct()
    return text_files.unfinished(o, done, "day").select(F.col("day").cast("string"))


@query
def readback_counts(spark, sf):
    # the manifest says one row too many for every hundredth order
    li = table(spark, sf, "lineitem").select("l_orderkey")
    said = li.groupBy("l_orderkey").agg((F.count("*") + F.when(F.col("l_orderkey") % 100 == 0, 1).otherwise(0)).alias("row_count"))
    j = text_files.readback(li, said, "l_orderkey")
    return j.agg(F.count("*").alias("units"), F.sum("row_count").alias("recorded_rows"), F.sum("rows").alias("actual_rows"), n_where(~F.col("agrees")).alias("mismatches"))


@query
def readback_content(spark, sf):
    # lines stored by month of shipment, as they should be and as they are: a changed cell, a swapped pair of cells, a lost row, a repeated one
    keys = ["l_orderkey", "l_linenumber"]
    a = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("unit"), *keys, "l_quantity", "l_extendedprice", "l_returnflag")
    me = F.struct(*keys, "l_extendedprice")
    ends = a.groupBy("unit").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    j = a.join(F.broadcast(ends), "unit").withColumn("_k", F.substring("unit", 6, 2).cast("int") % 6)  # a row for each month
    price = F.when((F.col("_k") == 2) & (me == F.col("low")), F.col("high.l_extendedprice")).when((F.col("_k") == 2) & (me == F.col("high")), F.col("low.l_extendedprice")).otherwise(F.col("l_extendedprice"))
    b = j.filter(~((F.col("_k") == 3) & (me == F.col("low")))).withColumn("_copies", F.when((F.col("_k") == 4) & (me == F.col("high")), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    b = b.select("unit", *keys, (F.col("l_quantity") + F.when((F.col("_k") == 1) & (me == F.col("low")), 1).otherwise(0)).alias("l_quantity"), price.alias("l_extendedprice"), "l_returnflag", F.explode("_copies").alias("_c")).drop("_c")
    found = content.content_report(content.column_digests(a, keys, ["unit"]), content.column_digests(b, keys, ["unit"]), ["unit"])
    return found.select("unit", F.col("rows_written").alias("rows"), F.array_join("differs", ",").alias("differs"), "status")


@query
def schema_contract(spark, sf):
    # every departure, and the null cells of the order's line columns, which an order without lines has
    from pyspark.sql import types as T

    kinds = {"l_orderkey": T.LongType(), "lines": T.LongType(), "o_orderkey": T.StringType(), "line_status": T.StringType(), "l_commitdate": T.DateType()}
    contract = T.StructType([T.StructField(c, t, c in ("l_orderkey", "l_commitdate")) for c, t in kinds.items()])
    return checks.contract_report(_joined(spark, sf).select("o_orderkey", "l_orderkey", "lines", "line_status", "o_orderstatus"), contract, ["o_orderstatus"])


@query
def contract_projection(spark, sf):
    return checks.contract_projection(table(spark, sf, "lineitem"), {"l_orderkey": "race_key", "l_linenumber": "entry_no", "l_suppkey": "racer", "l_quantity": "weight", "l_returnflag": "flag", "l_linestatus": "state"})


def _props(spark, sf):
    return table(spark, sf, "events").withColumn("_p", F.from_json("props", "k long"))


@query
def json_required_fields(spark, sf):
    k = F.col("_p.k")
    return _props(spark, sf).groupBy("event_type").agg(n_where(k.isNull()).alias("missing_k"), F.sum(k).alias("sum_k"))


@query
def json_forbidden_keys(spark, sf):
    # each event in a document of its own depth
    e = table(spark, sf, "events")
    doc = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"a":{"Result":[1,'), F.col("props"), F.lit("]}}"))).otherwise(F.concat(F.lit('[[{"b":'), F.col("props"), F.lit(',"c":{"odds":null}}]]')))
    return checks.forbidden_keys(e.select("event_type", doc.alias("doc")), ["event_type"], "doc", ("k", "result", "odds")).groupBy("event_type", "path", "key").agg(F.count("*").alias("n"))


@query
def null_blank_split(spark, sf):
    # null is a placeholder, blank an error
    note = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 5 == 0, F.lit(" \t　")).otherwise(F.col("c_mktsegment"))
    c = table(spark, sf, "customer").select("c_nationkey", note.alias("note"))
    kind = F.when(F.col("note").isNull(), "placeholder").when(X.strip_all(F.col("note")) == "", "blank").otherwise("normal")
    return c.groupBy("c_nationkey", kind.alias("kind")).agg(F.count("*").alias("n"))


# --- rules


@query
def range_check(spark, sf):
    return checks.violations(table(spark, sf, "lineitem"), {"quantity": checks.between("l_quantity", 1, 49), "discount": checks.between("l_discount", 0, 0.09), "tax": checks.between("l_tax", 0, 0.07), "integral_quantity": checks.integral("l_quantity")})


@query
def text_rules(spark, sf):
    p = checks.violations(table(spark, sf, "part"), {"brand": F.col("p_brand").rlike("^Brand#[0-9]{2}$"), "part_name": X.strip_all(F.col("p_name")) != ""})
    return p.unionByName(checks.violations(table(spark, sf, "customer"), {"customer_name": F.col("c_name").rlike("^Customer#[0-9]{9}$")}))


@query
def enum_check(spark, sf):
    ok = F.lower(F.trim("event_type")).isin("view", "click", "purchase")
    return checks.violations(table(spark, sf, "events"), {"event_type": ok})


@query
def conditional_required(spark, sf):
    t, v = F.col("event_type"), F.col("value")
    return checks.violations(table(spark, sf, "events"), {"purchase_value": (t != "purchase") | (v > 5), "error_value": (t != "error") | (v <= 5)})


@query
def date_homogeneity(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count_distinct(F.date_format("l_shipdate", "yyyy-MM")).alias("months"))
    return g.filter("months > 1")


@query
def array_validity(spark, sf):
    e = F.col("embedding")
    t = table(spark, sf, "embeddings").groupBy("label")
    return t.agg(F.count("*").alias("n"), n_where(F.size(e) != 64).alias("bad_size"), n_where(F.size(F.array_distinct(e)) < F.size(e)).alias("repeated"), n_where(~F.forall(e, lambda x: x.between(-1, 1))).alias("out_of_range"))


@query
def attach_provenance(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")  # a code list of 25 rows
    o = table(spark, sf, "orders").select("o_custkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


# --- reconciliation


def _per_order(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.max("l_linestatus").alias("line_status"))


def _joined(spark, sf):
    o = table(spark, sf, "orders").withColumn("l_orderkey", F.col("o_orderkey"))
    return reconcile.full_outer(o, _per_order(spark, sf), ["l_orderkey"])


@query
def outer_reconcile(spark, sf):
    differs = (F.col("side") == "both") & F.coalesce(F.col("o_orderstatus") != F.col("line_status"), F.lit(True))
    side = F.col("side")
    g = _joined(spark, sf).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return g.agg(n_where(side == "both").alias("both_sides"), n_where(side == "left_only").alias("left_only"), n_where(side == "right_only").alias("right_only"), n_where(differs).alias("status_mismatch"))


@query
def group_absence(spark, sf):
    j = _joined(spark, sf).filter("side <> 'right_only'")
    return reconcile.group_absence(j, ["o_custkey"], F.col("side") == "left_only").select("o_orderkey", "o_custkey", "absence")


@query
def conditional_anti(spark, sf):
    o = table(spark, sf, "orders").withColumn("l_orderkey", F.col("o_orderkey"))
    kept = reconcile.conditional_anti(o, F.col("o_orderstatus") == "P", table(spark, sf, "lineitem").select("l_orderkey"), ["l_orderkey"])
    return kept.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query
def key_set_diff(spark, sf):
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return reconcile.key_set_diff(c, o, "k")


@query
def name_match(spark, sf):
    p = table(spark, sf, "part").select(F.lower("p_type").alias("a"), F.lower("p_name").alias("b"))
    return p.groupBy(reconcile.name_match(p, "a", "b").alias("kind")).agg(F.count("*").alias("n"))


@query
def grid_coverage(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "user_id", "event_type")
    types = spark.createDataFrame([(t,) for t in ("view", "click", "purchase", "signup")], "event_type string")
    expected = reconcile.grid(e.select("day", "user_id").distinct(), types)
    return reconcile.coverage(expected, e, ["day", "user_id", "event_type"], ["day"]).withColumn("day", F.col("day").cast("string"))


@query
def inventory(spark, sf):
    # event types of each day against five expected ones, in an order of their own
    codes = {"view": 1, "click": 2, "purchase": 3, "refund": 10, "signup": 11}
    e = table(spark, sf, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type")
    expected = reconcile.grid(e.select("day").distinct(), spark.createDataFrame([(t,) for t in codes], "event_type string"))
    place = F.coalesce(X.code_of(F.col("event_type"), {t: str(n) for t, n in codes.items()}).cast("int"), F.lit(99))
    out = reconcile.inventory(expected, e, ["day", "event_type"], ["day"], place)
    return out.select("day", "present", F.array_join("missing", ",").alias("missing"), F.array_join("unexpected", ",").alias("unexpected"))


BET_CODES = ("WIN", "PLACE", "EXACTA", "QUINELLA", "QUINELLA_PLACE", "TRIFECTA", "TRIO")


@query
def grid_expand(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    codes = F.posexplode(F.array(*[F.lit(c) for c in BET_CODES])).alias("pos", "code")
    return o.select("o_orderkey", codes).select("o_orderkey", (F.col("pos") + 1).alias("no"), "code")


@query
def category_completeness(spark, sf):
    kinds = ["click", "error", "purchase", "signup", "view"]
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM").alias("month"), F.to_date("ts").alias("day"), "user_id", F.lower(F.trim("event_type")).alias("kind"))
    per_day = e.groupBy("month", "day", "user_id").agg(F.count_distinct("kind").alias("k")).groupBy("month").agg(n_where(F.col("k") < 5).alias("incomplete_days"))
    per_month = e.groupBy("month").agg((F.array_sort(F.collect_set("kind")) == F.array(*[F.lit(k) for k in kinds])).alias("complete"))
    return per_month.join(per_day, "month")


# --- keys and groups


@query
def group_member_set(spark, sf):
    return checks.group_member_set(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber").filter("complete").select("l_orderkey", "n")


@query
def group_size(spark, sf):
    return checks.group_size(table(spark, sf, "lineitem"), ["l_orderkey"], 4).groupBy("n").agg(F.count("*").alias("orders"))


LINE_KEY = ["l_orderkey", "l_linenumber"]


@query
def dup_surplus(spark, sf):
    return checks.dup_surplus(table(spark, sf, "lineitem"), LINE_KEY, ["l_returnflag"])


@query
def dup_groups(spark, sf):
    return checks.dup_groups(table(spark, sf, "lineitem"), LINE_KEY)


@query
def value_counts(spark, sf):
    j = _joined(spark, sf).filter("side <> 'right_only'").withColumn("status", F.when(F.col("side") == "both", F.col("o_orderstatus")))
    return checks.value_counts(j, "status", "CANCELLED")


@query
def null_profile(spark, sf):
    j = _joined(spark, sf).filter("side <> 'right_only'")
    return checks.null_profile(j, ["o_orderkey", "o_orderstatus", "o_orderpriority", "lines", "line_status"])


@query
def distinct_counts(spark, sf):
    j = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.agg(F.count_distinct("quality").alias("without_null"), F.count_distinct(F.struct("quality")).alias("with_null"))


@query
def group_homogeneity(spark, sf):
    return checks.group_homogeneity(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linestatus").groupBy("homogeneous").agg(F.count("*").alias("n"))


# --- reports

ZERO = ["left_only", "duplicates", "size_violations"]


def _daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Per order: day, lines, surplus line keys, lines out of range, revenue. Lines are brought to one row per order first, so the join moves one row for each order."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    keys = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n"), n_where(~checks.between("l_quantity", 1, 49)).alias("bad"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev")
    )
    per_order = keys.groupBy("l_orderkey").agg(F.sum("n").alias("lines"), F.sum(F.col("n") - 1).alias("dups"), F.sum("bad").alias("bad"), F.sum("rev").alias("rev"))
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"], "left")


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Per order date: orders, lines, orders without lines, surplus line keys, lines out of range, revenue."""
    j = _daily_orders(spark, sf)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return j.groupBy("day").agg(F.count("*").alias("orders"), zero("lines").alias("lines"), n_where(F.col("lines").isNull()).alias("left_only"), zero("dups").alias("duplicates"), zero("bad").alias("size_violations"), F.round(F.coalesce(F.sum("rev"), F.lit(0.0)), 4).alias("revenue"))


@query
def daily_quality(spark, sf):
    return daily(spark, sf).withColumn("day", F.col("day").cast("string"))


@query
def quality_gate(spark, sf):
    return checks.gate(daily(spark, sf), ZERO).select(F.col("day").cast("string"), "failures", "status")


@query
def monthly_rollup(spark, sf):
    d = checks.gate(daily(spark, sf), ZERO).groupBy(F.date_format("day", "yyyy-MM").alias("month"))
    m = d.agg(F.count("*").alias("days"), n_where(F.col("status") == "SUCCESS").alias("ok_days"), n_where(F.col("status") == "FAILED").alias("failed_days"), F.sum("lines").alias("lines"), F.sum("orders").alias("orders"))
    status = F.when((F.col("failed_days") == 0) & (F.col("days") == F.dayofmonth(F.last_day(F.to_date(F.concat("month", F.lit("-01")))))), "SUCCESS").when(F.col("ok_days") > 0, "PARTIAL").otherwise("FAILED")
    return m.withColumn("status", status)


@query
def period_audit(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    # keys nearly all differ: both sides are dealt out by orders, and what is joined is grouped where it is
    rows = li.count()
    j = dealing.dealt(o, ["o_orderkey"], rows).join(dealing.dealt(li, ["l_orderkey"], rows), F.col("o_orderkey") == F.col("l_orderkey"))
    keys = j.groupBy("month", *LINE_KEY).agg(F.count("*").alias("n"), n_where(F.col("l_quantity") > 45).alias("large"))
    sums = keys.groupBy("month").agg(F.sum("n").alias("rows"), F.sum("large").alias("large"), F.sum(F.col("n") - 1).alias("surplus"))
    # duplicates are not additive: a key repeated in two months counts for the period alone
    whole = keys.groupBy(*LINE_KEY).agg(F.sum("n").alias("n"), F.sum("large").alias("large")).agg(F.sum("n").alias("rows"), F.sum("large").alias("large"), F.sum(F.col("n") - 1).alias("surplus"))
    return sums.withColumnRenamed("month", "scope").unionByName(whole.withColumn("scope", F.lit("PERIOD")))


@query
def failed_checks_long(spark, sf):
    failed = checks.failed_long(daily(spark, sf), "day", ZERO)
    o = _daily_orders(spark, sf).withColumn("scope", F.col("day").cast("string"))
    bad = {"left_only": F.col("lines").isNull(), "duplicates": F.col("dups") > 0, "size_violations": F.col("bad") > 0}
    shown = [checks.examples(o.filter(c), ["scope"], name, F.col("o_orderkey")) for name, c in bad.items()]
    details = shown[0].unionByName(shown[1]).unionByName(shown[2])
    return failed.join(details, ["scope", "check_name"], "left").select("scope", "check_name", "expected", "actual", F.array_join("details", ",").alias("details"))


@query
def semantic_audit(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    row = e.agg(
        n_where(F.col("user_id").isNull() | F.col("event_type").isNull()).alias("null_keys"), n_where(F.trim("event_type") == "").alias("blank_types"), n_where(~F.col("event_type").isin("view", "click", "purchase", "signup", "error")).alias("unknown_types"),
        n_where(~F.coalesce(F.col("value") >= 0, F.lit(False))).alias("negative_values"), n_where((F.col("event_type") == "error") & (F.col("value") > 5)).alias("error_values"),
    )
    dups = checks.dup_surplus(e, ["event_id"]).select(F.col("surplus").alias("duplicate_ids"))
    long = checks.unpivot(row, [], row.columns, "check_name", "actual").unionByName(checks.unpivot(dups, [], ["duplicate_ids"], "check_name", "actual"))
    return long.withColumn("passed", F.col("actual") == 0)


@query
def payout_meaning(spark, sf):
    # an order is a race, its lines the payouts of seven bet types; planted by the order's number, on its first line: blank and null cells, and placeholders of each kind, right and wrong
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("race_date"), F.lpad((F.col("o_custkey") % 24 + 1).cast("string"), 2, "0").alias("venue_code"), F.col("o_orderkey").alias("race_no"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey"), F.col("l_linenumber").alias("no"), (F.col("l_quantity") * 100).cast("long").alias("yen"))
    rows = li.count()
    o = dealing.dealt(o, ["race_no"], rows)
    d = dealing.dealt(li, ["l_orderkey"], rows).join(o, F.col("l_orderkey") == F.col("race_no")).withColumn("_k", F.when(F.col("no") == 1, F.col("race_no") % 50))
    types = list(racing.PARTS.items())
    kind, combination = F.create_map(*[F.lit(x) for i, (t, _) in enumerate(types, 1) for x in (i, t)])[F.col("no")], F.create_map(*[F.lit(x) for i, (_, n) in enumerate(types, 1) for x in (i, "-".join("123"[:n]))])[F.col("no")]
    k = F.col("_k")
    payouts = d.select(
        "race_date", F.when(k == 2, None).when(k == 4, " ").otherwise(F.col("venue_code")).alias("venue_code"), "race_no", F.when(k == 3, None).otherwise(kind).alias("bet_type"), F.when(k == 1, "\t").when(k.isin(5, 7, 8, 9, 10), None).otherwise(combination).alias("combination"),
        F.when(k.isin(7, 8), 100).when(k == 9, None).when(k == 10, 70).otherwise(F.col("yen")).alias("payout_yen"), F.when(k == 5, "REFUND").when(k.isin(6, 7), "CANCELLED").when(k.isin(8, 10), "SPECIAL_PAYOUT").when(k == 9, "NOT_ESTABLISHED").otherwise("NORMAL").alias("payout_status"),
    )
    return racing.payout_audit(payouts, o.filter("race_no % 50 <> 11"), rows)


@query
def repeated_keys(spark, sf):
    # keys of lines by month of shipment and of events by month: those that repeat within a month, and within the whole period
    li = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), *LINE_KEY)
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM").alias("month"), "user_id", F.when(F.col("event_id") % 50 == 0, None).otherwise(F.col("event_type")).alias("event_type"), F.date_format("ts", "dd HH:mm").alias("minute"))
    found = racing.repeated_keys({"line": (li, LINE_KEY), "event": (e, ["user_id", "event_type", "minute"])})
    return found.select("scope", "check_name", "actual", F.array_join("details", ",").alias("details"))


@query
def top_examples(spark, sf):
    g = checks.key_counts(table(spark, sf, "lineitem"), LINE_KEY, ["l_returnflag"]).filter("n > 1")
    return checks.top_examples(g, ["l_returnflag"], [F.desc("n"), F.col("l_orderkey"), F.col("l_linenumber")], 10)


# --- windows


@query
def lag_interval(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))) / 60_000_000
    g = table(spark, sf, "events").select("user_id", gap.alias("gap"))
    return g.groupBy("user_id").agg(F.count("gap").alias("gaps"), n_where(~F.col("gap").between(5, 90)).alias("outside"))


@query
def order_check(spark, sf):
    # each fall of (user, event) in the whole log in order of time, counted on its day
    e = table(spark, sf, "events").select("ts", "user_id", "event_id")
    day = F.to_date("ts").cast("string").alias("day")
    falls = ordered.order_falls(e, ["ts", "event_id"], ["user_id", "event_id"]).groupBy(day).agg(F.count("*").alias("falls"))
    return e.select(day).distinct().join(falls, "day", "left").select("day", F.coalesce("falls", F.lit(0)).alias("falls"))


@query
def event_chain(spark, sf):
    c = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    last = Window.partitionBy("conv_id")
    d = c.withColumn("_same", F.coalesce(F.col("role") == F.lag("role").over(w), F.lit(False))).withColumn("_rn", F.row_number().over(w)).withColumn("_last", F.max(F.when(F.col("role") == "assistant", F.col("turn"))).over(last))
    return d.groupBy("conv_id").agg(F.min(F.col("turn") == F.col("_rn") - 1).alias("contiguous"), F.max("_same").alias("repeats_role"), F.max(F.coalesce(F.col("turn") > F.col("_last"), F.lit(True))).alias("open_end"), F.count("*").alias("turns"))


@query
def ordered_output(spark, sf):
    n, c = table(spark, sf, "nation").select("n_nationkey", "n_name"), table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_custkey", "c_acctbal").orderBy("n_name", "c_custkey")  # a code list of 25 rows


@query
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).withColumn("kind", F.lit("customer"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).withColumn("kind", F.lit("supplier"))
    return c.unionByName(s, allowMissingColumns=True).groupBy("kind").agg(F.count("*").alias("n"), n_where(F.col("segment").isNull()).alias("null_segments"))


# --- point in time


def _with_as_of(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", pit.as_of_local(F.col("o_orderdate")).alias("as_of"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))


@query
def as_of_time(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", pit.as_of_local(F.col("o_orderdate")).alias("as_of"))


@query
def pit_gate(spark, sf):
    status = pit.eligibility(F.col("l_shipdate"), F.col("as_of"))
    return _with_as_of(spark, sf).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), status.alias("status")).agg(F.count("*").alias("n"))


@query
def pit_audit(spark, sf):
    # the source's time is text; that of every seventh line lacks its offset.  Lines are counted by day, offset and priority first, so that a text is parsed once for each of these
    late = pit.eligibility(F.col("l_shipdate"), F.col("as_of")) == pit.AFTER_AS_OF
    alias = F.greatest("l_shipdate", "o_orderdate") != F.col("l_shipdate")
    nulls = F.col("l_shipdate").isNull() | F.col("as_of").isNull()
    few = _with_as_of(spark, sf).groupBy("l_shipdate", (F.col("l_linenumber") == 7).alias("naive"), "o_orderpriority").agg(
        F.count("*").alias("rows"), n_where(nulls).alias("nulls"), n_where(late).alias("future_rows"), n_where(alias).alias("alias_mismatch"), n_where(~F.col("o_orderstatus").isin("O", "F")).alias("ineligible")
    )
    source = pit.aware(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("naive"), F.lit("")).otherwise(F.lit("Z"))))
    few = few.withColumn("invalid_timestamps", F.when(F.col("l_shipdate").isNotNull() & source.isNull(), F.col("rows")).otherwise(0))
    sums = few.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "nulls", "invalid_timestamps", "future_rows", "alias_mismatch", "ineligible")], F.count_distinct(F.struct("o_orderpriority")).alias("deadlines"))
    sources = table(spark, sf, "lineitem").join(table(spark, sf, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("l_suppkey").distinct().agg(F.count("*").alias("sources"))
    return sums.join(sources)  # single rows


@query
def temporal_order(spark, sf):
    return _with_as_of(spark, sf).groupBy("o_orderstatus").agg(F.count("*").alias("n"), n_where(~F.coalesce(F.col("o_orderdate") <= F.col("l_shipdate"), F.lit(False))).alias("violations"))


@query
def aware_timestamp(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    e = table(spark, sf, "events").select("event_type", pit.aware(F.concat(text, F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("")))).alias("t"), F.col("event_id"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count("t").alias("parsed"), F.max(F.unix_seconds("t")).alias("latest"))


@query
def plan_report(spark, sf):
    now = F.lit("1996-06-30 12:00:00").cast("timestamp_ntz")
    d = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return d.groupBy(F.when(now <= pit.as_of_local(F.col("day")), "START").otherwise("BLOCKED").alias("plan")).agg(F.count("*").alias("days"))


@query
def allowlist_exclusion(spark, sf):
    # suppliers in debt are on the exception list, every fifth of them with another size than its lines have
    files = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("path"), F.lit(1).cast("long").alias("length"), F.lower("l_returnflag").alias("sha256"))
    bad = table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").cast("string").alias("path"), F.when(F.col("s_suppkey") % 5 == 0, 2).otherwise(1).cast("long").alias("length"))
    bad = bad.crossJoin(spark.createDataFrame([("A",), ("n",), ("R",)], "sha256 string"))  # each of three known flags
    return pit.research_only(files, bad).groupBy("use").agg(F.count("*").alias("n"))


@query
def nested_group_rules(spark, sf):
    # an order's deadline evidence as a JSON document of twelve races, half an hour apart from the order's date on, with a fault by the order's number
    k, kind = F.col("o_orderkey"), F.col("o_orderkey") % 12
    at = lambda minutes: F.date_format(F.col("o_orderdate") + F.make_dt_interval(mins=minutes), "yyyy-MM-dd'T'HH:mm:ss")
    no = F.sequence(F.lit(1), F.when(kind == 1, 11).otherwise(12))
    race = lambda i: F.struct(
        i.alias("race_no"), F.when((kind == 3) & (i == 5), "OPEN").otherwise("CLOSE").alias("deadline_kind"),
        F.concat(at(i * 30 + F.when(kind.isin(2, 11) & (i == 7), 100).otherwise(0)), F.when((kind == 4) & (i == 3), "").otherwise("Z")).alias("scheduled_deadline_at"),
    )
    fields = {
        "contract_version": F.lit("v1"), "source_name": F.when(kind == 10, " ").otherwise("orders"), "source_authority": F.lit("a"), "source_locator": F.lit("l"), "source_timezone": F.lit("UTC"), "request_started_at": F.concat(at(F.when(kind == 5, 21).otherwise(10)), F.lit("Z")),
        "fetched_at": F.concat(at(F.when(kind == 6, 45).otherwise(20)), F.lit("Z")), "http_status": F.when(kind.isin(7, 11), 404).otherwise(200), "response_headers": F.create_map(F.lit("a"), F.lit("b")), "raw_source_sha256": F.when(kind == 8, "none").otherwise(lineage.digest(k.cast("string"))),
        "race_date": F.date_format("o_orderdate", "yyyy-MM-dd"), "venue_code": k.cast("string"), "race_deadlines": F.transform(no, race),
    }
    text = F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))
    text = F.when(kind == 9, F.regexp_replace(text, r"\}$", ',"more":1}')).otherwise(text)
    # documents are long to read, so the orders are dealt out to all tasks first, however few parts the table is stored in
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    rows = o.count()
    tasks = dealing.more_tasks(spark, rows) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    documents = o.repartition(tasks, "o_orderkey").select(text.alias("document"), F.when(kind == 8, "none").otherwise(lineage.digest(k.cast("string"))).alias("sha256"))
    return binding.deadline_rules(binding.read_deadlines(documents), rows).groupBy("failures", "status").agg(F.count("*").alias("n"))


@query
def field_agreement(spark, sf):
    # what lines say of their order, and a later record of it: lines lost and dates put back in planted places, statuses as the orders have them
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_linestatus")
    say = lambda d: d.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("l_shipdate").alias("last"), F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.min("l_linestatus")).otherwise("P").alias("st"))
    k = F.col("l_orderkey")
    later = say(li.filter(~((k % 20 == 1) & (F.col("l_linenumber") == 1)))).withColumn("last", F.when(k % 20 == 2, F.date_sub("last", 1).cast("timestamp_ntz")).when(k % 20 == 3, None).otherwise(F.col("last"))).drop("st")
    later = later.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("st")), "l_orderkey")
    return reconcile.agreement(say(li), later, ["l_orderkey"], ["n", "last", "st"])


@query
def decision_rules(spark, sf):
    # an order's decision: finished ones are eligible, but for a planted fault in every hundredth, and a record that keeps an older reason
    key, done = F.col("o_orderkey"), F.col("o_orderstatus") == "F"
    status = F.when(done, pit.ELIGIBLE).otherwise(F.when(F.col("o_orderstatus") == "O", "SKIPPED_METADATA_INVALID").otherwise("PENDING"))
    d = table(spark, sf, "orders").select(
        status.alias("status"), (done != (key % 100 == 0)).alias("eligible"), F.when(key % 50 == 1, " ").otherwise(F.col("o_orderpriority")).alias("reason"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("race_date"), pit.as_of_local(F.col("o_orderdate")).alias("as_of_time"), "o_orderpriority", key.alias("_k")
    )
    record = F.struct("status", "eligible", F.when(F.col("_k") % 25 == 2, F.lit("old")).otherwise(F.col("reason")).alias("reason"), "as_of_time")
    return checks.violations(d.withColumn("record", record), pit.decision_rules())


@query
def failure_taxonomy(spark, sf):
    texts = {"view": "sha256 mismatch of a file", "click": "Program NOT found", "purchase": "an odds feature", "signup": "naive datetime"}
    e = table(spark, sf, "events").select(X.code_of(F.col("event_type"), texts).alias("message"), F.when(F.col("event_id") % 10 == 0, "io.FileNotFoundError").otherwise("ValueError").alias("kind"), F.when(F.col("event_id") % 7 == 0, "SKIPPED_PROVENANCE_MISSING").alias("own"))
    return e.groupBy(pit.failure_status(F.col("kind"), F.col("message"), F.col("own")).alias("status")).agg(F.count("*").alias("n"))


DOCUMENT_RULES = (("password|secret|akia", "SECRET"), ("@", "CONTACT"), ("license|copyright", "LICENSE"), ("\\|", "TABLE"), ("[0-9]{3}", "NUMBERS"))


@query
def message_taxonomy(spark, sf):
    return table(spark, sf, "documents").groupBy(pit.classify(F.col("text"), DOCUMENT_RULES, "OTHER").alias("class")).agg(F.count("*").alias("n"))


# --- lineage


@query
def content_digest(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", lineage.digest(F.col("text")).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))
    # most texts occur once: only the digests that repeat are joined, so the right side is small
    twice = d.groupBy("sha256").agg(F.count("*").alias("copies")).filter("copies > 1")
    return d.join(twice, "sha256", "left").select("doc_id", "sha256", "bytes", F.coalesce("copies", F.lit(1)).alias("copies"))


@query
def content_audit(spark, sf):
    # recorded sizes and digests of texts as files, with planted differences
    d = table(spark, sf, "documents").filter("text is not null").select(F.col("doc_id").alias("file"), F.encode("text", "UTF-8").alias("content"), F.octet_length("text").cast("long").alias("length"), lineage.digest(F.col("text")).alias("sha256"))
    k = F.col("file")
    recorded = d.select("file", (F.col("length") + F.when(k % 10 == 0, 1).otherwise(0)).alias("length"), F.when(k % 15 == 0, "0").otherwise(F.col("sha256")).alias("sha256"))
    found = text_files.audit_content(d.filter(k % 35 != 0), recorded, magic="e")
    return found.groupBy(F.array_join("differences", ",").alias("differences")).agg(F.count("*").alias("n"))


@query
def artifact_records(spark, sf):
    # an order's lines are the artifacts it records: exactly line numbers 1 to 3, sizes and digests as in the listing, which differs in planted places
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").dropDuplicates(["l_orderkey", "l_linenumber"])
    path = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    k = F.col("l_orderkey")
    records = li.select("l_orderkey", F.col("l_linenumber").cast("string").alias("name"), F.when(k % 40 == 5, " ").otherwise(path).alias("path"), k.alias("size"), F.lit("AB").alias("sha256"))
    listing = li.filter(k % 40 != 6).select(path.alias("path"), F.when(k % 40 == 7, -1).otherwise(k).alias("length"), F.when(k % 40 == 8, "cd").otherwise("ab").alias("sha256"))
    return lineage.artifact_records(records, listing, ["l_orderkey"], ["1", "2", "3"]).groupBy("failures").agg(F.count("*").alias("n"))


@query
def canonical_digest(spark, sf):
    # stored documents; every seventh is not in canonical form
    names = ["p_partkey", "p_name", "p_size"]
    text = lineage.canonical_json(names)
    d = table(spark, sf, "part").select(*names).withColumn("stored", F.when(F.col("p_partkey") % 7 == 0, F.regexp_replace(text, '","p_', '", "p_')).when(F.col("p_partkey") % 7 == 1, F.regexp_replace(text, "\n", "")).otherwise(text))
    same = lineage.is_canonical(F.col("stored"), names, "p_partkey long, p_name string, p_size int")
    return d.select("p_partkey", "stored", lineage.digest(F.col("stored")).alias("sha256"), same.alias("is_canonical"))


def _line_text():
    return F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_quantity").cast("long").cast("string"))


@query
def group_digest(spark, sf):
    li = table(spark, sf, "lineitem")
    return lineage.group_digest(li, ["l_orderkey"], _line_text(), rows=li.count())


@query
def digest_binding(spark, sf):
    # what customers recorded of their orders' digests, altered for every tenth customer and lost for every eleventh
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rows = li.count()
    o_rows = o.count()
    orders = lineage.group_digest(li, ["l_orderkey"], _line_text(), rows=rows).withColumnRenamed("l_orderkey", "o_orderkey")
    o = dealing.dealt(o, ["o_orderkey"], rows).join(orders, "o_orderkey")
    actual = lineage.bucketed_digest(o, ["o_custkey"], F.col("digest"), rows=o_rows)
    # what is lost is told by the digest: a filter of customers would be made before the digests, which both sides could not share then
    said = F.when(F.col("o_custkey") % 11 == 0, "").when(F.col("o_custkey") % 10 == 0, F.reverse("digest")).otherwise(F.col("digest"))
    recorded = actual.withColumn("digest", said).filter(F.length("digest") > 0)
    return lineage.binding_report(recorded, actual, ["o_custkey"], "digest")


@query
def manifest_chain(spark, sf):
    # order documents refer to their customer's, customers to their nation's; planted: other digests, lost parents, an old version
    sha = lambda *parts: lineage.digest(F.concat_ws("|", *parts))
    text = lambda c: F.col(c).cast("string")
    n = table(spark, sf, "nation").select(F.concat(F.lit("n"), text("n_nationkey")).alias("artifact_id"), F.lit("nation").alias("kind"), F.lit("v1").alias("contract_version"), sha("n_name").alias("sha256"), F.lit("d").alias("day"))
    c = table(spark, sf, "customer")
    customers = c.select(F.concat(F.lit("c"), text("c_custkey")).alias("artifact_id"), F.lit("customer").alias("kind"), F.when(F.col("c_custkey") % 50 == 3, "v0").otherwise("v1").alias("contract_version"), sha("c_name").alias("sha256"), F.when(F.col("c_custkey") % 50 == 4, "e").otherwise("d").alias("day"))
    o = table(spark, sf, "orders")
    orders = o.select(F.concat(F.lit("o"), text("o_orderkey")).alias("artifact_id"), F.lit("order").alias("kind"), F.lit("v1").alias("contract_version"), sha(text("o_orderkey")).alias("sha256"), F.lit("d").alias("day"))
    up = c.join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    up = up.select(F.concat(F.lit("c"), text("c_custkey")).alias("artifact_id"), F.lit("nation").alias("parent_kind"), F.concat(F.lit("n"), text("n_nationkey")).alias("parent_id"), sha("n_name").alias("recorded_sha256"))
    mine = o.join(c, F.col("o_custkey") == F.col("c_custkey")).filter("o_orderkey % 100 <> 9")
    mine = mine.select(F.concat(F.lit("o"), text("o_orderkey")).alias("artifact_id"), F.lit("customer").alias("parent_kind"), F.concat(F.lit("c"), F.when(F.col("o_orderkey") % 100 == 10, "-1").otherwise(text("c_custkey"))).alias("parent_id"), F.when(F.col("o_custkey") % 20 == 1, "0").otherwise(sha("c_name")).alias("recorded_sha256"))
    chain = lineage.manifest_chain(n.unionByName(customers).unionByName(orders), up.unionByName(mine), {"nation": [], "customer": ["nation"], "order": ["customer"]}, {"nation": "v1", "customer": "v1", "order": "v1"}, ["day"])
    return chain.groupBy("kind", "failures").agg(F.count("*").alias("n"))


@query
def collection_digests(spark, sf):
    # an order's lines are the children of a collection, in order of their numbers; planted: digests that are none, sizes of nothing, a place left out; and the run that would make it
    k, no = F.col("l_orderkey"), F.col("l_linenumber")
    li = table(spark, sf, "lineitem").filter(~((k % 30 == 3) & (no == 1)))
    child = F.when((k % 30 == 4) & (no == 1), "none").otherwise(lineage.digest(_line_text()))
    entries = li.select("l_orderkey", no.alias("at"), child.alias("child"), F.when((k % 30 == 5) & (no == 1), 0).otherwise(F.col("l_quantity").cast("long")).alias("size"))
    found = lineage.collection_digest(entries, ["l_orderkey"], "at", "child", "size", rows=table(spark, sf, "lineitem").count())
    return found.withColumn("key", F.col("l_orderkey").cast("string")).withColumn("run_id", lineage.run_id("key", "collection_sha256")).drop("key")


@query
def model_events(spark, sf):
    # a user's events are the log of one model for each type; planted: broken chains, numbers left out, times that fall, events after an end
    u, e = F.col("user_id"), F.col("event_id")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    d = table(spark, sf, "events").withColumn("rn", F.row_number().over(w)).withColumn("before", F.lag("event_id").over(w)).withColumn("at", F.unix_seconds(F.col("ts").cast("timestamp")))
    log = d.select(
        u.alias("log_id"), (F.col("rn") + F.when((u % 8 == 1) & (F.col("rn") > 1), 1).otherwise(0)).alias("sequence"), F.when((F.col("event_type") == "error") & (u % 8 == 2), "REVOKE").otherwise("ACTIVATE").alias("kind"), F.col("event_type").alias("model_id"),
        e.cast("string").alias("event_sha256"), F.when((u % 8 == 3) & (F.col("rn") == 3), "?").otherwise(F.col("before").cast("string")).alias("previous_event_sha256"), (F.col("at") + F.when((u % 8 == 4) & (F.col("rn") == 2), 1).otherwise(0)).alias("authorized_at"),
        F.col("at").alias("published_at"), (F.col("at") - F.when((u % 8 == 5) & (F.col("rn") == 2), 1).otherwise(0)).alias("effective_at"),
    )
    return binding.audit_model_events(log).withColumnRenamed("log_id", "user_id")


@query
def publish_status(spark, sf):
    c = table(spark, sf, "orders").select("o_orderkey", lineage.digest(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")).alias("d"))
    altered = F.when(F.col("o_orderkey") % 10 == 0, F.concat("d", F.lit("x"))).otherwise(F.col("d"))
    old = c.filter("o_orderkey % 2 = 0").select("o_orderkey", altered.alias("d"))
    return lineage.publish_status(c, old, ["o_orderkey"], "d").groupBy("publish").agg(F.count("*").alias("n"))


@query
def package_audit(spark, sf):
    # a user's event types are the files of a package, their least event ids the digests; planted: other bindings, states and approvals
    e = table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("name")).agg(F.min("event_id").cast("string").alias("sha256"))
    u = F.col("user_id")
    bound = e.filter("name in ('view', 'click')").select("user_id", "name", F.when(u % 10 == 1, "0").otherwise(F.col("sha256")).alias("recorded_sha256"))
    users = table(spark, sf, "events").select("user_id").distinct()
    state = users.filter(u % 10 != 4).select("user_id", F.when(u % 10 == 2, "REJECTED").otherwise("APPROVED").alias("decision"), F.when(u % 10 == 3, "REVOKED").otherwise("ACTIVE").alias("authority_status"))
    return lineage.package_audit(e, bound, state, ["user_id"], ["click", "error", "purchase", "signup", "view"]).select("user_id", "failures", "status")


# --- features and scores


@query
def feature_build(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    ok = checks.between("l_quantity", 1, 50) & checks.integral("l_quantity") & checks.between("l_discount", 0, 0.1) & checks.between("l_tax", 0, 0.08)
    good = li.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_distinct("l_linenumber").alias("kinds"), F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"), F.min(ok).alias("ok"))
    good = good.filter("ok and n = kinds and low = 1 and high = n").select("l_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey")
    return li.join(good, "l_orderkey", "left_semi").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")


@query
def feature_audit(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = table(spark, sf, "lineitem")
    d = checks.key_counts(li, LINE_KEY).agg(n_where(F.col("n") > 1).alias("dup_keys"))
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    a = li.agg(F.count("*").alias("rows"), (F.count("*") % 6).alias("rows_beyond_sixes"), *[n_where(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols], n_where(bad("l_quantity") | bad("l_extendedprice") | bad("l_discount") | bad("l_tax")).alias("non_finite"))
    return a.join(F.broadcast(d))


FLAGS, STATES = ["__UNKNOWN__", "N", "R"], ["__UNKNOWN__", "F", "O"]


@query
def matrix_meaning(spark, sf):
    # lines as entries of their order, in the order in which they are stored; planted: null cells and numbers that are not finite
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("race_date"), F.lpad((F.col("o_custkey") % 24 + 1).cast("string"), 2, "0").alias("venue_code"))
    k = F.col("l_orderkey")
    values = {"age": F.col("l_quantity"), "weight_kg": F.when(k % 60 == 1, float("inf")).otherwise(F.col("l_discount")), "national_win_rate": F.when(k % 60 == 2, float("nan")).otherwise(F.col("l_tax"))}
    li = table(spark, sf, "lineitem")
    rows = li.count()
    d = dealing.dealt(li, ["l_orderkey"], rows).join(dealing.dealt(o, ["o_orderkey"], rows), k == F.col("o_orderkey"))
    d = d.select(
        "race_date", "venue_code", k.alias("race_no"), F.col("l_linenumber").alias("boat_no"), *[values.get(c, F.col("l_quantity")).alias(c) for c in racing.FEATURES], F.when(k % 60 == 3, None).otherwise(F.col("l_returnflag")).alias("branch"), F.col("l_linestatus").alias("class"),
        F.col("l_suppkey").cast("string").alias("racer_id"), F.lit("n").alias("racer_name"), F.col("l_partkey").alias("motor_no"), F.col("l_partkey").alias("boat_no_equipment"), F.lit("f").alias("source_file"), "l_partkey", "l_suppkey", "l_extendedprice",
    )
    return racing.matrix_audit(d, ["race_no", "boat_no", "l_partkey", "l_suppkey", "l_extendedprice"], rows)


@query
def snapshot_meaning(spark, sf):
    # an order is an entry of its day's snapshot; planted by its number: a null cell, a time without offset, a source from after the cut-off, source times apart, another status, other digests
    k, as_of = F.col("o_orderkey") % 200, pit.as_of_instant(F.col("race_date"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    early = as_of - F.make_dt_interval(hours=F.lit(1))
    source = F.when(k == 3, as_of + F.make_dt_interval(secs=F.lit(1))).otherwise(early)
    cells = {c: F.lit("x") for c in racing.PROVENANCE} | {
        "as_of_time": as_of, "snapshot_at": F.when(k == 1, None).otherwise(early), "feature_source_max_time": F.concat(text(source), F.when(k == 2, "").otherwise("Z")), "source_max_time": F.concat(text(F.when(k == 4, as_of).otherwise(source)), F.lit("Z")),
        "provenance_status": F.when(k == 5, pit.AFTER_AS_OF).otherwise(pit.ELIGIBLE), "feature_source_sha256": F.when(k == 6, "other").otherwise("one"), "deadline_evidence_sha256": F.when(k == 7, None).otherwise("one"),
    }
    d = table(spark, sf, "orders").withColumn("race_date", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return racing.snapshot_audit(d.select("race_date", *[c.alias(name) for name, c in cells.items()]))


@query
def one_hot(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(scoring.vocabulary_index(F.col("l_returnflag"), FLAGS).alias("flag_index"), scoring.vocabulary_index(F.col("l_linestatus"), STATES).alias("state_index")).agg(F.count("*").alias("n"))


@query
def logit_score(spark, sf):
    f = scoring.vocabulary_index(F.col("l_returnflag"), FLAGS)
    terms = [(0.05, F.col("l_quantity")), (-12.0, F.col("l_discount")), (20.0, F.col("l_tax")), (0.75, f.cast("double"))]
    p = scoring.probability(scoring.linear(-1.5, terms))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(p, 9).alias("p"))


@query
def model_scores(spark, sf):
    # each brand of parts has a model, made from what its parts are; planted: endless, lost and repeated coefficients, other feature orders, and brands without one
    p = table(spark, sf, "part")
    g = p.groupBy(F.col("p_brand").alias("model_id")).agg(F.count("*").alias("n"), F.sum("p_size").alias("size"), F.min("p_partkey").alias("k"))
    names, k = F.array(F.lit("l_quantity"), F.lit("l_discount"), F.lit("l_tax")), F.col("k") % 9
    weights = F.array((F.col("size") % 13 - 6) / 64.0, F.when(k == 1, float("inf")).otherwise((F.col("n") % 11 - 5) / 4.0), (F.col("size") % 7) / 2.0)
    words = F.create_map(F.lit("l_returnflag"), F.when(k == 4, F.array(F.lit("?"), F.lit("N"), F.lit("N"))).otherwise(F.array(F.lit("?"), F.lit("N"), F.lit("R"))))
    models = g.filter(k != 5).select(
        "model_id", names.alias("feature_names"), F.when(k == 2, F.slice(weights, 1, 2)).otherwise(weights).alias("coefficients"), F.array(F.lit(0), F.lit(1)).alias("classes"), F.lit(1).alias("positive_class"), ((F.col("n") % 5 - 2) / 2.0).alias("intercept"),
        F.when(k == 3, F.reverse(names)).otherwise(names).alias("contract_features"), words.alias("vocabularies"), F.create_map(F.lit("l_returnflag"), F.array(F.lit(0.0), F.lit(0.5), F.lit(-0.25))).alias("vocabulary_coefficients"),
    )
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag").join(p.select("p_partkey", F.col("p_brand").alias("model_id")), F.col("l_partkey") == F.col("p_partkey"))
    d = scoring.score_by_models(li, models, ["l_returnflag"])
    return d.groupBy("model_id", "refused").agg(F.count("*").alias("n"), F.count("probability").alias("scored"), F.sum(F.round("probability", 6).cast("decimal(18,6)")).cast("double").alias("expected"))


@query
def model_rules(spark, sf):
    # an order is a model: its parts are the features, their discounts the coefficients, its flags the classes; planted: lost, infinite and reordered ones
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_discount"))).alias("x"), F.array_sort(F.collect_set("l_returnflag")).alias("classes"))
    k = F.col("l_orderkey")
    values = F.transform("x", lambda v: F.when(k % 30 == 1, F.lit(float("inf"))).otherwise(v["l_discount"]))
    names = F.transform("x", lambda v: v["l_partkey"].cast("string"))
    m = li.select(k.alias("model_id"), names.alias("feature_names"), F.when(k % 30 == 2, F.slice(values, 1, F.size("x") - 1)).otherwise(values).alias("coefficients"), "classes", F.lit("R").alias("positive_class"), F.lit(0.0).alias("intercept"), F.when((k % 30 == 3) & (F.size("x") > 1), F.reverse(names)).otherwise(names).alias("contract_features"))
    return scoring.model_report(m).groupBy("failures").agg(F.count("*").alias("n"))
