"""Data-quality checks: each takes a frame with key lists or rule tables and returns a frame, in one pass where the grain allows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_keys import forbidden_keys_of

# Names of columns and keys that are known only after a race, by what they must stay out of.
RESULT_COLUMNS = (
    "actual", "arrival", "collector_result", "finish", "finish_position", "finish_raw", "kimarite", "label", "labels", "odds", "payoff", "payout", "payout_status", "payout_yen", "payouts",
    "pipeline_result", "refund", "result", "result_available", "results", "target", "winner", "winning", "着順", "払戻", "結果", "決まり手",
)
SNAPSHOT_PROHIBITED = ("finish_position", "finish_raw", "race_time_raw", "result_available", "race_cancelled", "payout_yen", "payout_status", "popularity", "bet_type", "combination")
LABEL_PROHIBITED = ("as_of_time", "snapshot_at", "feature_source_fetched_at", "feature_source_max_time", "feature_source_sha256", "feature_source_url", "feature_collector_version", "feature_contract_version", "provenance_status")
FORBIDDEN_KEYS = (
    "actual", "arrival", "bet_type", "combination", "ev", "exhibition", "finish", "finish_position", "finish_raw", "kimarite", "label", "labels", "odds", "payoff", "payout", "payout_status", "payout_yen",
    "payouts", "prediction", "predictions", "probability", "probabilities", "race_cancelled", "race_time_raw", "recommendation", "recommendations", "refund", "result", "result_available", "results",
    "target", "winner", "winning", "raw_html", "raw_source_bytes", "canonical_bytes", "canonical_deadline_evidence_bytes", "deadline_evidence", "eligibility_cutoff_at", "safety_margin_seconds",
    "着順", "払戻", "結果", "決まり手",
)
# End of the fixed values.


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true, as a sum that partial aggregation combines."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def key_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """n rows of each key; null keys form groups of their own."""
    return df.groupBy(*by, *[k for k in keys if k not in by]).agg(F.count("*").alias("n"))


def dup_surplus(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each key: the sum of n - 1."""
    return key_counts(df, keys, by).groupBy(*by).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("surplus"))


def dup_groups(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All rows of the keys that occur more than once, and the number of such keys."""
    n = F.col("n")
    return key_counts(df, keys, by).groupBy(*by).agg(F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).cast("long").alias("dup_rows"), count_where(n > 1).alias("dup_groups"))


def group_size(df: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    """Keys whose number of rows is another than expected."""
    return key_counts(df, keys).filter(F.col("n") != expected)


def group_member_set(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """For each key whether its members are exactly 1..n, n its rows; minimum, maximum and distinct count decide, so no set is collected."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(member).alias("low"), F.max(member).alias("high"), F.count_distinct(member).alias("kinds"))
    return g.select(*keys, "n", ((F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("kinds") == F.col("n"))).alias("complete"))


def group_homogeneity(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """For each key whether it holds one value only; null counts as a value."""
    return df.groupBy(*keys).agg((F.count_distinct(F.struct(value)) == 1).alias("homogeneous"))


def value_counts(df: DataFrame, column: str, null_label: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(null_label)).alias("value")).agg(F.count("*").alias("n"))


def unpivot(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in measures], name, value)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls, blanks): one aggregate over the frame, turned long."""
    counts = [x for c in columns for x in (count_where(F.col(c).isNull()).alias(f"{c}.n"), count_where(F.trim(F.col(c).cast("string")) == "").alias(f"{c}.b"))]
    row = df.agg(*counts)
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}.n`").alias("nulls"), F.col(f"`{c}.b`").alias("blanks")) for c in columns])))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) for conditions that rows must meet; an unknown (null) outcome violates."""
    row = df.agg(*[count_where(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return unpivot(row, [], list(rules), "rule", "violations")


def between(column: str, low: float, high: float) -> Column:
    """In range, neither NaN nor infinite."""
    c = F.col(column).cast("double")
    return ~F.isnan(c) & c.between(low, high)


def integral(column: str) -> Column:
    c = F.col(column).cast("double")
    return ~F.isnan(c) & (c == F.floor(c))


def contract_report(df: DataFrame, contract: T.StructType, prohibited: Sequence[str] = ()) -> DataFrame:
    """(column_name, problem, nulls): what in df departs from an exact schema: missing, extra, order, type, nullable (a contract column that may not be null can be), prohibited, and nulls, the null cells of columns that may hold none. No rows if all is well. The last is one pass, the others need no scan."""
    have, want = {f.name: f for f in df.schema}, {f.name: f for f in contract}
    found = [(c, "missing") for c in want if c not in have] + [(c, "extra") for c in have if c not in want]
    both = [c for c in want if c in have]
    present = [c for c in df.columns if c in want]
    found += [(c, "order") for c, d in zip(both, present, strict=True) if c != d]
    found += [(c, "type") for c in both if have[c].dataType != want[c].dataType]
    found += [(c, "nullable") for c in both if have[c].nullable and not want[c].nullable]
    found += [(c, "prohibited") for c in have if c.strip().casefold() in prohibited]
    static = df.sparkSession.createDataFrame([(c, w, 0) for c, w in found], "column_name string, problem string, nulls long")
    strict = [c for c in both if not want[c].nullable]
    if not strict:
        return static
    row = df.agg(*[count_where(F.col(f"`{c}`").isNull()).alias(c) for c in strict])
    return static.unionByName(unpivot(row, [], strict, "column_name", "nulls").filter("nulls > 0").select("column_name", F.lit("nulls").alias("problem"), "nulls"))


def forbidden_keys(df: DataFrame, ids: Sequence[str], document: str, forbidden: Sequence[str] = FORBIDDEN_KEYS) -> DataFrame:
    """(ids, path, key): keys of JSON documents that are forbidden (trimmed, in lower case), at whatever depth, with the path of what holds them; one that is no JSON is reported at the path '$' with a null key. Each document is read once."""
    return df.select(*ids, F.inline(forbidden_keys_of(F.col(document), forbidden)))


def contract_projection(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Exactly the contract's columns in its order; contract maps each source column to its new name."""
    return df.select(*[F.col(c).alias(n) for c, n in contract.items()])


def top_examples(df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows of each group, with their number."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= limit)


def failed_long(df: DataFrame, scope: str, measures: Sequence[str]) -> DataFrame:
    """(scope, check_name, expected, actual) for every measure that is not zero."""
    long = unpivot(df, [scope], measures, "check_name", "actual")
    return long.filter("actual <> 0").select(F.col(scope).cast("string").alias("scope"), "check_name", F.lit(0).cast("long").alias("expected"), F.col("actual").cast("long").alias("actual"))


def examples(df: DataFrame, scope: Sequence[str], check: str, example: Column, limit: int = 10) -> DataFrame:
    """(scope, check_name, details): the first examples in order, at most limit for each scope; two steps, so that no task sorts more than a task's share and then limit rows of each."""
    d = df.select(*scope, example.cast("string").alias("_e"), F.pmod(F.xxhash64(example), F.lit(64)).alias("_part"))
    first = lambda cols: F.row_number().over(Window.partitionBy(*cols).orderBy("_e")) <= limit
    d = d.withColumn("_keep", first([*scope, "_part"])).filter("_keep").withColumn("_keep", first(scope)).filter("_keep")
    return d.groupBy(*scope).agg(F.array_sort(F.collect_list("_e")).alias("details")).withColumn("check_name", F.lit(check))


def code_counts(df: DataFrame, by: Sequence[str], column: str, null_label: str, name: str) -> DataFrame:
    """by and `name`: a map of the column's values (codes of a short list) to their rows; null has a label."""
    g = df.groupBy(*by, F.coalesce(F.col(column).cast("string"), F.lit(null_label)).alias("_value")).agg(F.count("*").alias("_n"))
    return g.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_value", "_n")))).alias(name))


def gate(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """df with the names of the measures that are not zero, in order, and a status."""
    failures = F.filter(F.array(*[F.when(F.coalesce(F.col(m), F.lit(1)) != 0, F.lit(m)) for m in measures]), lambda x: x.isNotNull())
    return df.withColumn("failures", F.array_join(failures, ",")).withColumn("status", F.when(F.col("failures") == "", F.lit("SUCCESS")).otherwise(F.lit("FAILED")))


def assert_gate(report: DataFrame) -> None:
    """Raise with the failing rows of a gated report (a few scalars for each unit)."""
    bad = report.filter("status <> 'SUCCESS'").limit(10).collect()
    if bad:
        raise ValueError(f"quality gate failed: {[r.asDict() for r in bad]}")
