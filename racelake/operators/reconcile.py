"""Joins that explain what does not match."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """A one-to-one full outer join with `side` (both, left_only, right_only). Keys come from either side; null keys match each other if null_safe. Check key uniqueness first: duplicates multiply."""
    l, r = left.withColumn("_in_left", F.lit(True)), right.withColumn("_in_right", F.lit(True))
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    same = [l[k].eqNullSafe(r[f"_r_{k}"]) if null_safe else l[k] == r[f"_r_{k}"] for k in keys]
    j = l.join(r, reduce(lambda a, b: a & b, same), "full")
    side = F.when(F.col("_in_left") & F.col("_in_right"), "both").when(F.col("_in_left"), "left_only").otherwise("right_only")
    j = j.withColumn("side", side)
    for k in keys:
        j = j.withColumn(k, F.coalesce(k, f"_r_{k}"))
    return j.drop("_in_left", "_in_right", *[f"_r_{k}" for k in keys])


def group_absence(df: DataFrame, group: Sequence[str], absent: Column) -> DataFrame:
    """df with `absence` of its group: none, some or all rows absent. The groups are counted by partial aggregation and joined back, so that a group of very many rows is gathered nowhere; null keys are a group."""
    counts = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in group]).agg(F.count("*").alias("_n"), F.sum(F.when(absent, 1).otherwise(0)).alias("_gone"))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(counts[f"_g_{k}"]) for k in group])
    out = df.join(counts, same).withColumn("absence", F.when(F.col("_gone") == 0, "none").when(F.col("_gone") == F.col("_n"), "all").otherwise("some"))
    return out.select(*df.columns, "absence")


def conditional_anti(df: DataFrame, drop: Column, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df without the rows that meet `drop` and have no partner in other; all other rows stay."""
    known = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct().withColumn("_known", F.lit(True))
    j = df.join(known, reduce(lambda a, b: a & b, [df[k] == known[f"_k_{k}"] for k in keys]), "left")
    return j.filter(~F.coalesce(drop, F.lit(False)) | F.col("_known")).select(df.columns)


def key_set_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys of the left only, of the right only, and both together."""
    a, b = left.select(key).dropna().distinct(), right.select(key).dropna().distinct()
    j = full_outer(a, b, [key], null_safe=False)
    lone = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, 1).otherwise(0)), F.lit(0)).cast("long")
    return j.agg(lone("left_only").alias("left_only"), lone("right_only").alias("right_only"), (lone("left_only") + lone("right_only")).alias("symmetric"))


def name_match(df: DataFrame, a: str, b: str) -> Column:
    """exact, prefix (either way), subsequence (shorter in longer), or unexplained."""
    x, y = F.col(a), F.col(b)
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    chars = F.filter(F.split(short, ""), lambda c: c != "")
    found = F.aggregate(chars, F.lit(1), lambda at, c: F.when((at > 0) & (F.call_function("locate", c, long, at) > 0), F.call_function("locate", c, long, at) + 1).otherwise(F.lit(0)))
    return F.when(x == y, "exact").when(x.startswith(y) | y.startswith(x), "prefix").when(found > 0, "subsequence").otherwise("unexplained")


def agreement(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row for two records of the same units: units on both sides, those of one side only, and for each field the units whose values differ (null is a value)."""
    a, b = (d.select(*keys, *[F.col(c).alias(f"_{x}_{c}") for c in fields]) for x, d in (("left", left), ("right", right)))
    j = full_outer(a, b, keys)
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    both = F.col("side") == "both"
    return j.agg(n(both).alias("units"), n(~both).alias("one_sided"), *[n(both & ~F.col(f"_left_{c}").eqNullSafe(F.col(f"_right_{c}"))).alias(f"{c}_differs") for c in fields])


def grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """All combinations of two lists of keys; the right one is a code list (some tens of rows) and is broadcast."""
    return left.crossJoin(F.broadcast(right))


def coverage(expected: DataFrame, actual: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per group: expected, present, missing and unexpected keys."""
    j = full_outer(expected.select(*keys).distinct(), actual.select(*keys).distinct(), keys)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    side = F.col("side")
    return j.groupBy(*by).agg(n(side != "right_only").alias("expected"), n(side == "both").alias("present"), n(side == "left_only").alias("missing"), n(side == "right_only").alias("unexpected"))


def inventory(expected: DataFrame, actual: DataFrame, keys: Sequence[str], by: Sequence[str], place: Column) -> DataFrame:
    """coverage() with the missing and unexpected keys as lists, in the order of `place`, for code lists of some tens of entries a group."""
    j = full_outer(expected.select(*keys).distinct(), actual.select(*keys).distinct(), keys)
    n = lambda s: F.sum(F.when(F.col("side") == s, 1).otherwise(0)).cast("long")
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys if k not in by])
    listed = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct(place.alias("at"), name.alias("key"))))), lambda x: x["key"])
    return j.groupBy(*by).agg(n("both").alias("present"), listed("left_only").alias("missing"), listed("right_only").alias("unexpected"))
