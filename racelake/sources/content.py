"""Read-back by content: digests of tables that combine over tasks and do not depend on the order of rows.

The digest of a column is the sum, over all rows, of a hash of the row's key, the column's name and the cell, so that a changed cell, two
cells that changed places, and a lost, added or repeated row each change it; that of the whole row (ROW) finds cells that changed
places between rows of one key.  Sums are taken in halves of 32 bits, for parts of each group, so they hold for any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reconcile import full_outer
from .text_files import write_days

#: What is named beside columns: the number of rows, and rows whose cells changed places within a key.
ROWS, ROW = "<rows>", "<row>"
#: Parts of a group whose sums are added up as decimals: 2^31 rows each stay below the largest long.
_PARTS = 64


def _cell(df: DataFrame, column: str) -> list[Column]:
    """A cell as what is hashed: whether it is null (hashes skip nulls), and its value; maps and variants, which have no hash, as JSON."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    return [c.isNull(), F.to_json(c) if isinstance(kind, (T.MapType, T.VariantType)) else c]


def column_digests(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(*by, rows, digests): the number of rows and a map from each column, and ROW, to its digest. keys name a row; columns that are maps, or hold some, are read as JSON."""
    key = [x for k in keys for x in _cell(df, k)]
    hashes = {c: F.xxhash64(F.lit(c), *key, *_cell(df, c)) for c in df.columns} | {ROW: F.xxhash64(F.lit(ROW), *[x for c in df.columns for x in _cell(df, c)])}
    part = F.pmod(F.xxhash64(F.lit("part"), *key), F.lit(_PARTS))
    halves = [(f"_{i}{side}", F.shiftrightunsigned(h, 32) if side == "h" else h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))) for i, h in enumerate(hashes.values()) for side in "hl"]
    some = df.select(*by, part.alias("_part"), *[h.alias(n) for n, h in halves]).groupBy(*by, "_part").agg(F.count("*").alias("_rows"), *[F.sum(n).alias(n) for n, _ in halves])
    every = some.groupBy(*by).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), *[F.sum(F.col(n).cast("decimal(19,0)")).alias(n) for n, _ in halves])
    digests = F.create_map(*[x for i, c in enumerate(hashes) for x in (F.lit(c), F.concat_ws(":", *[F.col(f"_{i}{side}").cast("string") for side in "hl"]))])
    return every.select(*by, "rows", digests.alias("digests"))


def content_report(written: DataFrame, found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, rows_written, rows_found, differs, status) of two frames of column_digests(): the columns whose cells differ, in name order, ROWS where the numbers of rows do, ROW where no column but the pairing of cells does. A column or group of one side only differs."""
    name = lambda df, x: df.select(*by, F.col("rows").alias(f"rows_{x}"), F.col("digests").alias(f"_{x}"))
    a, b = name(written, "written"), name(found, "found")
    j = full_outer(a, b, by) if by else a.join(b)  # single rows
    none = F.create_map().cast("map<string,string>")
    mine, theirs = F.coalesce("_written", none), F.coalesce("_found", none)
    names = F.array_sort(F.array_union(F.map_keys(mine), F.map_keys(theirs)))
    odd = F.filter(names, lambda c: ~F.try_element_at(mine, c).eqNullSafe(F.try_element_at(theirs, c)))
    columns = F.filter(odd, lambda c: c != ROW)
    rows = F.coalesce("rows_written", F.lit(0)) != F.coalesce("rows_found", F.lit(0))
    # every digest takes the key, so that a lost row shows in all of them; a changed pairing alone in that of the row
    differs = F.when(F.size(columns) > 0, columns).otherwise(odd)
    differs = F.when(rows, F.array_append(differs, F.lit(ROWS))).otherwise(differs)
    out = j.select(*by, F.coalesce("rows_written", F.lit(0)).alias("rows_written"), F.coalesce("rows_found", F.lit(0)).alias("rows_found"), differs.alias("differs"))
    return out.withColumn("status", F.when(F.size("differs") == 0, "SUCCESS").otherwise("FAILED"))


def write_checked(df: DataFrame, path: str, keys: Sequence[str], day: str = "race_date", order: Sequence[str] = ()) -> DataFrame:
    """write_days(), then content_report() of df against what is read back under its schema, for the days of df. df is read twice, so it should be a table."""
    said = column_digests(df, keys, [day])
    write_days(df, path, day, order=order)
    return content_report(said, read_back(df, path, keys, day), [day])


def read_back(df: DataFrame, path: str, keys: Sequence[str], day: str = "race_date") -> DataFrame:
    """column_digests() of the stored days that df has, in df's order of columns."""
    stored = df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)
    return column_digests(stored.join(F.broadcast(df.select(day).distinct()), day, "left_semi").select(df.columns), keys, [day])


def joined_status(report: DataFrame, content: DataFrame, day: str = "race_date", name: str = "read_back") -> DataFrame:
    """A gated report with `name`, the number of columns that read back otherwise, among its failures, and the columns as <name>_differs."""
    c = content.select(F.col(day).alias("_day"), F.size("differs").cast("long").alias(name), F.col("differs").alias(f"{name}_differs"))
    j = report.join(c, report[day].eqNullSafe(F.col("_day")), "left").drop("_day").withColumn(name, F.coalesce(name, F.lit(0)))
    before = F.when(F.col("failures") == "", F.lit(None)).otherwise(F.col("failures"))
    again = j.withColumn("failures", F.concat_ws(",", before, F.when(F.col(name) > 0, F.lit(name))))
    return again.withColumn("status", F.when(F.col("failures") == "", "SUCCESS").otherwise("FAILED"))
