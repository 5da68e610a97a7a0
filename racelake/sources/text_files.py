"""Readers and sinks: encoded text files, their sidecars, and date-partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LINE_ENDS, decoded, numbered_lines


def read_encoded(spark: SparkSession, paths: str | Sequence[str], charset: str = "cp932") -> DataFrame:
    """(path, file, content, length, sha256, text) of whole files. A byte that the charset doesn't have fails the read, not silently replaced."""
    d = spark.read.format("binaryFile").load(paths)
    return d.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "content", "length", F.sha2("content", 256).alias("sha256"), decoded(F.col("content"), charset).alias("text"))


def read_lines(spark: SparkSession, paths: str | Sequence[str], charset: str = "cp932") -> DataFrame:
    """(file, chunk, place, raw): the lines of files however long. A file is read in blocks by as many tasks (chunk: where the block begins); place rises within a block, and a byte that the charset doesn't have fails the read. The charset must have no line feed within its characters, as cp932 and UTF-8 have none. Rarer line ends divide a line further, except one that ends a file."""
    d = spark.read.text(paths).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("chunk"), F.monotonically_increasing_id().alias("_row"), decoded(F.col("value").cast("binary"), charset).alias("_line"))
    return d.select("file", "chunk", "_row", F.posexplode(F.split("_line", LINE_ENDS)).alias("_at", "raw")).select("file", "chunk", F.struct("_row", "_at").alias("place"), "raw")


def date_from_name(name: Column, prefix: str, explicit: Column | None = None) -> Column:
    """20YY-MM-DD from <prefix>YYMMDD in a file name, whatever its case; an explicit date wins; null if neither is there."""
    d = F.regexp_extract(name, f"(?i){prefix}(\\d{{6}})", 1)
    found = F.when(d != "", F.concat_ws("-", F.concat(F.lit("20"), F.substring(d, 1, 2)), F.substring(d, 3, 2), F.substring(d, 5, 2)))
    found = F.when(F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).isNotNull(), found)
    return found if explicit is None else F.coalesce(explicit, found)


def lines_of(files: DataFrame) -> DataFrame:
    """The other columns of files with line_no and line; files are kept whole until here, so their size bounds a task's row."""
    keep = [c for c in files.columns if c not in ("text", "content")]
    return files.select(*keep, F.explode(numbered_lines(F.col("text"))).alias("_l")).select(*keep, F.col("_l.no").alias("line_no"), F.col("_l.line").alias("raw"))


def one_file_each(listing: DataFrame, units: Sequence[str], preference: Column) -> tuple[DataFrame, DataFrame]:
    """(chosen, errors): the single most preferred file of each unit; units with several equally preferred ones are errors."""
    best = listing.withColumn("_p", preference).groupBy(*units).agg(F.max(F.struct(F.col("_p"), "file")).alias("_b"), F.max("_p").alias("_top"), F.collect_list(F.struct("_p", "file")).alias("_all"))
    best = best.withColumn("n", F.size(F.filter("_all", lambda x: x["_p"] == F.col("_top"))))
    return best.filter("n = 1").select(*units, F.col("_b.file").alias("file")), best.filter("n <> 1").select(*units, "n")


def read_sidecars(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """(path, file, the schema's fields, missing): JSON documents with the list of required fields that are missing or null; broken ones miss all. The path names the file that a sidecar stands beside."""
    d = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema).alias("m"))
    missing = F.filter(F.array(*[F.when(F.col(f"m.{c}").isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    return d.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "m.*", missing.alias("missing"))


#: The compression method in the head of an archive.
ARCHIVE = "(?i)-lh[0-9a-z]-"


def audit_content(files: DataFrame, recorded: DataFrame, magic: str = ARCHIVE) -> DataFrame:
    """Per recorded file (file, length, sha256): what differs from the file that is there; magic is a pattern that its first 64 bytes, read as Latin-1, must hold."""
    there = files.select("file", F.col("length").alias("_len"), F.col("sha256").alias("_sha"), F.decode(F.substring("content", 1, 64), "ISO-8859-1").rlike(magic).alias("_magic"))
    j = recorded.join(there, "file", "left")
    names = {"absent": F.col("_len").isNull(), "empty": F.col("_len") == 0, "length": F.col("_len") != F.col("length"), "sha256": F.col("_sha") != F.col("sha256"), "magic": ~F.col("_magic")}
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in names.items()]), lambda x: x.isNotNull())
    return j.select("file", found.alias("differences"))


def write_days(df: DataFrame, path: str, day: str = "race_date", within: Sequence[str] = (), order: Sequence[str] = ()) -> None:
    """Replace exactly the days that df holds, or, with further partition columns `within`, exactly their parts of those days; rows in order within files."""
    parts = [day, *within]
    d = df.repartition(*parts)
    d = d.sortWithinPartitions(*parts, *order) if order else d
    d.write.partitionBy(*parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, in whatever store it is."""
    where, files = _file_system(spark, path)
    return files.exists(where)


def withdraw_days(spark: SparkSession, path: str, days: Sequence[str], day: str = "race_date") -> list[str]:
    """Delete the partitions of these days from a date-partitioned table; the days that were there."""
    gone = []
    for d in days:
        where, files = _file_system(spark, f"{path}/{day}={d}")
        if files.exists(where):
            files.delete(where, True)
            gone.append(d)
    return gone


def write_reports(df: DataFrame, path: str, day: str = "race_date") -> None:
    """One JSON document for each day, replacing those of the days that df holds."""
    df.repartition(day).write.partitionBy(day).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").json(path)


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A date-partitioned table under its contract; the schema keeps day and codes as text."""
    return spark.read.schema(schema).parquet(path)


def unfinished(requested: DataFrame, quality: DataFrame, day: str = "race_date") -> DataFrame:
    """Requested days that have no successful quality row."""
    return requested.join(quality.filter("status = 'SUCCESS'").select(day), day, "left_anti")


def readback(df: DataFrame, manifest: DataFrame, day: str = "race_date", races: Sequence[str] = (), constants: Sequence[str] = (), schema: T.StructType | None = None) -> DataFrame:
    """Per day of the manifest (row_count, with race keys race_count, and the constant columns) the rows that are there and whether everything agrees: counts, the constants of every row, and the schema's names and types."""
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    said = manifest.select(day, *[F.col(c).alias(f"_said_{c}") for c in constants])
    j = df.join(F.broadcast(said), day, "left") if constants else df  # a row for each day
    differs = [n(~F.col(c).eqNullSafe(F.col(f"_said_{c}"))).alias(f"_differs_{c}") for c in constants]
    got = j.groupBy(day).agg(F.count("*").alias("rows"), *differs, *([F.count_distinct(F.struct(*races)).alias("races")] if races else []))
    same = schema is None or [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]
    out = manifest.join(got, day, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    agrees = F.lit(same) & (F.col("row_count") == F.col("rows"))
    if races:
        agrees = agrees & F.coalesce(F.col("race_count") == F.col("races"), F.lit(False))
    for c in constants:
        agrees = agrees & (F.coalesce(f"_differs_{c}", F.lit(0)) == 0)
    return out.select(day, "row_count", "rows", agrees.alias("agrees"))
