"""Order over whole tables and long files, without a task that sees either whole: ranges with stitched borders, chunks with carried heads."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dealing

_FALL, _FIRST, _LAST = range(3)


def _compared(a: Sequence[pa.Array], b: Sequence[pa.Array]) -> tuple[pa.Array, pa.Array]:
    """(a after b, a equal to b), row by row, column after column; null comes first and equals null."""
    after, same = pa.array([False] * len(a[0])), pa.array([True] * len(a[0]))
    for x, y in zip(a, b, strict=True):
        more = pc.or_(pc.and_(pc.is_valid(x), pc.is_null(y)), pc.fill_null(pc.greater(x, y), False))
        equal = pc.or_(pc.and_(pc.is_null(x), pc.is_null(y)), pc.fill_null(pc.equal(x, y), False))
        after, same = pc.or_(after, pc.and_(same, more)), pc.and_(same, equal)
    return after, same


def _falls(n_by: int, n_position: int, n_value: int, strict: bool, names: list[str]):
    """Sorted rows of by, position and value columns: those that come before the row above (kind, part, the row, and the values above), and the first and last row of the task."""

    def row(batch: pa.RecordBatch, kind: int, values: list[pa.Array]) -> pa.RecordBatch:
        fixed = [pa.array([x] * batch.num_rows, pa.int32()) for x in (kind, TaskContext.get().partitionId())]
        return pa.RecordBatch.from_arrays([*fixed, *batch.columns, *values], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        none = lambda b: [pa.nulls(b.num_rows, c.type) for c in b.columns[n_by + n_position :]]
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                yield row(batch.slice(0, 1), _FIRST, none(batch.slice(0, 1)))
                here, above = batch.slice(1), batch.slice(0, batch.num_rows - 1)
            else:
                here = batch
                above = pa.Table.from_batches([last, batch.slice(0, batch.num_rows - 1)]).combine_chunks().to_batches()[0]
            last = batch.slice(batch.num_rows - 1)
            if not here.num_rows:
                continue
            after, equal = _compared(above.columns[n_by + n_position :], here.columns[n_by + n_position :])
            bad = pc.or_(after, equal) if strict else after
            if n_by:
                bad = pc.and_(bad, _compared(above.columns[:n_by], here.columns[:n_by])[1])
            if pc.any(bad).as_py():
                yield row(here.filter(bad), _FALL, above.filter(bad).columns[n_by + n_position :])
        if last is not None:
            yield row(last, _LAST, none(last))

    return scan


def order_falls(df: DataFrame, position: Sequence[str], value: Sequence[str], by: Sequence[str] = (), strict: bool = False, rows: int | None = None) -> DataFrame:
    """The rows whose `value` comes before that of the row above them in order of `position`, within each `by`: by, position and value columns, and before_<value>, the value above. strict: an equal value falls too. position names rows (a value twice would leave their order open); nulls come first.

    Rows are dealt out by ranges of (by, position); a task compares its neighbours and passes on its first and last row, and a table of those, two rows a task, compares the borders. So neither a day nor the table is in one task, and all comes from one pass over one range partitioning. rows: those of df, where they are known, else counted; there are more ranges the more there are."""
    d = df.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], *[F.col(c).alias(f"_p{i}") for i, c in enumerate(position)], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(value)])
    above = [T.StructField(f"_a{i}", d.schema[f"_v{i}"].dataType) for i in range(len(value))]
    shape = T.StructType([T.StructField("_kind", T.IntegerType()), T.StructField("_part", T.IntegerType()), *[T.StructField(f.name, f.dataType) for f in d.schema], *above])
    keys = d.columns[: len(by) + len(position)]
    n = dealing.more_tasks(df.sparkSession, df.count() if rows is None else rows)
    ranged = d.repartitionByRange(*([n] if n else []), *[F.col(c).asc_nulls_first() for c in keys]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in keys])
    out = ranged.mapInArrow(_falls(len(by), len(position), len(value), strict, shape.names), shape)
    # the border rows meet in one part, two for each task of the ranges; the falls stay where they are
    here, group = F.struct(*[f"_v{i}" for i in range(len(value))]), F.struct(F.lit(0), *[f"_b{i}" for i in range(len(by))])
    out = out.withColumn("_near", F.when(F.col("_kind") == _FALL, F.col("_part")).otherwise(-1))
    if n:
        out = out.repartition(n, "_near")
    w = Window.partitionBy("_near").orderBy("_part", "_kind")
    out = out.withColumn("_up", F.lag(F.struct(group.alias("g"), here.alias("v"))).over(w))
    fell = F.col("_up.v") >= here if strict else F.col("_up.v") > here
    border = (F.col("_kind") == _FIRST) & F.coalesce(F.col("_up.g") == group, F.lit(False)) & F.coalesce(fell, F.lit(False))
    out = out.filter((F.col("_kind") == _FALL) | border)
    before = [F.when(F.col("_kind") == _FALL, F.col(f"_a{i}")).otherwise(F.col(f"_up.v._v{i}")).alias(f"before_{c}") for i, c in enumerate(value)]
    named = [F.col(f"_{k}{i}").alias(c) for k, columns in (("b", by), ("p", position), ("v", [v for v in value if v not in position])) for i, c in _numbered(columns, value if k == "v" else columns)]
    return out.select(*named, *before)


def _numbered(columns: Sequence[str], among: Sequence[str]) -> list[tuple[int, str]]:
    return [(list(among).index(c), c) for c in columns]


def carried(lines: DataFrame, file: Sequence[str], place: str, values: Mapping[str, Column], chunk: str | None = None) -> DataFrame:
    """lines with columns that hold, for each name, the last value that is not null in the file up to the row, in order of place.

    chunk names the part of the file that a row stands in (rising, as place does): then each chunk's last values are taken first, carried over
    the chunks of a file, one row each, and filled in within the chunks, so that no task holds more of a file than a chunk."""
    w = Window.partitionBy(*file, *([chunk] if chunk else [])).orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not chunk:
        return lines.withColumns({name: F.last(v, ignorenulls=True).over(w) for name, v in values.items()})
    own = [*file, chunk]
    heads = lines.groupBy(*own).agg(*[F.max_by(v, F.when(v.isNotNull(), F.col(place))).alias(name) for name, v in values.items()])
    before = Window.partitionBy(*file).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(*[F.col(c).alias(f"_of_{c}") for c in own], *[F.last(name, ignorenulls=True).over(before).alias(f"_to_{name}") for name in values])
    d = lines.withColumns({name: F.last(v, ignorenulls=True).over(w) for name, v in values.items()})
    same = F.lit(True)
    for c in own:
        same = same & d[c].eqNullSafe(heads[f"_of_{c}"])
    d = d.join(heads, same).withColumns({name: F.coalesce(name, f"_to_{name}") for name in values})
    return d.drop(*[f"_of_{c}" for c in own], *[f"_to_{name}" for name in values])


def numbered(lines: DataFrame, file: Sequence[str], place: str, chunk: str, name: str = "line_no") -> DataFrame:
    """lines with their number in the file, from 1: a chunk's rows are numbered by themselves, after the rows of the chunks before it."""
    own = [*file, chunk]
    before = Window.partitionBy(*file).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy(*own).agg(F.count("*").alias("_n")).select(*[F.col(c).alias(f"_of_{c}") for c in own], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_to"))
    d = lines.withColumn(name, F.row_number().over(Window.partitionBy(*own).orderBy(place)))
    same = F.lit(True)
    for c in own:
        same = same & d[c].eqNullSafe(sizes[f"_of_{c}"])
    return d.join(sizes, same).withColumn(name, (F.col(name) + F.col("_to")).cast("int")).drop("_to", *[f"_of_{c}" for c in own])
