"""How many tasks rows are dealt out to: Spark's setting is one number for tables of every size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Rows for a task that sorts them or holds a state for each.
TASK_ROWS = 500_000


def more_tasks(spark: SparkSession, rows: int | None) -> int | None:
    """The tasks that so many rows need, if Spark's setting is fewer, else None."""
    needed = -(-(rows or 0) // TASK_ROWS)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """df dealt out by its keys, to one task at least for TASK_ROWS rows, so that what a task holds does not grow with df; what is grouped or joined by these keys stays there. rows: their number, None if it is not known (Spark's setting holds)."""
    n = more_tasks(df.sparkSession, rows)
    return df.repartition(*([n] if n else []), *keys)
