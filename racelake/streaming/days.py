"""Row-wise and per-date operators on a stream of day files: each micro-batch is a batch frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.text_files import write_days


def run_on_arrival(stream: DataFrame, job: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, file: str = "source_file") -> StreamingQuery:
    """Apply a batch job to what arrived and replace, in each day it yields, the rows of the arrived files alone: a later file of a day adds to it, and a batch that is run again after a failure writes the same again."""
    write = lambda df, _: write_days(job(df), path, within=[file])
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
