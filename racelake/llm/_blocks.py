"""Blocks of texts: parts of a scan task, named by their content, to which other tasks send answers.

The hash space is dealt out as ranges, several to each shuffle partition; an owner task sorts its rows by range and works on one
at a time, so what it holds is a fraction of what it reads, whatever the number of partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

BLOCK_BYTES = 4_000_000
#: Ranges of the hash space in each partition.
RANGES = 8


def range_edges(parts: int, bits: int = 64) -> np.ndarray:
    """The first hash of each range but the first."""
    return np.array([i * 2**bits // (parts * RANGES) for i in range(1, parts * RANGES)], np.uint64)


def to_owners(sent: DataFrame, parts: int, *order: str) -> DataFrame:
    """Rows by `owner`, the number of their range: neighbouring ranges share a partition, each partition has as many, sorted by range."""
    return sent.repartitionById(parts, F.expr(f"cast(owner div {RANGES} as int)")).sortWithinPartitions("owner", *order)


def parts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, pa.Array, pa.Array]]:
    """(name, ids, held out, texts) of each block of a batch of doc_id, held_out, text; the name is a hash of all three."""
    at = 0
    for texts in slices(batch.column(2), BLOCK_BYTES):
        ids, held = (batch.column(k).slice(at, len(texts)) for k in (0, 1))
        h = xxhash.xxh3_64(repr(ids.to_pylist()))
        for text in texts:
            raw = text.as_buffer()
            h.update(raw.size.to_bytes(8, "little"))
            h.update(raw)
        yield h.intdigest() >> 1, ids, held, texts
        at += len(texts)


def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each block as one row, named as in the requests."""
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    for batch in batches:
        for name, ids, held, texts in parts_of(batch):
            plain = pa.array(texts.to_pylist(), pa.string()) if texts.offset else texts
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([2]), pa.array([-1]), pa.array([None], pa.binary()), one(ids), one(held), one(plain)], ["block", "kind", "owner", "counts", "ids", "held", "texts"])
