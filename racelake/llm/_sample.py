"""Bounded samples by hash: no ranking, so no task ever holds a class or language whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a sample beyond the number asked for, in standard deviations: a sample is that much smaller on average.
_MARGIN = 6.0


def share_of(rows: int, most: int) -> float:
    """The share of `rows` to keep so that, but for a chance of one in some hundred million, at most `most` are kept; all where there are no more."""
    return 1.0 if rows <= most else max(most - _MARGIN * most**0.5, most / 2) / rows


def hash_sample(df: DataFrame, rows: int, most: int) -> DataFrame:
    """At most about `most` of the `rows` different rows of df: those in a range of the hash of all columns. Equal rows are one row."""
    within = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 40)) < F.lit(int(share_of(rows, most) * (1 << 40)))
    return df.filter(within).dropDuplicates()


def hash_sample_by(df: DataFrame, group: str, most: int) -> DataFrame:
    """The same for each value of a column, null left out. The values' counts are a row each: classes or languages, not keys."""
    counts = {r[0]: r[1] for r in df.filter(F.col(group).isNotNull()).groupBy(group).count().collect()}
    if not counts:
        return df.filter("false")
    limits = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(share_of(n, most) * (1 << 40)))])
    within = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 40)) < F.element_at(limits, F.col(group))
    return df.filter(within).dropDuplicates()
