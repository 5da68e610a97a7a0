"""Canonical text, digests and the chains they form."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import dealing


def canonical_json(columns: Sequence[str]) -> Column:
    """Sorted keys, no blanks, nulls kept, one line end. Format floats as text first."""
    return F.concat(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), F.lit("\n"))


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def is_canonical(stored: Column, columns: Sequence[str], schema: str) -> Column:
    """Whether a stored text equals its own canonical form."""
    parsed = F.from_json(stored, schema)
    again = F.concat(F.to_json(F.struct(*[parsed[c].alias(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), F.lit("\n"))
    return F.coalesce(stored == again, F.lit(False))


#: Entries of a range of places: no array is longer, and a tree of three levels holds as many to the third power.
SPAN = 4096


def _tree(parts: DataFrame, keys: Sequence[str], name: str, also: Mapping[str, Callable] | None = None, span: int = SPAN) -> DataFrame:
    """One digest for each group from the digests (_d) of its ranges in order of place (_r), and columns by the aggregates that combine them (also): ranges of ranges are digested level by level, a range alone keeps its digest, so a group of one range has that range's."""
    also = also or {}
    for level in range(3):
        up = F.floor(F.col("_r") / span) if level < 2 else F.lit(0).cast("long")
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("_r", "_d"))), lambda x: x["_d"])
        d = F.when(F.count("*") == 1, F.first("_d")).otherwise(digest(F.concat_ws(";", ordered)))
        parts = parts.withColumn("_up", up).groupBy(*keys, "_up").agg(d.alias("_d"), *[f(c).alias(c) for c, f in also.items()]).withColumnRenamed("_up", "_r")
    return parts.select(*keys, F.col("_d").alias(name), *also)


def ordered_digest(df: DataFrame, keys: Sequence[str], place: str, part: Column, name: str = "digest", span: int = SPAN) -> DataFrame:
    """A digest of each group's parts in order of place (from 1), for groups of any size: ranges of `span` places are digested, then ranges of ranges. A group of one range has the digest of its parts joined by ';'. Parts that share a place are told by the least and the greatest and their number."""
    return _ranged(df.select(*keys, F.col(place).cast("long").alias("_at"), part.alias("_part")), keys, name, {}, span, None)


def _ranged(entries: DataFrame, keys: Sequence[str], name: str, also: Mapping[str, tuple[Column, Callable]], span: int, rows: int | None) -> DataFrame:
    """ordered_digest() of entries (keys, _at, _part), with columns (also) by an aggregate over the entries of a place and one that combines places. Entries are dealt out once, by group and range of places, and ranges once more, by group."""
    r = F.floor((F.col("_at") - 1) / span)
    at = dealing.dealt(entries.withColumn("_r", r), [*keys, "_r"], rows).groupBy(*keys, "_r", "_at").agg(F.count("*").alias("_n"), F.min("_part").alias("_low"), F.max("_part").alias("_high"), *[c.alias(k) for k, (c, _) in also.items()])
    up = {k: f for k, (_, f) in also.items()}
    x = F.when(F.col("_n") == 1, F.col("_low")).otherwise(F.concat_ws("#", "_low", "_high", "_n"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col("_at"), x.alias("x")))), lambda e: e["x"])
    first = at.groupBy(*keys, "_r").agg(digest(F.array_join(ordered, ";")).alias("_d"), *[f(c).alias(c) for c, f in up.items()])
    return _tree(dealing.dealt(first, keys, rows), keys, name, up, span)


def group_digest(df: DataFrame, keys: Sequence[str], part: Column, name: str = "digest", span: int = SPAN, rows: int | None = None) -> DataFrame:
    """A digest of each group's parts, sorted as text, so that the order of the input doesn't matter: of the parts joined by ';', or, for a group of more than `span`, of the digests of its buckets, a bucket by hash for each span / 2 parts; no array holds a large group. Only the large groups' sizes are joined, at most one for each `span` rows. rows: those of df, where they are known."""
    d = df.select(*keys, part.cast("string").alias("_part"))
    sizes = d.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.count("*").alias("_size")).filter(F.col("_size") > span)
    d = dealing.dealt(d, keys, rows)
    same = F.lit(True)
    for k in keys:
        same = same & d[k].eqNullSafe(sizes[f"_of_{k}"])
    bucket = F.when(F.col("_size").isNotNull(), F.pmod(F.xxhash64("_part"), F.ceil(F.col("_size") / (span / 2)))).otherwise(0)
    d = d.join(F.broadcast(sizes), same, "left").groupBy(*keys, bucket.cast("long").alias("_r")).agg(digest(F.array_join(F.array_sort(F.collect_list("_part")), ";")).alias("_d"))
    return _tree(d, keys, name, None, span)


def binding_report(recorded: DataFrame, actual: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One row: units compared, mismatches (null-safe), units on one side only."""
    from .reconcile import full_outer

    j = full_outer(recorded.select(*keys, F.col(column).alias("_a")), actual.select(*keys, F.col(column).alias("_b")), keys)
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    both = F.col("side") == "both"
    return j.agg(n(both).alias("compared"), n(both & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("mismatches"), n(~both).alias("one_sided"))


def publish_status(candidate: DataFrame, existing: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Candidates by what publishing them would do: CREATED, VALIDATED_REUSE or CONFLICT."""
    old = existing.select(*keys, F.col(column).alias("_old"), F.lit(True).alias("_known"))
    j = candidate.join(old, list(keys), "left")
    return j.withColumn("publish", F.when(F.col("_known").isNull(), "CREATED").when(F.col(column).eqNullSafe(F.col("_old")), "VALIDATED_REUSE").otherwise("CONFLICT")).drop("_old", "_known")


def hash_chain(df: DataFrame, order: str, own: str, previous: str) -> Column:
    """Whether each event records the digest of the one before (null for the first); order within the log by `order`."""
    return F.coalesce(F.col(previous).eqNullSafe(F.lag(own).over(Window.partitionBy("log_id").orderBy(order))), F.lit(False))


def run_id(*parts: str) -> Column:
    """A run named by what it is made from."""
    return digest(F.concat_ws("|", *parts))


def bucketed_digest(df: DataFrame, keys: Sequence[str], part: Column, buckets: int = 64, name: str = "digest", rows: int | None = None) -> DataFrame:
    """A digest of groups of any size: of the digests of their buckets in order, a bucket by hash of the part; no task gathers a whole group."""
    d = df.withColumn("_bucket", F.pmod(F.xxhash64(part), F.lit(buckets)))
    inner = group_digest(d, [*keys, "_bucket"], part, "_inner", rows=rows)
    part = F.concat_ws(":", F.lpad(F.col("_bucket").cast("string"), 6, "0"), "_inner")
    if buckets > SPAN:
        return group_digest(inner, keys, part, name, rows=rows)
    # no group has more than `buckets` rows now, so none needs its size
    return dealing.dealt(inner, keys, rows).groupBy(*keys).agg(digest(F.array_join(F.array_sort(F.collect_list(part)), ";")).alias(name))


def collection_digest(entries: DataFrame, keys: Sequence[str], place: str, child: str, size: str, span: int = SPAN, rows: int | None = None) -> DataFrame:
    """Per collection (keys) the digest of its children's digests and sizes in order of place, as ordered_digest() makes it for collections of any size, with entry_count, total_bytes and the faults: sizes that are not positive, digests that are none, and gaps or repeats of the places 1 to n. rows: the entries, where their number is known."""
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    part = F.concat_ws(":", child, F.col(size).cast("string"))
    d = entries.select(*keys, F.col(place).cast("long").alias("_at"), part.alias("_part"), F.col(size).alias("_size"), F.coalesce(F.col(child).rlike("^[0-9a-f]{64}$"), F.lit(False)).alias("_sound"))
    also = {
        "entry_count": (F.count("*"), F.sum), "total_bytes": (F.sum("_size").cast("long"), F.sum), "bad_sizes": (n(~F.coalesce(F.col("_size") > 0, F.lit(False))), F.sum), "bad_digests": (n(~F.col("_sound")), F.sum),
        "_places": (F.count_if(F.col("_at").isNotNull()).cast("boolean").cast("long"), F.sum), "_least": (F.min("_at"), F.min), "_most": (F.max("_at"), F.max),
    }
    odd = F.greatest(F.col("_most"), F.lit(0)) - 2 * F.col("_places") + F.abs(F.col("_least") - 1)
    out = _ranged(d, keys, "collection_sha256", also, span, rows)
    return out.select(*keys, "collection_sha256", "entry_count", "total_bytes", "bad_sizes", "bad_digests", (F.col("entry_count") + odd).cast("long").alias("bad_places"))


def manifest_chain(artifacts: DataFrame, references: DataFrame, parents: dict[str, Sequence[str]], versions: dict[str, str], identity: Sequence[str]) -> DataFrame:
    """Per artifact (artifact_id, kind, contract_version, sha256 and the identity columns) what is wrong with its references (artifact_id, parent_kind, parent_id, recorded_sha256), gated.

    parents: the kinds that each kind must refer to, one reference each; versions: the one contract version of each kind.  A chain has fixed
    levels, and every artifact is checked against its parents, so one join covers all levels."""
    from .checks import count_where, gate

    theirs = artifacts.select(F.col("artifact_id").alias("parent_id"), F.col("kind").alias("_kind"), F.col("sha256").alias("_actual"), *[F.col(c).alias(f"_their_{c}") for c in identity])
    j = artifacts.select("artifact_id", "kind", *identity).join(references, "artifact_id").join(theirs, "parent_id", "left")
    known = F.col("_actual").isNotNull()
    other = F.lit(False)
    for c in identity:
        other = other | ~F.col(c).eqNullSafe(F.col(f"_their_{c}"))
    per = j.groupBy("artifact_id").agg(
        F.array_sort(F.collect_list("parent_kind")).alias("_has"), count_where(~known).alias("parent_missing"), count_where(known & (F.col("_kind") != F.col("parent_kind"))).alias("parent_kind_differs"),
        count_where(known & ~F.col("recorded_sha256").eqNullSafe(F.col("_actual"))).alias("digest_differs"), count_where(known & other).alias("identity_differs"),
    )
    disagree = references.groupBy("parent_id").agg(F.count_distinct(F.coalesce("recorded_sha256", F.lit(""))).alias("_k")).filter("_k > 1").select("parent_id")
    disagree = references.join(disagree, "parent_id", "left_semi").groupBy("artifact_id").agg(F.count("*").alias("references_disagree"))
    want = F.create_map(*[x for kind, needed in parents.items() for x in (F.lit(kind), F.array(*[F.lit(p) for p in sorted(needed)]).cast("array<string>"))])
    version = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
    d = artifacts.join(per, "artifact_id", "left").join(disagree, "artifact_id", "left")
    none = F.array().cast("array<string>")
    d = d.withColumn("parents_differ", (~F.coalesce("_has", none).eqNullSafe(F.coalesce(F.try_element_at(want, F.col("kind")), none))).cast("long")).withColumn("version_differs", (~F.col("contract_version").eqNullSafe(F.try_element_at(version, F.col("kind")))).cast("long"))
    measures = ["parents_differ", "version_differs", "parent_missing", "parent_kind_differs", "digest_differs", "identity_differs", "references_disagree"]
    return gate(d.select("artifact_id", "kind", *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures]), measures)


def package_audit(files: DataFrame, bindings: DataFrame, approvals: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per package (keys) what is wrong, gated: its files (name, sha256) are not exactly `names`; a digest that a binding (name, recorded_sha256) records is not that of the file; the approval (decision, authority_status) is missing, repeated, not APPROVED or does not begin ACTIVE."""
    from .checks import count_where, gate

    sets = files.groupBy(*keys).agg((~(F.array_sort(F.collect_list("name")) == F.array(*[F.lit(n) for n in sorted(names)]))).cast("long").alias("file_set"))
    bound = bindings.join(files.select(*keys, "name", "sha256"), [*keys, "name"], "left")
    bound = bound.groupBy(*keys).agg(count_where(~F.coalesce(F.col("recorded_sha256") == F.col("sha256"), F.lit(False))).alias("binding_differs"))
    state = approvals.groupBy(*keys).agg(F.count("*").alias("_n"), count_where(~F.coalesce(F.col("decision") == "APPROVED", F.lit(False))).alias("not_approved"), count_where(~F.coalesce(F.col("authority_status") == "ACTIVE", F.lit(False))).alias("not_active"))
    d = sets.join(bound, list(keys), "full").join(state, list(keys), "full").withColumn("approval_count", F.when(F.coalesce("_n", F.lit(0)) == 1, 0).otherwise(1))
    measures = ["file_set", "binding_differs", "approval_count", "not_approved", "not_active"]
    # a package known by a binding or approval alone lacks its files
    return gate(d.select(*keys, F.coalesce("file_set", F.lit(1)).alias("file_set"), *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures[1:]]), measures)


def artifact_records(records: DataFrame, listing: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per run (keys) what is wrong with the artifacts it records (name, path, size, sha256) against the files that are there (path, length, sha256), gated: the set of names, paths that are blank or not there, sizes and digests (in either case) that differ."""
    from .checks import count_where, gate

    there = listing.select("path", F.col("length").alias("_length"), F.lower("sha256").alias("_sha"))
    j = records.join(there, "path", "left")
    found = F.col("_length").isNotNull()
    d = j.groupBy(*keys).agg(
        (~(F.array_sort(F.collect_list("name")) == F.array(*[F.lit(n) for n in sorted(names)]))).cast("long").alias("name_set"), count_where(F.coalesce(F.trim("path"), F.lit("")) == "").alias("path_blank"), count_where(~found & (F.coalesce(F.trim("path"), F.lit("")) != "")).alias("file_missing"),
        count_where(found & ~F.col("size").eqNullSafe(F.col("_length"))).alias("size_differs"), count_where(found & ~F.lower("sha256").eqNullSafe(F.col("_sha"))).alias("digest_differs"),
    )
    return gate(d, ["name_set", "path_blank", "file_missing", "size_differs", "digest_differs"])
