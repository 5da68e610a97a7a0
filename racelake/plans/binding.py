"""Lineage jobs: labels with provenance, venue bindings, deadline collections, dataset certification, model events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks, dealing, lineage, ordered, pit, reconcile
from .racing import ENTRY, RACE

VENUE = ["race_date", "venue_code"]
TERMINAL = ("REVOKE", "ROLLBACK")


# The columns of a label's provenance, and the version of their contract.
LABEL_PROVENANCE = ["label_source_fetched_at", "label_source_max_time", "label_source_sha256", "label_source_url", "label_collector_version", "label_contract_version", "label_provenance_status"]
LABEL_CONTRACT = "post_race_label_parquet_v1"
# End of the fixed values.


def build_labels(labels: DataFrame, sources: DataFrame, keys: Sequence[str] = ENTRY, differences: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(labels, report by date): results or payouts with the seven columns of their source's provenance.

    sources: sidecars (race_date, fetched_at as text with an offset, source_sha256, source_url, collector_version, missing: the required fields that it
    lacks), differences: what audit_content() found of their files (race_date, differences).  Dates without a source, with an incomplete or differing one,
    with a time that is none, repeated or null keys, or dates that are none fail and yield nothing; feature columns are refused."""
    if leaked := [c for c in labels.columns if c.strip().casefold() in checks.LABEL_PROHIBITED]:
        raise ValueError(f"feature columns among labels: {leaked}")
    n, fetched = checks.count_where, pit.aware(F.col("fetched_at"))
    missing = F.size("missing") if "missing" in sources.columns else F.lit(0)
    known = sources.select("race_date", fetched.alias("_at"), "source_sha256", "source_url", "collector_version", missing.alias("_missing"), F.lit(True).alias("_source"))
    if differences is not None:
        known = known.join(differences.select("race_date", F.size("differences").alias("_differences")), "race_date", "left")
    known = known.withColumn("_differences", F.coalesce("_differences", F.lit(1))) if differences is not None else known.withColumn("_differences", F.lit(0))
    d = labels.join(F.broadcast(known), "race_date", "left")  # one row for a date
    given = F.col("_source").isNotNull()
    report = d.groupBy("race_date").agg(
        n(~given).alias("without_source"), n(given & (F.col("_missing") > 0)).alias("source_incomplete"), n(given & (F.col("_differences") > 0)).alias("source_differs"), n(given & F.col("_at").isNull()).alias("bad_source_time"),
        n(F.try_to_timestamp("race_date", F.lit("yyyy-MM-dd")).isNull()).alias("bad_dates"), sum((n(F.col(k).isNull()) for k in keys), F.lit(0)).alias("null_keys"),
    )
    twice = checks.dup_groups(labels, list(keys), ["race_date"]).select("race_date", F.col("dup_rows").alias("duplicates"))
    report = reconcile.full_outer(report, twice, ["race_date"]).drop("side")
    report = checks.gate(report, ["without_source", "source_incomplete", "source_differs", "bad_source_time", "bad_dates", "null_keys", "duplicates"])
    at = F.date_format("_at", "yyyy-MM-dd'T'HH:mm:ssXXX")
    d = d.withColumns(dict(zip(LABEL_PROVENANCE, (at, at, F.col("source_sha256"), F.col("source_url"), F.col("collector_version"), F.lit(LABEL_CONTRACT), F.lit("VERIFIED")), strict=True)))
    good = report.filter("status = 'SUCCESS'").select("race_date")
    return d.join(good, "race_date", "left_semi").select(*labels.columns, *LABEL_PROVENANCE), report


def bind_venues(program: DataFrame, deadlines: DataFrame) -> DataFrame:
    """Per venue-day a digest over its race-to-boats grid and the digests of its program and deadline sources. deadlines: race_date, venue_code, deadline_sha256, program_sha256. Races sort as text, as keys of a document do; another venue's rows never matter."""
    grid = program.groupBy(*RACE).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "boat_no", "racer_id"))), ",").alias("_boats"))
    races = grid.groupBy(*VENUE).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col("race_no").cast("string"), "_boats"))), ";").alias("_grid"), F.count("*").alias("races"))
    j = reconcile.full_outer(races, deadlines, VENUE)
    bound = F.when(F.col("side") == "both", lineage.digest(F.concat_ws("|", "race_date", "venue_code", "deadline_sha256", "program_sha256", "_grid")))
    status = F.when(F.col("side") == "left_only", "DEADLINE_MISSING").when(F.col("side") == "right_only", "PROGRAM_MISSING").when(F.col("races") != 12, "RACES_INCOMPLETE").otherwise("BOUND")
    return j.select(*VENUE, bound.alias("binding_sha256"), status.alias("status"))


def collect_bindings(bindings: DataFrame) -> DataFrame:
    """Per date one digest of its venues' digests and their lengths in venue order, with their number and the faults of lengths, digests and places."""
    place = F.row_number().over(Window.partitionBy("race_date").orderBy(F.col("venue_code").cast("int")))
    bound = bindings.filter("status = 'BOUND'").withColumn("_place", place).withColumn("_size", F.octet_length("binding_sha256").cast("long"))
    return lineage.collection_digest(bound, ["race_date"], "_place", "binding_sha256", "_size")


DEADLINE_FIELDS = ("contract_version", "source_name", "source_authority", "source_locator", "source_timezone", "request_started_at", "fetched_at", "http_status", "response_headers", "raw_source_sha256", "race_date", "venue_code", "race_deadlines")
_RACE_FIELDS = ("race_no", "deadline_kind", "scheduled_deadline_at")
_DEADLINE = "contract_version string, source_name string, source_authority string, source_locator string, source_timezone string, request_started_at string, fetched_at string, http_status int, raw_source_sha256 string, race_date string, venue_code string, race_deadlines array<struct<race_no:int,deadline_kind:string,scheduled_deadline_at:string>>"


def read_deadlines(documents: DataFrame) -> DataFrame:
    """Deadline evidence from its JSON (document, and sha256 of the raw source where it is known) as rows for deadline_rules(): the field sets are compared with the exact ones, times must have an offset."""
    d = documents.select("*", F.from_json("document", _DEADLINE).alias("m"))
    races = F.from_json(F.get_json_object("document", "$.race_deadlines"), "array<string>")
    inner = F.coalesce(F.forall(races, lambda r: F.array_sort(F.json_object_keys(r)) == F.array(*[F.lit(f) for f in sorted(_RACE_FIELDS)])), F.lit(False))
    exact = F.coalesce(F.array_sort(F.json_object_keys("document")) == F.array(*[F.lit(f) for f in sorted(DEADLINE_FIELDS)]), F.lit(False)) & inner
    texts = [F.coalesce(F.trim(f"m.{c}"), F.lit("")) != "" for c in ("contract_version", "source_name", "source_authority", "source_locator", "source_timezone")]
    given = texts[0]
    for t in texts[1:]:
        given = given & t
    raw = F.lower("sha256") if "sha256" in documents.columns else F.lower("m.raw_source_sha256")
    deadlines = F.transform("m.race_deadlines", lambda x: F.struct(x["race_no"].alias("race_no"), x["deadline_kind"].alias("deadline_kind"), pit.aware(x["scheduled_deadline_at"]).alias("deadline_at")))
    return d.select(
        "m.race_date", "m.venue_code", (exact & given).alias("fields_exact"), pit.aware(F.col("m.request_started_at")).alias("request_started_at"), pit.aware(F.col("m.fetched_at")).alias("fetched_at"), F.col("m.http_status").alias("status_code"),
        F.lower("m.raw_source_sha256").alias("raw_source_sha256"), raw.alias("actual_sha256"), deadlines.alias("deadlines"),
    )


def deadline_rules(evidence: DataFrame, rows: int | None = None) -> DataFrame:
    """Per venue-day of (race_date, venue_code, fields_exact, request_started_at, fetched_at, status_code, raw_source_sha256, actual_sha256, deadlines: array of race_no, deadline_kind, deadline_at) what is wrong: the races are not 1 to 12, once each; deadlines do not rise by 5 to 90 minutes, in race order; more than one kind; times missing, a request after its answer, a deadline not after the answer; another status than 2xx; a digest that is none or not that of the source; other fields. rows: those of the evidence, where they are known.

    Evidence is grouped as one row with its array of races, which is as short as a venue's day, not as a row for each race."""
    fails = lambda ok: (~F.coalesce(ok, F.lit(False))).cast("long")
    where = lambda f: F.size(F.filter("_d", f)).cast("long")
    # evidence without races counts as one of nothing
    none = F.array(F.lit(None).cast(evidence.schema["deadlines"].dataType.elementType))
    sent = evidence.withColumn("_d", F.when(F.size("deadlines") > 0, F.col("deadlines")).otherwise(none)).select(
        *VENUE, F.transform("_d", lambda x: F.struct(x["race_no"].alias("no"), F.unix_seconds(x["deadline_at"]).alias("at"), x["deadline_kind"].alias("kind"), x.isNotNull().alias("there"))).alias("_d"),
        where(lambda x: x.isNotNull() & x["deadline_at"].isNull()).alias("_timeless"), where(lambda x: F.coalesce(x["deadline_at"] <= F.col("fetched_at"), F.lit(False))).alias("_after"), fails(F.col("fetched_at").isNotNull() & F.col("request_started_at").isNotNull()).alias("_untimed"),
        fails(F.col("request_started_at").isNull() | F.col("fetched_at").isNull() | (F.col("request_started_at") <= F.col("fetched_at"))).alias("_late"), fails(F.col("status_code").between(200, 299)).alias("_status"),
        fails(F.col("raw_source_sha256").rlike("^[0-9a-f]{64}$") & (F.col("raw_source_sha256") == F.col("actual_sha256"))).alias("_digest"), fails(F.col("fields_exact")).alias("_fields"),
    )
    g = dealing.dealt(sent, VENUE, rows).groupBy(*VENUE).agg(
        F.array_sort(F.flatten(F.collect_list("_d"))).alias("_d"), (F.sum("_timeless") + F.max("_untimed")).alias("bad_times"), F.max("_late").alias("started_late"), F.sum("_after").alias("after_deadline"), F.max("_status").alias("bad_status"), F.max("_digest").alias("bad_digest"), F.max("_fields").alias("fields")
    )
    # sorted by race, null first: the races there, and the minutes from each to the next
    numbers = F.transform(F.filter("_d", lambda x: x["there"]), lambda x: x["no"])
    known = F.filter(F.array_distinct(numbers), lambda x: x.isNotNull())
    whole = (F.size(numbers) == 12) & (F.size(known) == 12) & (F.array_min(known) == 1) & (F.array_max(known) == 12)
    gaps = F.zip_with(F.slice("_d", 2, F.size("_d")), F.slice("_d", 1, F.size("_d") - 1), lambda x, up: (x["at"] - up["at"]) / 60)
    kinds = F.size(F.array_distinct(F.transform("_d", lambda x: F.struct(x["kind"]))))
    g = g.select(
        *VENUE, fails(whole).alias("races"), F.size(F.filter(gaps, lambda x: ~x.between(5, 90))).cast("long").alias("gaps"), (kinds != 1).cast("long").alias("kinds"), "bad_times", "started_late", "after_deadline", "bad_status", "bad_digest", "fields",
    )
    return checks.gate(g, g.columns[2:])


def collect_deadlines(evidence: DataFrame, expected: DataFrame) -> DataFrame:
    """Per date: the venues expected (race_date, venue_code) that have sound evidence, those missing and those unexpected, in numeric order, and a digest over the sound ones' digests and sizes (column bytes) in venue order."""
    sound = deadline_rules(evidence).filter("status = 'SUCCESS'").select(VENUE)
    place = F.row_number().over(Window.partitionBy("race_date").orderBy(F.col("venue_code").cast("int")))
    kept = evidence.join(sound, VENUE, "left_semi").withColumn("_place", place)
    digests = lineage.collection_digest(kept.withColumn("_bytes", F.col("bytes") if "bytes" in evidence.columns else F.octet_length("raw_source_sha256").cast("long")), ["race_date"], "_place", "raw_source_sha256", "_bytes")
    return reconcile.inventory(expected, sound, VENUE, ["race_date"], F.col("venue_code").cast("int")).join(digests, "race_date", "left")


def _row_checks(df: DataFrame, keys: Sequence[str], as_of: str, fetched: str, fixed: Mapping[str, str], ranges: Mapping[str, tuple[float, float]], integers: Sequence[str], texts: Mapping[str, Column], provenance: Sequence[str], same_times: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """The checks of certify() that a row decides alone, as sums."""
    n, no = checks.count_where, lambda ok: ~F.coalesce(ok, F.lit(False))
    total = lambda parts: sum(parts, F.lit(0)).cast("long")
    time = lambda c: F.col(c) if dict(df.dtypes)[c].startswith("timestamp") else pit.aware(F.col(c))
    return {
        "null_keys": total(n(F.col(k).isNull()) for k in keys), "late_rows": n(no(pit.eligibility(time(fetched), time(as_of)) == pit.BY_AS_OF)), "fixed_values": total(n(~F.col(c).eqNullSafe(F.lit(v))) for c, v in fixed.items()),
        "out_of_range": total(n(no(checks.between(c, low, high))) for c, (low, high) in ranges.items()), "not_integral": total(n(no(checks.integral(c))) for c in integers), "bad_text": total(n(no(ok)) for ok in texts.values()),
        "null_provenance": total(n(F.col(c).isNull()) for c in provenance), "invalid_times": total(n(F.col(c).isNotNull() & time(c).isNull()) for c in (as_of, fetched)), "times_apart": total(n(~time(a).eqNullSafe(time(b))) for a, b in same_times),
    }


def certify(
    df: DataFrame, contract: T.StructType, keys: Sequence[str], forbidden: Sequence[str], as_of: str, fetched: str, fixed: Mapping[str, str] | None = None, one_value: Sequence[str] = (), manifest: str | None = None, position: Sequence[str] = (),
    ranges: Mapping[str, tuple[float, float]] | None = None, integers: Sequence[str] = (), texts: Mapping[str, Column] | None = None, provenance: Sequence[str] = (), same_times: Sequence[tuple[str, str]] = (), one_digest: Sequence[str] = (), chain: DataFrame | None = None, path: str | None = None,
) -> DataFrame:
    """One row for a dataset, gated.

    Row by row: null keys, rows from after the cut-off and times that are none, columns that must hold one fixed value, ranges (column: low, high) and
    whole numbers, rules of texts (name: condition), null cells of provenance columns, pairs of times that must be equal.  By groups: repeated keys,
    race sizes, races whose boats are not 1 to 6, columns that must hold one value in a race (one_value) or on a date (one_digest), and, where `position` tells the
    stored order, rows out of key order.  Of the whole: its schema against the contract (names, order, types, nullability), forbidden columns, forbidden
    keys at any depth of its manifest (JSON), failed artifacts of its chain (a report of lineage.manifest_chain()); with the fingerprint of its schema.

    With a path the dataset is stored there, the row checks are observed while it is written, and the groups are read from what is stored, so that df itself is
    computed once."""
    n = checks.count_where
    rows = {"rows": F.count("*"), **_row_checks(df, keys, as_of, fetched, fixed or {}, ranges or {}, integers, texts or {}, provenance, same_times)}
    schema = checks.contract_report(df.limit(0), contract)
    stored = df
    if path is None:
        row = df.agg(*[c.alias(name) for name, c in rows.items()])
    else:
        seen = Observation()
        df.observe(seen, *[c.alias(name) for name, c in rows.items()]).write.mode("overwrite").parquet(path)
        row = df.sparkSession.createDataFrame([tuple(seen.get[name] for name in rows)], ", ".join(f"{name} long" for name in rows))
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
    twice = checks.dup_groups(stored, list(keys)).select(F.col("dup_rows").alias("duplicate_rows"))
    boats = F.array_sort(F.collect_set("boat_no")) == F.array(*[F.lit(i).cast("long") for i in range(1, 7)])
    races = stored.groupBy(*RACE).agg(F.count("*").alias("k"), boats.alias("b"), *[F.count_distinct(F.struct(c)).alias(f"_one_{c}") for c in one_value])
    mixed = F.lit(False)
    for c in one_value:
        mixed = mixed | (F.col(f"_one_{c}") != 1)
    races = races.agg(n(F.col("k") != 6).alias("wrong_sizes"), n(~F.col("b")).alias("wrong_boats"), n(mixed).alias("mixed_values"))
    out = row.join(twice).join(races)  # single rows
    if one_digest:
        days = stored.groupBy("race_date").agg(*[(F.count_distinct(F.struct(c)) != 1).cast("long").alias(c) for c in one_digest])
        out = out.join(days.agg(sum((F.coalesce(F.sum(c), F.lit(0)) for c in one_digest), F.lit(0)).cast("long").alias("mixed_digests")))
    if position:
        out = out.join(ordered.order_falls(stored, position, keys, VENUE).agg(F.count("*").alias("order")))
    if chain is not None:
        out = out.join(chain.agg(n(F.col("failures") != "").alias("chain")))
    out = out.join(schema.agg(F.count("*").alias("schema_differs"))).withColumn("forbidden_columns", F.lit(sum(c.strip().casefold() in forbidden for c in df.columns)))
    found = df.sparkSession.createDataFrame([(manifest,)], "document string")
    out = out.join(checks.forbidden_keys(found, [], "document").agg(F.count("*").alias("forbidden_keys")))
    out = out.withColumn("schema_sha256", F.sha2(F.lit(df.schema.json()), 256))
    groups = ["duplicate_rows", "wrong_sizes", "wrong_boats", "mixed_values", *(["mixed_digests"] if one_digest else []), *(["order"] if position else []), *(["chain"] if chain is not None else [])]
    return checks.gate(out, ["schema_differs", "forbidden_columns", "forbidden_keys", *list(rows)[1:], *groups])


def audit_model_events(events: DataFrame) -> DataFrame:
    """Per log (log_id) of (sequence, kind, model_id, event_sha256, previous_event_sha256, authorized_at, published_at, effective_at): breaks of numbering and chain, published or effective times that fall, authorization after publication or publication after effect, events after a terminal one of the same model, and repeated ids. Logs are small by contract (some events for each approved model)."""
    w, m = Window.partitionBy("log_id").orderBy("sequence"), Window.partitionBy("log_id", "model_id").orderBy("sequence")
    d = events.withColumns({
        "_rn": F.row_number().over(w), "_chain": lineage.hash_chain(events, "sequence", "event_sha256", "previous_event_sha256"), "_published": F.lag("published_at").over(w), "_effective": F.lag("effective_at").over(w), "_ended": F.coalesce(F.lag("kind").over(m).isin(*TERMINAL), F.lit(False)),
    })
    n, given = checks.count_where, lambda ok: ~F.coalesce(ok, F.lit(False))
    g = d.groupBy("log_id").agg(
        n(F.col("sequence") != F.col("_rn")).alias("numbering"), n(~F.col("_chain")).alias("chain"), n(F.col("published_at") < F.col("_published")).alias("published_order"), n(F.col("effective_at") < F.col("_effective")).alias("effective_order"),
        n(given(F.col("authorized_at") <= F.col("published_at"))).alias("authorized_late"), n(given(F.col("published_at") <= F.col("effective_at"))).alias("effective_early"), n(F.col("_ended")).alias("after_end"), (F.count("*") - F.count_distinct("event_sha256")).alias("repeated_ids"),
    )
    return checks.gate(g, g.columns[1:])


def model_states(events: DataFrame, at: Column | None = None) -> DataFrame:
    """The state of each model of a log, its last event (in effect by `at`): log_id, model_id, kind, sequence."""
    d = events if at is None else events.filter(F.col("effective_at") <= at)
    return d.groupBy("log_id", "model_id").agg(F.max_by("kind", "sequence").alias("kind"), F.max("sequence").alias("sequence"))
