"""Reconciliation and data-quality reports.

Reconciliation is set-based: expected row counts come from the payload
arrays of every processed landing row (A5), actual counts from the output
tables (A3), joined once on the landing id; trips are checked with one join
against the trip table.  Violations are reported, never rejected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions import labels as L
from tripweave.functions import nonblank, semver_ok, truthy
from tripweave.operators.views import expected_counts, expected_tables, table_counts


def _trip_keys(acc: DataFrame) -> DataFrame:
    """Final transports each processed payload should have put in the trip table."""
    te = F.col("p_insight.transportEvent")
    ins = acc.filter(F.col("tipo") == S.DRIVING_INSIGHTS).select(
        "id", "tipo", "user_id", nonblank(te["id"]).alias("canonical_id"), truthy(te["isProvisional"]).alias("prov"))
    evs = []
    for types, arr in ((S.CONTEXT_TYPES, "p_context.ctx.events"), (S.TIMELINE_TYPES, "p_timeline")):
        e = acc.filter(F.col("tipo").isin(*types)).select("id", "tipo", "user_id", F.explode(F.col(arr)).alias("e"))
        evs.append(e.filter(F.coalesce(F.col("e.type") == "IN_TRANSPORT", F.lit(False))
                            | nonblank(F.col("e.transportMode")).isNotNull())
                   .select("id", "tipo", "user_id", nonblank(F.col("e.id")).alias("canonical_id"),
                           truthy(F.col("e.isProvisional")).alias("prov")))
    act = acc.filter((F.col("tipo") == S.ACTIVITY) & (
        nonblank(F.col("p_activity.tripType")).isNotNull()
        | F.coalesce(F.col("p_activity.activityType") == "IN_TRANSPORT", F.lit(False)))).select(
        "id", "tipo", "user_id", F.concat(F.lit("activity:"), F.col("id").cast("string")).alias("canonical_id"),
        F.lit(False).alias("prov"))
    out = ins
    for e in evs + [act]:
        out = out.unionByName(e)
    return out


def _trip_counts(acc: DataFrame, trips: DataFrame) -> DataFrame:
    """Per payload that reports transports: final ones, those of them in the trip table, and provisional ones there."""
    t = trips.select("user_id", "canonical_id", F.lit(True).alias("in_trip"))
    found = F.coalesce(F.col("in_trip"), F.lit(False))
    return _trip_keys(acc).join(t, ["user_id", "canonical_id"], "left").groupBy("id", "tipo").agg(
        F.sum((~F.col("prov") & F.col("canonical_id").isNotNull()).cast("int")).alias("expected_trips"),
        F.sum((~F.col("prov") & found).cast("int")).alias("found_trips"),
        F.sum((F.col("prov") & found & ~F.col("canonical_id").startswith("activity:")).cast("int"))
        .alias("provisional_in_trip"))


def reconcile(acc: DataFrame, tables: dict[str, tuple[DataFrame, str]], trips: DataFrame) -> DataFrame:
    """One row per processed landing row with PASS/FAIL.

    Checks: actual detail rows == expected (R1, R2, R4, R5, R6); final
    transports present in the trip table and provisional ones absent (R3,
    user included, divergence D26).
    """
    expected = acc.select("id", "tipo", "user_id", expected_counts().alias("expected_rows"))
    actual = table_counts(tables).groupBy("landing_id").agg(F.sum("n_rows").alias("actual_rows"))
    tk = _trip_counts(acc, trips).drop("tipo")
    out = (expected.join(actual.withColumnRenamed("landing_id", "id"), "id", "left")
           .join(tk, "id", "left")
           .select("id", "tipo", "user_id", "expected_rows",
                   F.coalesce("actual_rows", F.lit(0)).cast("bigint").alias("actual_rows"),
                   F.coalesce("expected_trips", F.lit(0)).cast("bigint").alias("expected_trips"),
                   F.coalesce("found_trips", F.lit(0)).cast("bigint").alias("found_trips"),
                   F.coalesce("provisional_in_trip", F.lit(0)).cast("bigint").alias("provisional_in_trip")))
    ok = ((F.col("expected_rows") == F.col("actual_rows")) & (F.col("expected_trips") == F.col("found_trips"))
          & (F.col("provisional_in_trip") == 0))
    return out.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


#: results of a check, by rising weight
RESULTS = ("PASS", "WARN", "FAIL", "ERROR")


def reconcile_checks(resolved: DataFrame, tables: dict[str, tuple[DataFrame, str]], audit: DataFrame,
                     trips: DataFrame) -> DataFrame:
    """Named checks of every landing row, as (id, tipo, check_name, expected, actual, result).

    A processed row is checked against each table of its type (``expected_tables``)
    and for its audit row; the transports it reports by ``trip_present`` and
    ``trip_absent`` (provisional ones); a child by ``parent``, also while it waits.
    Rows that never got that far: ``validator`` (no handler for the type) and
    ``transport_id`` (a child without one) are warnings, ``payload`` (unreadable) is an error.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    acc = resolved.filter(F.col("status") == S.PROCESSED)
    audited = F.array(F.struct(F.lit("source_event").alias("table_name"), one.alias("expected")))
    expected = acc.select("id", "tipo", F.explode(F.concat(expected_tables(), audited)).alias("x")).select(
        "id", "tipo", F.col("x.table_name").alias("check_name"), "x.expected")
    actual = table_counts({**tables, "source_event": (audit, "landing_id")}).select(
        F.col("landing_id").alias("id"), F.col("table_name").alias("check_name"), F.col("n_rows").alias("actual"))
    counted = expected.join(actual, ["id", "check_name"], "left").select(
        "id", "tipo", "check_name", "expected", F.coalesce("actual", zero).alias("actual"))

    def pair(name: str, want, got) -> Column:
        return F.struct(F.lit(name).alias("check_name"), want.cast("bigint").alias("expected"), got.cast("bigint").alias("actual"))

    transports = _trip_counts(acc, trips).select("id", "tipo", F.inline(F.array(
        pair("trip_present", F.col("expected_trips"), F.col("found_trips")),
        pair("trip_absent", zero, F.col("provisional_in_trip")))))
    why, child = F.col("status_reason"), F.col("tipo").isin(*S.CHILD_TYPES)
    parents = resolved.filter(child & ((F.col("status") == S.PROCESSED) | (why == "awaiting_parent"))).select(
        "id", "tipo", F.lit("parent").alias("check_name"), one.alias("expected"),
        F.col("insight_trip_id").isNotNull().cast("bigint").alias("actual"))
    compared = counted.unionByName(transports).unionByName(parents).withColumn(
        "result", F.when(F.col("expected") == F.col("actual"), "PASS").otherwise("FAIL"))
    name = (F.when(why == "unrouted_type", "validator").when(why == "missing_transport_id", "transport_id")
            .when(F.col("status") == S.FAILED, "payload"))
    found = resolved.select("id", "tipo", name.alias("check_name"), one.alias("expected"), zero.alias("actual")).filter(
        F.col("check_name").isNotNull())
    return compared.unionByName(found.withColumn(
        "result", F.when(F.col("check_name") == "payload", "ERROR").otherwise("WARN")))


def record_status(checks: DataFrame) -> DataFrame:
    """The weightiest result of each landing row's checks."""
    weight = F.array_position(F.array(*[F.lit(r) for r in RESULTS]), F.col("result")).cast("int")
    return checks.groupBy("id", "tipo").agg(F.max(weight).alias("w")).select(
        "id", "tipo", F.element_at(F.array(*[F.lit(r) for r in RESULTS]), F.col("w")).alias("status"))


def reconcile_summary(rows: DataFrame) -> DataFrame:
    """PASS/FAIL totals per type with a basis-point share of all rows.

    The grand total is a sum over the already aggregated (type, status)
    rows - a handful of rows - so the unpartitioned window never sees the
    input rows.
    """
    per = rows.groupBy("tipo", "status").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())
    return per.select("tipo", "status", "n_rows",
                      F.floor(F.col("n_rows") * 10000 / total).cast("bigint").alias("share_bp"))


ENUM_CHECKS: list[tuple[str, str, tuple[str, ...], bool]] = [
    # (table, column, allowed values, null allowed)
    ("timeline_event", "event_type", L.EVENT_TYPES, False),
    ("timeline_event", "transport_mode", L.TRANSPORT_MODES, True),
    ("timeline_event", "occupant_role", L.OCCUPANT_ROLES, True),
    ("timeline_event", "venue_significance", L.VENUE_SIGNIFICANCES, True),
    ("trip", "transport_mode", L.TRANSPORT_MODES, False),
    ("trip", "occupant_role", L.OCCUPANT_ROLES, True),
    ("trip", "first_seen_from", L.FIRST_SEEN_FROM, False),
    ("insight_harsh", "harsh_type", L.HARSH_TYPES, False),
    ("crash_event", "severity", L.CRASH_SEVERITIES, False),
    ("crash_event", "detector_mode", L.DETECTOR_MODES, True),
    ("context_segment", "category", L.SEGMENT_CATEGORIES, False),
    ("context_criteria", "criteria_code", L.CRITERIA_CODES, False),
    ("landing", "tipo", L.LANDING_TYPES, False),
]


def enum_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Values outside the documented closed enums, reported per value."""
    parts = []
    for table, col, allowed, nullable in ENUM_CHECKS:
        if table not in tables:
            continue
        c = F.col(col)
        bad = ~c.isin(*allowed) if nullable else (c.isNull() | ~c.isin(*allowed))
        parts.append(tables[table].filter(F.coalesce(bad, F.lit(False))).groupBy(c.alias("value")).agg(
            F.count("*").alias("n_rows")).select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                                                 "value", "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The documented foreign keys as (child table, column, parent table, column, action on delete); fixed values.
#: A table that hangs on its audit row goes with it; landing rows and trips must not go while they are referenced.
FOREIGN_KEYS: tuple[tuple[str, str, str, str, str], ...] = (
    ("source_event", "landing_id", "landing", "id", "NO ACTION"),
    ("timeline_event", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("context_header", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("context_event", "context_id", "source_event", "source_event_id", "CASCADE"),
    ("context_segment", "context_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_trip", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_harsh", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_phone", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_call", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_speeding", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_wrong_way", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("crash_event", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("sdk_status", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("user_activity", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("technical_event", "source_event_id", "source_event", "source_event_id", "CASCADE"),
    ("insight_trip", "trip_id", "trip", "trip_id", "NO ACTION"),
)


def _fk_name(child: str, column: str) -> str:
    return f"{child}.{column}"


def _references(tables: dict[str, DataFrame], only: str | None = None) -> DataFrame:
    """All child keys as one table: (parent, key, fk); null keys refer to nothing."""
    parts = [tables[child].select(F.lit(parent).alias("parent"), F.col(column).alias("key"), F.lit(_fk_name(child, column)).alias("fk"))
             for child, column, parent, _, _ in FOREIGN_KEYS if only in (None, parent)]
    return reduce(DataFrame.unionByName, parts)


def _per_key(spark: SparkSession, rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """One row per foreign key, with zeros where ``rows`` (by ``fk``) have none."""
    names = [(_fk_name(c, k), a) for c, k, _, _, a in FOREIGN_KEYS]
    found = rows.groupBy("fk").agg(*[v.alias(k) for k, v in totals.items()])
    every = spark.createDataFrame(names, "fk_name string, on_delete string")
    return every.join(found, every.fk_name == found.fk, "left").select(
        "fk_name", "on_delete", *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k) for k in totals])


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Of every documented foreign key the child rows, and those whose key has no parent (null keys are no orphans).

    One tagged union of all keys and one aggregate by (parent table, key);
    partial sums per foreign key meet there, so a key with many children is
    counted before the shuffle.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    children = _references(tables).groupBy("parent", "key", "fk").agg(F.count("*").alias("n")).select("*", zero.alias("found"))
    parents = {(p, c) for _, _, p, c, _ in FOREIGN_KEYS}
    known = reduce(DataFrame.unionByName, [tables[p].select(
        F.lit(p).alias("parent"), F.col(c).alias("key"), F.lit(None).cast("string").alias("fk"), zero.alias("n"), one.alias("found"))
        for p, c in sorted(parents)])
    both = children.unionByName(known).groupBy("parent", "key").agg(
        F.max("found").alias("found"), F.map_from_entries(F.collect_list(F.when(F.col("fk").isNotNull(), F.struct("fk", "n")))).alias("counts"))
    each = both.select("key", "found", F.explode("counts").alias("fk", "n"))
    lost = F.col("key").isNotNull() & (F.col("found") == 0)
    return _per_key(tables["landing"].sparkSession, each, {
        "n_rows": F.sum("n"), "n_orphans": F.sum(F.when(lost, F.col("n")).otherwise(0))})


def cascade_plan(seeds: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """What the deletion of audit rows takes along: per foreign key the rows that go (CASCADE) and the ones that forbid it (NO ACTION).

    ``seeds`` (source_event_id).  Satellites go with their audit row; its landing
    row may only go after it; a trip may only go once none of its insights
    stays: ``n_deleted`` are the children that go, ``n_blocking`` (NO ACTION
    only) the ones that stay and hold a parent that a deleted child shares.
    """
    gone = seeds.select(F.col("source_event_id").alias("_s")).distinct()

    def marked(name: str, key: str, *cols: str) -> DataFrame:
        t = tables[name].select(F.col(key).alias("_k"), *cols)
        return t.join(gone, t._k == gone._s, "left").withColumn("goes", F.col("_s").isNotNull())

    cascade = reduce(DataFrame.unionByName, [tables[c].select(F.lit(_fk_name(c, k)).alias("fk"), F.col(k).alias("_k"))
                                             for c, k, p, _, _ in FOREIGN_KEYS if p == "source_event"])
    hits = cascade.join(gone, cascade._k == gone._s, "left_semi").groupBy("fk").agg(F.count("*").alias("d")).select("fk", "d", F.lit(0).alias("b"))
    audit = marked("source_event", "source_event_id", "landing_id").groupBy("landing_id").agg(
        F.sum(F.col("goes").cast("int")).alias("d"), F.sum((~F.col("goes")).cast("int")).alias("b"))
    insight = marked("insight_trip", "source_event_id", "trip_id").filter("trip_id IS NOT NULL").groupBy("trip_id").agg(
        F.sum(F.col("goes").cast("int")).alias("d"), F.sum((~F.col("goes")).cast("int")).alias("b"))
    held = audit.select(F.lit(_fk_name("source_event", "landing_id")).alias("fk"), "d", "b").unionByName(
        insight.select(F.lit(_fk_name("insight_trip", "trip_id")).alias("fk"), "d", "b")).filter("d > 0")
    return _per_key(seeds.sparkSession, hits.unionByName(held), {"n_deleted": F.sum("d"), "n_blocking": F.sum("b")})


def version_check(landing: DataFrame) -> DataFrame:
    """P25: app_version whitelist ``^\\d+\\.\\d+\\.\\d+$`` per type."""
    return landing.groupBy("tipo").agg(
        F.count("*").alias("n_rows"), F.sum((~semver_ok("app_version")).cast("int")).cast("bigint").alias("n_invalid"))


def ongoing_event_nulls(events: DataFrame) -> DataFrame:
    """An event without end time must be provisional (ongoing)."""
    return events.filter(F.col("end_time").isNull() & ~F.col("is_provisional"))


def redact_waypoints(df: DataFrame, waypoints: str = "waypoints") -> DataFrame:
    """Replace a waypoint array by its size marker."""
    return df.withColumn(f"{waypoints}_count", F.size(F.col(waypoints))).drop(waypoints)


def simplify(df: DataFrame, list_cols: list[str], k: int = 3) -> DataFrame:
    """Keep the first ``k`` elements of list columns."""
    for c in list_cols:
        df = df.withColumn(c, F.slice(F.col(c), 1, k))
    return df


def presence_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mark columns as present / absent."""
    return df.select(*[F.col(c).isNotNull().alias(f"has_{c}") for c in cols])


def case_insensitive_type(col: str, value: str) -> Column:
    """upper(type) == value."""
    return F.upper(F.col(col)) == value.upper()
