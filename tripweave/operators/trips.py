"""Trip consolidation: candidates from four handlers folded per natural key.

``trip_candidates`` (O7, P13, P14): one row per transport reported by a
driving-insights payload, a context event, a timeline event or an activity;
provisional and id-less transports are dropped.

``fold_trips`` (U1): one row per (user_id, canonical_id).
* policy ``"reference"`` - first writer wins for the creation columns even
  when its value is NULL; last writer wins for the update columns, NULL
  overwrites (the two MERGE branches of the reference).
* policy ``"enrich"`` - first / last *non-null* value per column.

Order of writers is (landing id, array position) as one decimal; a landing id
names one row.  The reference fold aggregates only the first and the last
order of a trip (fixed-width buffers, hash aggregate with a map-side phase) and
joins the winners back by (trip, order), so waypoints and tags never enter an
aggregate and a hot trip never meets in one task.  The fold is associative, so
an incremental refold of (previous trips + new candidates) gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions import format_ts, narrow, nonblank, nonempty, truthy
from tripweave.operators.handlers import activity_is_trip, detail_id, trip_key

FIRST_COLS = ("first_seen_from", "start_time", "start_time_epoch", "transport_tags", "waypoints",
              "creating_source_event_id", "created_at")
LAST_COLS = ("last_update_time", "last_update_time_epoch", "end_time", "end_time_epoch",
             "duration_in_seconds", "distance_meters", "transport_mode", "occupant_role",
             "last_updated_by_source_event_id", "updated_at")


TRIP_TYPES = (S.DRIVING_INSIGHTS, *S.CONTEXT_TYPES, *S.TIMELINE_TYPES, S.ACTIVITY)
#: nested columns: they never enter an aggregate's buffer
NESTED_COLS = ("transport_tags", "waypoints")


def _is_transport(e: Column) -> Column:
    """type == IN_TRANSPORT or a non-empty transport mode."""
    return F.coalesce(e["type"] == "IN_TRANSPORT", F.lit(False)) | nonblank(e["transportMode"]).isNotNull()


def trip_candidates(acc: DataFrame) -> DataFrame:
    """One row per reported transport, from one pass over the accepted rows; payloads typed without waypoints give none."""
    rows = acc.filter(F.col("tipo").isin(*TRIP_TYPES))
    event_type = acc.schema["p_timeline"].dataType.elementType
    a = F.col("p_activity")
    # activity has no transport id: the source event id stands in, prefixed
    # with its origin so it cannot collide with a real id (divergence D21)
    known = {"id": F.concat(F.lit("activity:"), F.col("id").cast("string")),
             "startTime": a["startTime"], "transportMode": a["tripType"], "isProvisional": F.lit(False)}
    activity_ev = F.struct(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in event_type])
    insight, activity = F.col("tipo") == S.DRIVING_INSIGHTS, F.col("tipo") == S.ACTIVITY
    context = F.col("tipo").isin(*S.CONTEXT_TYPES)
    found = (F.when(insight, F.array(F.col("p_insight.transportEvent")))
             .when(context, F.col("p_context.ctx.events"))
             .when(activity, F.filter(F.array(activity_ev), lambda _: activity_is_trip()))
             .otherwise(F.col("p_timeline")))
    origin = (F.when(insight, "DRIVING_INSIGHTS").when(context, "CONTEXT").when(activity, "ACTIVITY")
              .otherwise("TIMELINE"))
    events = rows.select("id", "user_id", "created_at", origin.alias("origin"), F.posexplode(found).alias("pos", "ev"))
    ev = F.col("ev")
    whole = F.col("origin").isin("DRIVING_INSIGHTS", "ACTIVITY")
    # Provisional or id-less transports never reach the trip table
    kept = events.filter((whole | _is_transport(ev)) & ~truthy(ev["isProvisional"]) & nonblank(ev["id"]).isNotNull())
    return kept.select(
        "user_id",
        nonblank(ev["id"]).alias("canonical_id"),
        detail_id().alias("ord"),
        F.col("origin").alias("first_seen_from"),
        format_ts(ev["startTime"]).alias("start_time"),
        ev["startTimeEpoch"].alias("start_time_epoch"),
        nonempty(ev["transportTags"]).alias("transport_tags"),
        *[nonempty(ev["waypoints"]).alias("waypoints")] * ("waypoints" in event_type.names),
        F.col("id").alias("creating_source_event_id"),
        F.col("created_at").alias("created_at"),
        format_ts(ev["lastUpdateTime"]).alias("last_update_time"),
        ev["lastUpdateTimeEpoch"].alias("last_update_time_epoch"),
        format_ts(ev["endTime"]).alias("end_time"),
        ev["endTimeEpoch"].alias("end_time_epoch"),
        narrow(ev["durationInSeconds"], S.DEC_SECONDS).alias("duration_in_seconds"),
        narrow(ev["distance"], S.DEC_METRES).alias("distance_meters"),
        ev["transportMode"].alias("transport_mode"),
        ev["occupantRole"].alias("occupant_role"),
        F.col("id").alias("last_updated_by_source_event_id"),
        F.col("created_at").alias("updated_at"),
    )


def columns_of(cands: DataFrame, columns: tuple[str, ...] | None) -> list[str]:
    """The candidates' key and order with the named columns of a writer (all, if none are named)."""
    return cands.columns if columns is None else ["user_id", "canonical_id", "ord", *columns]


def current_transports(acc: DataFrame) -> DataFrame:
    """(user_id, canonical_id) of the final transports that a CURRENT_EVENT context payload reports."""
    rows = acc.filter(F.col("tipo").isin(*S.CONTEXT_TYPES)
                      & F.array_contains(F.col("p_context.criteria"), "CURRENT_EVENT"))
    events = rows.select("user_id", F.explode(F.col("p_context.ctx.events")).alias("ev"))
    ev = F.col("ev")
    return events.filter(_is_transport(ev) & ~truthy(ev["isProvisional"])).select(
        "user_id", nonblank(ev["id"]).alias("canonical_id")).filter("canonical_id IS NOT NULL")


def _at(keys: DataFrame, rows: DataFrame, order: str, cols: list[str], at: str) -> DataFrame:
    """``keys`` + ``cols`` of the row of the same trip whose ``order`` equals ``at``.

    The order is part of the join key, so the rows of a hot trip spread over all tasks.
    """
    w = rows.select(F.col("user_id").alias("_u"), F.col("canonical_id").alias("_c"), F.col(order).alias("_o"), *cols)
    on = F.col("user_id").eqNullSafe(F.col("_u")) & (F.col("canonical_id") == F.col("_c")) & (F.col(at) == F.col("_o"))
    return keys.join(w, on, "left").drop("_u", "_c", "_o")


def fold_trips(cands: DataFrame, policy: str = "reference") -> DataFrame:
    """One row per (user_id, canonical_id)."""
    return refold(None, cands, policy)


def refold(previous: DataFrame | None, cands: DataFrame, policy: str = "reference") -> DataFrame:
    """Incremental U1: fold new candidates into an existing trip table.

    A stored trip row stands for its first writer at ``first_ord`` and for its
    last writer at ``last_ord``, so the result equals a full fold over all
    candidates ever seen.  ``n_writers`` is summed.
    """
    key = ["user_id", "canonical_id"]
    rows = cands.select(*key, F.col("ord").alias("first_ord"), F.col("ord").alias("last_ord"),
                        F.lit(1).cast("bigint").alias("n_writers"), *[c for c in (*FIRST_COLS, *LAST_COLS) if c in cands.columns])
    if previous is not None:
        rows = rows.unionByName(previous.select(*rows.columns))
    return merge_trips(rows, policy)


def merge_trips(rows: DataFrame, policy: str = "reference") -> DataFrame:
    """One row per trip from trip rows that each stand for some of its writers, in any number of parts.

    The trips have the columns that ``rows`` has.
    """
    key = ["user_id", "canonical_id"]
    first_cols, last_cols = ([c for c in cols if c in rows.columns] for cols in (FIRST_COLS, LAST_COLS))
    ends = [F.min("first_ord").alias("first_ord"), F.max("last_ord").alias("last_ord"),
            F.sum("n_writers").alias("n_writers")]
    if policy == "reference":
        folded = rows.groupBy(*key).agg(*ends)
        folded = _at(folded, rows, "first_ord", first_cols, "first_ord")
        folded = _at(folded, rows, "last_ord", last_cols, "last_ord")
    elif policy == "enrich":
        def order(c: str, o: str) -> Column:
            return F.when(F.col(c).isNotNull(), F.col(o))
        folded = rows.groupBy(*key).agg(
            *ends, *[F.min_by(c, order(c, "first_ord")).alias(c) for c in first_cols if c not in NESTED_COLS],
            *[F.max_by(c, order(c, "last_ord")).alias(c) for c in last_cols],
            *[F.min(order(c, "first_ord")).alias(f"_at_{c}") for c in NESTED_COLS if c in first_cols])
        for c in [c for c in NESTED_COLS if c in first_cols]:
            folded = _at(folded, rows, "first_ord", [c], f"_at_{c}")
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return folded.select(
        trip_key(F.col("user_id"), F.col("canonical_id")).alias("trip_id"),
        *key, *first_cols, *last_cols,
        F.lit(False).alias("is_provisional"),
        "first_ord", "last_ord", "n_writers",
    )


def trip_lookup(insights: DataFrame, trips: DataFrame) -> DataFrame:
    """Insight rows joined to their consolidated trip (left, by trip_id).

    Provisional insights have a NULL trip_id and keep NULL trip columns.
    """
    t = trips.select("trip_id", F.col("first_seen_from").alias("trip_first_seen_from"),
                     F.col("start_time").alias("trip_start_time"), F.col("end_time").alias("trip_end_time"),
                     F.col("transport_mode").alias("trip_transport_mode"), F.col("n_writers").alias("trip_writers"))
    return insights.join(t, "trip_id", "left")
