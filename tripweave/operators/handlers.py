"""Table builders for the 13 payload handlers and the unnesting generators.

Input of every builder is the *accepted* landing rows (``parse.accepted``)
carrying the typed payload columns.  Keys are deterministic (section 1.4 of
the survey): ``source_event_id`` = landing id; detail rows are keyed by
(landing id, array position), packed into one exact decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions import format_ts, narrow, nonblank, nonempty, truthy

POSITION_KEY = "decimal(32,0)"


def detail_id(pos: Column | str = "pos") -> Column:
    """``id * 10^10 + pos`` as a decimal: every BIGINT id and every array position (an INT) gets a key of its own.

    It sorts like (id, pos), and unlike a struct it may sit in the buffer of a hash aggregate.
    """
    p = F.col(pos) if isinstance(pos, str) else pos
    scale = F.lit("10000000000").cast("decimal(11,0)")
    return (F.col("id").cast("decimal(19,0)") * scale + p.cast("decimal(10,0)")).cast(POSITION_KEY)


def geo_columns(loc: Column, fields=S.GEO_FIELDS, prefix: str = "") -> list[Column]:
    return [narrow(loc[f], d).alias(prefix + f) for f, d in fields]


def trip_key(user: Column, canonical: Column) -> Column:
    """Deterministic trip id: 64-bit hash of the natural key (user, canonical id)."""
    return F.xxhash64(user, canonical)


def _of(df: DataFrame, *types: str) -> DataFrame:
    return df.filter(F.col("tipo").isin(*types))


# ---------------------------------------------------------------------------
# H1 driving insights
# ---------------------------------------------------------------------------


def insight_trip(acc: DataFrame) -> DataFrame:
    te = F.col("p_insight.transportEvent")
    sc = F.col("p_insight.safetyScores")
    provisional = truthy(te["isProvisional"])
    canonical = nonblank(te["id"])
    scores = [narrow(sc[src], S.DEC_SCORE).alias(dst) for src, dst in S.SCORE_FIELDS]
    # inline sub-event arrays of the payload are ignored on purpose
    return _of(acc, S.DRIVING_INSIGHTS).select(
        F.col("id").alias("insight_trip_id"),
        F.col("id").alias("source_event_id"),
        F.when(~provisional & canonical.isNotNull(), trip_key(F.col("user_id"), canonical)).alias("trip_id"),
        "user_id",
        te["id"].alias("canonical_id"),
        provisional.alias("is_provisional"),
        *scores,
        narrow(te["distance"], S.DEC_METRES).alias("distance_meters"),
        te["occupantRole"].alias("occupant_role"),
        nonempty(te["transportTags"]).alias("transport_tags"),
        "created_at",
    )


# ---------------------------------------------------------------------------
# H2-H6 child events (X7-X11); parent resolved by parse.guard
# ---------------------------------------------------------------------------

CHILD_FIELDS: dict[str, list[tuple[Column, str]]] = {
    S.HARSH: [
        (lambda e: narrow(e["magnitude"], S.DEC_MAGNITUDE), "magnitude"),
        (lambda e: narrow(e["confidence"], S.DEC_CONFIDENCE), "confidence"),
        (lambda e: e["type"], "harsh_type"),
    ],
    S.PHONE: [(lambda e: e["callState"], "call_state")],
    S.CALL: [
        # both key spellings are accepted (divergence D4)
        (lambda e: narrow(F.coalesce(e["minTraveledSpeedMps"], e["minTraveledSpeedInMps"]), S.DEC_SPEED),
         "min_traveled_speed_mps"),
        (lambda e: narrow(F.coalesce(e["maxTraveledSpeedMps"], e["maxTraveledSpeedInMps"]), S.DEC_SPEED),
         "max_traveled_speed_mps"),
        (lambda e: e["handsFreeState"], "hands_free_state"),
    ],
    S.SPEEDING: [],
    S.WRONG_WAY: [],
}


def child_events(acc: DataFrame, child_type: str) -> DataFrame:
    """Rows of one child kind, under the parent insight trip; payloads typed without waypoints give none."""
    rows = _of(acc, child_type).select(
        "id", "insight_trip_id", F.posexplode(F.col("p_child.events")).alias("pos", "e"))
    e = F.col("e")
    extra = [f(e).alias(name) for f, name in CHILD_FIELDS[child_type]]
    return rows.select(
        detail_id().alias("child_event_id"),
        F.col("id").alias("source_event_id"),
        "insight_trip_id",
        "pos",
        format_ts(e["startTime"]).alias("start_time"),
        e["startTimeEpoch"].alias("start_time_epoch"),
        format_ts(e["endTime"]).alias("end_time"),
        e["endTimeEpoch"].alias("end_time_epoch"),
        *extra,
        *[nonempty(e["waypoints"]).alias("waypoints")] * ("waypoints" in acc.schema["p_child"].dataType["events"].dataType.elementType.names),
    )


def child_items(acc: DataFrame, *child_types: str) -> DataFrame:
    """All events of some kinds under their parent, one row each, with the whole event object as ``item``."""
    rows = _of(acc, *child_types).select(
        "id", "tipo", "insight_trip_id", F.posexplode(F.col("p_child.events")).alias("pos", "item"))
    return rows.select(
        "insight_trip_id", "tipo", detail_id().alias("child_event_id"),
        F.col("item.type").alias("harsh_type"),
        narrow(F.col("item.magnitude"), S.DEC_MAGNITUDE).alias("magnitude"),
        narrow(F.col("item.confidence"), S.DEC_CONFIDENCE).alias("confidence"),
        "item")


# ---------------------------------------------------------------------------
# H7 user context
# ---------------------------------------------------------------------------


def _ctx(acc: DataFrame) -> DataFrame:
    return _of(acc, *S.CONTEXT_TYPES)


def context_header(acc: DataFrame) -> DataFrame:
    ctx = F.col("p_context.ctx")
    loc = ctx["lastKnownLocation"]
    return _ctx(acc).select(
        F.col("id").alias("context_id"),
        F.col("id").alias("source_event_id"),
        "user_id",
        F.col("p_context.source_type").alias("context_source_type"),
        ctx["semanticTime"].alias("semantic_time"),
        *geo_columns(loc, prefix="last_known_"),
        "created_at",
    )


def context_criteria(acc: DataFrame) -> DataFrame:
    return _ctx(acc).select(
        "id", "user_id", F.posexplode(F.col("p_context.criteria")).alias("pos", "criteria_code"),
    ).select(detail_id().alias("criteria_id"), F.col("id").alias("context_id"), "user_id", "pos", "criteria_code")


def context_place(acc: DataFrame, which: str) -> DataFrame:
    """Home / work object -> 0..1 row with a synthetic upper-case significance."""
    v = F.col(f"p_context.ctx.{which}")
    return _ctx(acc).filter(v.isNotNull()).select(
        F.col("id").alias("context_id"),
        "user_id",
        F.lit(which.upper()).alias("significance"),
        v["type"].alias("venue_type"),
        *geo_columns(v["location"]),
        "created_at",
    )


def context_segment(acc: DataFrame) -> DataFrame:
    """activeSegments[] -> rows (segment id kept as text)."""
    rows = _ctx(acc).select("id", "user_id", "created_at",
                            F.posexplode(F.col("p_context.ctx.activeSegments")).alias("pos", "s"))
    s = F.col("s")
    return rows.select(
        detail_id().alias("segment_detail_id"),
        F.col("id").alias("context_id"),
        "user_id",
        "pos",
        s["id"].alias("segment_id"),
        s["category"].alias("category"),
        s["subcategory"].alias("subcategory"),
        s["type"].alias("segment_type"),
        format_ts(s["startTime"]).alias("start_time"),
        s["startTimeEpoch"].alias("start_time_epoch"),
        format_ts(s["endTime"]).alias("end_time"),
        s["endTimeEpoch"].alias("end_time_epoch"),
        "created_at",
    )


def context_segment_attribute(acc: DataFrame) -> DataFrame:
    """Two-level unnest keyed by (landing id, segment pos, attribute pos)."""
    seg = _ctx(acc).select("id", "user_id", F.posexplode(F.col("p_context.ctx.activeSegments")).alias("pos", "s"))
    return seg.select(
        "id", "user_id", "pos", F.col("s.id").alias("segment_id"),
        F.posexplode(F.col("s.attributes")).alias("attr_pos", "a"),
    ).select(
        detail_id().alias("segment_detail_id"),
        F.col("id").alias("context_id"),
        "user_id",
        "segment_id",
        "attr_pos",
        F.col("a.name").alias("attribute_name"),
        narrow(F.col("a.value"), S.DEC_ATTRIBUTE).alias("attribute_value"),
    )


def event_columns(e: Column) -> list[Column]:
    """The 21-column event projection shared by context and timeline."""
    return [
        e["id"].alias("event_id"),
        e["type"].alias("event_type"),
        format_ts(e["startTime"]).alias("start_time"),
        e["startTimeEpoch"].alias("start_time_epoch"),
        format_ts(e["lastUpdateTime"]).alias("last_update_time"),
        e["lastUpdateTimeEpoch"].alias("last_update_time_epoch"),
        format_ts(e["endTime"]).alias("end_time"),
        e["endTimeEpoch"].alias("end_time_epoch"),
        narrow(e["durationInSeconds"], S.DEC_SECONDS).alias("duration_in_seconds"),
        truthy(e["isProvisional"]).alias("is_provisional"),
        e["transportMode"].alias("transport_mode"),
        narrow(e["distance"], S.DEC_METRES).alias("distance_meters"),
        e["occupantRole"].alias("occupant_role"),
        nonempty(e["transportTags"]).alias("transport_tags"),
        *geo_columns(e["location"], prefix="location_"),
        e["venue"]["significance"].alias("venue_significance"),
        e["venue"]["type"].alias("venue_type"),
    ]


def context_event(acc: DataFrame) -> DataFrame:
    rows = _ctx(acc).select("id", "user_id", "created_at",
                            F.posexplode(F.col("p_context.ctx.events")).alias("pos", "e"))
    return rows.select(
        detail_id().alias("event_detail_id"),
        F.col("id").alias("context_id"),
        "user_id", "pos", *event_columns(F.col("e")), "created_at",
    )


# ---------------------------------------------------------------------------
# H8 timeline
# ---------------------------------------------------------------------------


def timeline_event(acc: DataFrame) -> DataFrame:
    rows = _of(acc, *S.TIMELINE_TYPES).select(
        "id", "user_id", "created_at", F.posexplode(F.col("p_timeline")).alias("pos", "e"))
    return rows.select(
        detail_id().alias("timeline_event_id"),
        F.col("id").alias("source_event_id"),
        "user_id", "pos", *event_columns(F.col("e")), "created_at",
    )


# ---------------------------------------------------------------------------
# H9-H13 flat handlers
# ---------------------------------------------------------------------------


def user_metadata(acc: DataFrame) -> DataFrame:
    """H9: every version kept; value as Python-style text."""
    return _of(acc, S.METADATA).select(
        F.col("id").alias("metadata_id"), "user_id",
        F.col("p_metadata.label").alias("label"), F.col("p_metadata.value").alias("value"),
        F.col("created_at").alias("updated_at"),
    )


def crash_event(acc: DataFrame) -> DataFrame:
    c = F.col("p_crash")
    loc = c["location"]
    return _of(acc, S.CRASH).select(
        F.col("id").alias("crash_event_id"),
        F.col("id").alias("source_event_id"),
        "user_id",
        c["time"].alias("crash_time_epoch"),
        *geo_columns(loc, S.CRASH_GEO_FIELDS),
        narrow(c["magnitude"], S.DEC_MAGNITUDE).alias("magnitude"),
        narrow(c["speedAtImpact"], S.DEC_SPEED).alias("speed_at_impact"),
        narrow(c["deltaV"], S.DEC_SPEED).alias("delta_v"),
        narrow(c["confidence"], S.DEC_CONFIDENCE).alias("confidence"),
        c["severity"].alias("severity"),
        c["detectorMode"].alias("detector_mode"),
        nonempty(c["precedingLocations"]).alias("preceding_locations"),
        F.col("json").alias("payload_json"),
        "created_at",
    )


def sdk_status(acc: DataFrame) -> DataFrame:
    p = F.col("p_status")
    return _of(acc, S.STATUS).select(
        F.col("id").alias("sdk_status_id"),
        F.col("id").alias("source_event_id"),
        "user_id",
        p["startStatus"].alias("start_status"),
        p["detectionStatus"].alias("detection_status"),
        p["locationPermission"].alias("location_permission"),
        truthy(p["isPreciseLocationPermGranted"]).alias("precise_location_granted"),
        truthy(p["isLocationAvailable"]).alias("is_location_available"),
        p["wifiQuotaStatus"].alias("quota_status_wifi"),
        p["mobileQuotaStatus"].alias("quota_status_mobile"),
        p["diskQuotaStatus"].alias("quota_status_disk"),
        truthy(p["canDetect"]).alias("can_detect"),
        F.col("created_at").alias("captured_at"),
    )


def activity_is_trip() -> Column:
    """tripType present or activityType == IN_TRANSPORT."""
    a = F.col("p_activity")
    return nonblank(a["tripType"]).isNotNull() | F.coalesce(a["activityType"] == "IN_TRANSPORT", F.lit(False))


def user_activity(acc: DataFrame) -> DataFrame:
    a = F.col("p_activity")
    return _of(acc, S.ACTIVITY).select(
        F.col("id").alias("activity_id"),
        F.col("id").alias("source_event_id"),
        "user_id",
        a["activityType"].alias("activity_type"),
        a["tripType"].alias("trip_type"),
        *geo_columns(a["stationaryLocation"], S.GEO_FIELDS[:2], "stationary_"),
        activity_is_trip().alias("is_trip"),
        F.col("json").alias("payload_json"),  # raw text kept (divergence D28)
        F.col("created_at").alias("captured_at"),
    )


def technical_event(acc: DataFrame) -> DataFrame:
    t = F.col("p_technical")
    return _of(acc, S.TECHNICAL).select(
        F.col("id").alias("technical_event_id"),
        F.col("id").alias("source_event_id"),
        "user_id",
        t["type"].alias("technical_event_type"),
        t["message"].alias("message"),
        F.col("json").alias("payload_json"),
        F.col("created_at").alias("captured_at"),
    )


# ---------------------------------------------------------------------------
# X12-X14 second-level generators
# ---------------------------------------------------------------------------


def waypoint_points(df: DataFrame, key_cols: list[str], waypoints: str = "waypoints") -> DataFrame:
    """waypoints[] -> one row per point, ordered by ``pos``."""
    return df.select(*key_cols, F.posexplode(F.col(waypoints)).alias("point_pos", "p")).select(
        *key_cols, "point_pos",
        F.col("p.latitude").alias("latitude"), F.col("p.longitude").alias("longitude"),
        F.col("p.accuracy").alias("accuracy"), F.col("p.timestamp").alias("point_epoch"),
        F.col("p.speedInMps").alias("speed_mps"),
    )


def preceding_points(crash: DataFrame) -> DataFrame:
    """Crash preceding locations -> rows."""
    return crash.select("crash_event_id", "user_id",
                        F.posexplode(F.col("preceding_locations")).alias("point_pos", "p")).select(
        "crash_event_id", "user_id", "point_pos",
        F.col("p.latitude").alias("latitude"), F.col("p.longitude").alias("longitude"),
        F.col("p.accuracy").alias("accuracy"), F.col("p.altitude").alias("altitude"),
    )


def tag_rows(df: DataFrame, key_cols: list[str], tags: str = "transport_tags") -> DataFrame:
    """Transport tag map -> (key, value) rows."""
    return df.select(*key_cols, F.explode(F.col(tags)).alias("tag_key", "tag_value"))
