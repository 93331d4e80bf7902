"""Payloads against the rows made of them, leaf by leaf, for every routed type.

A payload is flattened to (path, value) at any depth; a table's columns are
named by the payload paths that they come from, nested ones flattened alike.
Both sides are counted per (payload, path, value), so order doesn't matter and
repeats do; a leaf without its like on the other side is missing in the table
or extra there.  Values compare as text: numbers at six places, booleans as
true and false, wall clocks as the ISO text that they were read from.  Explicit
nulls are missing fields on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave import schemas as S
from tripweave.functions import iso_ms
from tripweave.operators.trees import leaves, number_text

_PLACE = (("location.latitude", "latitude"), ("location.longitude", "longitude"), ("location.accuracy", "accuracy"))
_TIMES = (("startTime", "start_time"), ("startTimeEpoch", "start_time_epoch"), ("endTime", "end_time"), ("endTimeEpoch", "end_time_epoch"))
_EVENT = (
    ("id", "event_id"), ("type", "event_type"), *_TIMES, ("lastUpdateTime", "last_update_time"),
    ("lastUpdateTimeEpoch", "last_update_time_epoch"), ("durationInSeconds", "duration_in_seconds"), ("isProvisional", "is_provisional"),
    ("transportMode", "transport_mode"), ("distance", "distance_meters"), ("occupantRole", "occupant_role"), ("transportTags", "transport_tags"),
    ("location.latitude", "location_latitude"), ("location.longitude", "location_longitude"), ("location.accuracy", "location_accuracy"),
    ("venue.significance", "venue_significance"), ("venue.type", "venue_type"))
_CHILD = {
    "harsh": (("magnitude", "magnitude"), ("confidence", "confidence"), ("type", "harsh_type")),
    "phone": (("callState", "call_state"),),
    "call": (("minTraveledSpeedMps", "min_traveled_speed_mps"), ("maxTraveledSpeedMps", "max_traveled_speed_mps"), ("handsFreeState", "hands_free_state")),
    "speeding": (), "wrong_way": (),
}
#: table -> (column with the landing id, path before its columns, (payload path, column) ...); fixed values of the payload contract
COLUMNS: dict[str, tuple[str, str, tuple[tuple[str, str], ...]]] = {
    "insight_trip": ("source_event_id", "", (
        ("transportEvent.id", "canonical_id"), ("transportEvent.isProvisional", "is_provisional"), ("transportEvent.distance", "distance_meters"),
        ("transportEvent.occupantRole", "occupant_role"), ("transportEvent.transportTags", "transport_tags"),
        *((f"safetyScores.{src}", dst) for src, dst in S.SCORE_FIELDS))),
    **{f"insight_{kind}": ("source_event_id", "events[].", (*_TIMES, *own, ("waypoints", "waypoints"))) for kind, own in _CHILD.items()},
    "context_header": ("source_event_id", "", (
        ("semanticTime", "semantic_time"), ("lastKnownLocation.latitude", "last_known_latitude"),
        ("lastKnownLocation.longitude", "last_known_longitude"), ("lastKnownLocation.accuracy", "last_known_accuracy"))),
    "context_criteria": ("context_id", "", (("criteria[]", "criteria_code"),)),
    "context_home": ("context_id", "home.", (("significance", "significance"), ("type", "venue_type"), *_PLACE)),
    "context_work": ("context_id", "work.", (("significance", "significance"), ("type", "venue_type"), *_PLACE)),
    "context_segment": ("context_id", "activeSegments[].", (
        ("id", "segment_id"), ("category", "category"), ("subcategory", "subcategory"), ("type", "segment_type"), *_TIMES)),
    "context_segment_attribute": ("context_id", "activeSegments[].attributes[].", (("name", "attribute_name"), ("value", "attribute_value"))),
    "context_event": ("context_id", "events[].", _EVENT),
    "timeline_event": ("source_event_id", "events[].", _EVENT),
    "user_metadata": ("metadata_id", "", (("label", "label"), ("value", "value"))),
    "crash_event": ("source_event_id", "", (
        ("time", "crash_time_epoch"), *_PLACE, ("location.altitude", "altitude"), ("magnitude", "magnitude"), ("speedAtImpact", "speed_at_impact"),
        ("deltaV", "delta_v"), ("confidence", "confidence"), ("severity", "severity"), ("detectorMode", "detector_mode"),
        ("precedingLocations", "preceding_locations"))),
    "sdk_status": ("source_event_id", "", (
        ("startStatus", "start_status"), ("detectionStatus", "detection_status"), ("locationPermission", "location_permission"),
        ("isPreciseLocationPermGranted", "precise_location_granted"), ("isLocationAvailable", "is_location_available"),
        ("wifiQuotaStatus", "quota_status_wifi"), ("mobileQuotaStatus", "quota_status_mobile"), ("diskQuotaStatus", "quota_status_disk"),
        ("canDetect", "can_detect"))),
    "user_activity": ("source_event_id", "", (
        ("activityType", "activity_type"), ("tripType", "trip_type"), ("stationaryLocation.latitude", "stationary_latitude"),
        ("stationaryLocation.longitude", "stationary_longitude"))),
    "technical_event": ("source_event_id", "", (("type", "technical_event_type"), ("message", "message"))),
}
#: Levels of a nested column: a list of flat objects, or a map.
_NESTED = 3


def payload_leaves(rows: DataFrame) -> DataFrame:
    """(id, path, value) of the payloads' leaves; both shapes of a timeline, and a context with or without its wrapper, have the same paths."""
    found = rows.select("id", "tipo", F.explode(F.filter(leaves(F.expr("try_parse_json(json)")), lambda x: x["value"].isNotNull())).alias("x"))
    path = F.when(F.col("tipo").isin(*S.TIMELINE_TYPES), F.regexp_replace("x.path", r"^\[\]", "events[]")).when(
        F.col("tipo") == S.CONTEXT_LISTENER, F.regexp_replace("x.path", r"^userContext\.", "")).otherwise(F.col("x.path"))
    return found.select("id", path.alias("path"), F.col("x.value").alias("value"))


def _text(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        return number_text(c)
    return iso_ms(c) if isinstance(kind, T.TimestampNTZType) else c.cast("string")


def _column_leaves(df: DataFrame, path: str, name: str) -> Column:
    """Array of (path, value) of one column."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.array(F.struct(F.lit(path).alias("path"), _text(F.col(name), kind).alias("value")))
    inner = F.filter(leaves(F.to_variant_object(F.col(name)), _NESTED), lambda x: x["value"].isNotNull())
    below = F.transform(inner, lambda x: F.struct(
        F.concat(F.when(x["path"].startswith("["), F.lit(path)).otherwise(F.lit(f"{path}.")), x["path"]).alias("path"), x["value"].alias("value")))
    return F.coalesce(below, F.array().cast("array<struct<path:string,value:string>>"))


def table_leaves(tables: dict[str, DataFrame]) -> DataFrame:
    """(id, path, value) of the tables' rows, by landing id."""
    parts = []
    for name, df in tables.items():
        key, before, columns = COLUMNS[name]
        found = F.concat(*[_column_leaves(df, before + path, c) for path, c in columns])
        parts.append(df.select(F.col(key).alias("id"), F.inline(found)))
    return reduce(DataFrame.unionByName, parts).filter("value IS NOT NULL")


def payload_diff(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(tipo, path, n_payload, n_table, n_matched, n_missing, n_extra) over all payloads of ``rows`` and the tables made of them.

    One shuffle by payload; a table row of no known payload is extra, under a null type.
    """
    n = F.lit(1).cast("bigint")
    sides = payload_leaves(rows).select("*", n.alias("p"), F.lit(0).cast("bigint").alias("t")).unionByName(
        table_leaves(tables).select("*", F.lit(0).cast("bigint").alias("p"), n.alias("t")))
    counted = sides.repartition("id").groupBy("id", "path", "value").agg(F.sum("p").alias("p"), F.sum("t").alias("t"))
    each = counted.groupBy("id", "path").agg(F.sum("p").alias("p"), F.sum("t").alias("t"), F.sum(F.least("p", "t")).alias("m"))
    typed = each.join(rows.select("id", "tipo"), "id", "left")
    out = typed.groupBy("tipo", "path").agg(F.sum("p").alias("n_payload"), F.sum("t").alias("n_table"), F.sum("m").alias("n_matched"))
    return out.select("*", (F.col("n_payload") - F.col("n_matched")).alias("n_missing"), (F.col("n_table") - F.col("n_matched")).alias("n_extra"))
