"""Typed shapes of the landing queue, the payloads and the routing table.

Payload shapes are Spark DDL strings used with ``try_variant_get`` so that a
missing key, an explicit ``null`` and a wrong-typed value all become NULL
instead of failing the row.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Landing queue
# ---------------------------------------------------------------------------
LANDING = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("tipo", T.StringType(), True),
        T.StructField("json", T.StringType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
        T.StructField("app_version", T.StringType(), True),
    ]
)

# ---------------------------------------------------------------------------
# Payload type names and routing (fixed values of the upstream SDK contract)
# ---------------------------------------------------------------------------
DRIVING_INSIGHTS = "DrivingInsights"
HARSH = "DrivingInsightsHarshEvents"
PHONE = "DrivingInsightsPhoneEvents"
CALL = "DrivingInsightsCallEvents"
SPEEDING = "DrivingInsightsSpeedingEvents"
WRONG_WAY = "DrivingInsightsWrongWayDrivingEvents"
CONTEXT_LISTENER = "UserContextUpdate"
CONTEXT_MANUAL = "requestUserContext"
TIMELINE = "TimelineEvents"
TIMELINE_UPDATE = "TimelineUpdate"
CRASH = "VehicleCrash"
STATUS = "SDKStatus"
METADATA = "UserMetadata"
TECHNICAL = "TechnicalEvent"
ACTIVITY = "UserActivity"

# type -> handler name; 15 routed types, 13 handlers
ROUTES = {
    DRIVING_INSIGHTS: "driving_insights",
    HARSH: "harsh_events",
    PHONE: "phone_events",
    CALL: "call_events",
    SPEEDING: "speeding_events",
    WRONG_WAY: "wrong_way_events",
    CONTEXT_LISTENER: "user_context",
    CONTEXT_MANUAL: "user_context",
    TIMELINE: "timeline_events",
    TIMELINE_UPDATE: "timeline_events",
    CRASH: "crash_event",
    STATUS: "sdk_status",
    METADATA: "metadata",
    TECHNICAL: "technical_event",
    ACTIVITY: "activity",
}
ROUTED_TYPES = tuple(ROUTES)
CHILD_TYPES = (HARSH, PHONE, CALL, SPEEDING, WRONG_WAY)
CONTEXT_TYPES = (CONTEXT_LISTENER, CONTEXT_MANUAL)
TIMELINE_TYPES = (TIMELINE, TIMELINE_UPDATE)

# child type -> short kind used in table names
CHILD_KIND = {
    HARSH: "harsh",
    PHONE: "phone",
    CALL: "call",
    SPEEDING: "speeding",
    WRONG_WAY: "wrong_way",
}

# Status codes of the landing_status table (divergence D1: explicit enum)
PROCESSED = "PROCESSED"
FAILED = "FAILED"
PENDING = "PENDING"
#: a child whose parent did not come in its time to live (the drain's own status, T8)
EXPIRED = "EXPIRED"

# ---------------------------------------------------------------------------
# Nested payload blocks
# ---------------------------------------------------------------------------
WAYPOINT = (
    "struct<latitude:double,longitude:double,accuracy:double,timestamp:bigint,"
    "speedInMps:double,speedLimitInMps:double,hasUnlimitedSpeedLimit:boolean,"
    "isSpeedLimitInfoSet:boolean,isSynthetic:boolean>"
)
GEO = "struct<latitude:double,longitude:double,accuracy:double>"
CRASH_GEO = "struct<latitude:double,longitude:double,accuracy:double,altitude:double>"
VENUE = f"struct<location:{GEO},significance:string,type:string>"

# Transport / timeline event.  Flags are cast to boolean ("false" -> false,
# divergence D29); a value that does not cast reads as NULL, then false.
EVENT = (
    "struct<id:string,type:string,startTime:string,startTimeEpoch:bigint,"
    "lastUpdateTime:string,lastUpdateTimeEpoch:bigint,endTime:string,endTimeEpoch:bigint,"
    "durationInSeconds:double,isProvisional:boolean,transportMode:string,distance:double,"
    f"occupantRole:string,transportTags:map<string,string>,waypoints:array<{WAYPOINT}>,"
    f"location:{GEO},venue:{VENUE}>"
)
# The same without its waypoints, and without its venue too.
EVENT_BARE = EVENT.replace(f"waypoints:array<{WAYPOINT}>,", "")
EVENT_PLAIN = EVENT_BARE.replace(f",venue:{VENUE}", "")

SAFETY_SCORES = (
    "struct<smoothScore:double,focusScore:double,legalScore:double,callWhileMovingScore:double,"
    "overallScore:double,harshBrakingScore:double,harshTurningScore:double,"
    "harshAccelerationScore:double,wrongWayDrivingScore:double,attentionScore:double>"
)
SCORE_FIELDS = (
    ("smoothScore", "smooth_score"),
    ("focusScore", "focus_score"),
    ("legalScore", "legal_score"),
    ("callWhileMovingScore", "call_while_moving_score"),
    ("overallScore", "overall_score"),
    ("harshBrakingScore", "harsh_braking_score"),
    ("harshTurningScore", "harsh_turning_score"),
    ("harshAccelerationScore", "harsh_acceleration_score"),
    ("wrongWayDrivingScore", "wrong_way_driving_score"),
    ("attentionScore", "attention_score"),
)

# One child-event shape carrying the union of the five subtype fields.
CHILD_EVENT = (
    "struct<startTime:string,startTimeEpoch:bigint,endTime:string,endTimeEpoch:bigint,"
    f"waypoints:array<{WAYPOINT}>,magnitude:double,confidence:double,type:string,"
    "callState:string,minTraveledSpeedMps:double,minTraveledSpeedInMps:double,"
    "maxTraveledSpeedMps:double,maxTraveledSpeedInMps:double,handsFreeState:string>"
)
CHILD_EVENT_BARE = CHILD_EVENT.replace(f"waypoints:array<{WAYPOINT}>,", "")

SEGMENT = (
    "struct<id:string,category:string,subcategory:string,type:string,startTime:string,"
    "startTimeEpoch:bigint,endTime:string,endTimeEpoch:bigint,"
    "attributes:array<struct<name:string,value:double>>>"
)
CONTEXT = (
    f"struct<semanticTime:string,lastKnownLocation:{GEO},home:{VENUE},work:{VENUE},"
    f"activeSegments:array<{SEGMENT}>,events:array<{EVENT}>>"
)
CONTEXT_BARE = CONTEXT.replace(EVENT, EVENT_BARE)

CRASH_PAYLOAD = (
    f"struct<time:bigint,location:{CRASH_GEO},magnitude:double,speedAtImpact:double,"
    f"deltaV:double,confidence:double,severity:string,detectorMode:string,"
    f"precedingLocations:array<{CRASH_GEO}>>"
)
STATUS_PAYLOAD = (
    "struct<startStatus:string,detectionStatus:string,locationPermission:string,"
    "isPreciseLocationPermGranted:boolean,isLocationAvailable:boolean,"
    "wifiQuotaStatus:string,mobileQuotaStatus:string,diskQuotaStatus:string,canDetect:boolean>"
)
ACTIVITY_PAYLOAD = (
    f"struct<activityType:string,tripType:string,startTime:string,stationaryLocation:{GEO},"
    f"type:string,tripInfo:struct<type:string>,stationaryInfo:struct<location:{GEO}>>"
)
TECHNICAL_PAYLOAD = "struct<type:string,message:string>"

# Declared precision of narrowed numeric columns (T-SQL NUMERIC(p,s)).
DEC_SCORE = "decimal(4,3)"
DEC_CONFIDENCE = "decimal(6,3)"  # widened from (5,3), divergence D8
DEC_MAGNITUDE = "decimal(6,3)"
DEC_SPEED = "decimal(7,2)"
DEC_SECONDS = "decimal(10,0)"
DEC_ALTITUDE = "decimal(10,2)"
DEC_METRES = "decimal(12,2)"
DEC_ATTRIBUTE = "decimal(18,4)"
DEC_LAT = "decimal(10,8)"
DEC_LON = "decimal(11,8)"

# Narrowed fields of a location: the same list builds the columns and the overflow test.
GEO_FIELDS = (("latitude", DEC_LAT), ("longitude", DEC_LON), ("accuracy", DEC_METRES))
CRASH_GEO_FIELDS = (*GEO_FIELDS, ("altitude", DEC_ALTITUDE))

# Reasons that fail a child payload whether or not its parent is there.
EARLY_REASONS = ("malformed_json", "wrong_shape", "missing_transport_id")

# Types whose equal payloads are legitimate repeated snapshots, so payload
# dedup is off for them (divergence D11).
SNAPSHOT_TYPES = (STATUS, METADATA, TECHNICAL, CONTEXT_MANUAL)
