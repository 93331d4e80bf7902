"""Independent DuckDB oracle SQL over the *base tables*.

The Spark path derives JSON payloads from the base tables and parses them
back; the oracle never sees JSON.  It restates each fixture rule
(``sources/fixtures.py``) and each pipeline rule directly as relational SQL,
so agreement checks the whole parse -> normalise -> route -> guard -> fold
chain.  The fragments below are shared WITH-clause members.
"""

from __future__ import annotations

TL_BASE = 10**18
CTX_BASE = 2 * 10**18
FLAT_BASE = 3 * 10**18

# parents: one row per DrivingInsights landing row (retry copies included)
PARENTS = """
p_raw AS (
  SELECT o_orderkey AS k, o_custkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority,
         o_orderkey * 1000 + 500 AS id, o_orderdate + to_seconds(o_orderkey % 86400) AS created_at
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority,
         o_orderkey * 1000 + 900, o_orderdate + to_seconds(o_orderkey % 86400 + 60)
  FROM orders WHERE o_orderkey % 7 = 0
),
p AS (
  SELECT *, concat('c', o_custkey) AS user_id,
         CASE WHEN k % 10 = 9 THEN concat('r', k) ELSE concat('t', k) END AS canonical_id,
         k % 11 = 0 AS is_provisional,
         k % 997 = 0 AS failed,
         (k % 180 + 1) * 60 AS dur,
         CASE o_orderstatus WHEN 'F' THEN 'CAR' WHEN 'O' THEN 'MOTORCYCLE' ELSE 'BUS' END AS transport_mode,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'DRIVER' WHEN '2-HIGH' THEN 'PASSENGER'
              WHEN '3-MEDIUM' THEN 'UNAVAILABLE' WHEN '5-LOW' THEN 'LOW' END AS occupant_role,
         CASE WHEN k % 4 <> 0 THEN 2 ELSE 0 END AS n_waypoints,
         CASE WHEN o_custkey % 17 = 0 THEN '1.1.17-test' ELSE '1.4.2' END AS app_version
  FROM p_raw
)"""

# child payloads: one row per (order, kind) landing row
CHILDREN = """
c_lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate,
         CASE l_linenumber WHEN 2 THEN 'DrivingInsightsPhoneEvents' WHEN 3 THEN 'DrivingInsightsCallEvents'
              WHEN 4 THEN 'DrivingInsightsSpeedingEvents' WHEN 5 THEN 'DrivingInsightsWrongWayDrivingEvents'
              ELSE 'DrivingInsightsHarshEvents' END AS tipo,
         CASE l_linenumber WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 5 ELSE 1 END AS ordinal
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
c AS (
  SELECT l_orderkey AS k, tipo, l_orderkey * 1000 + any_value(ordinal) AS id,
         concat('c', any_value(o_custkey)) AS user_id, count(*) AS n_events,
         CASE WHEN any_value(o_custkey) % 17 = 0 THEN '1.1.17-test' ELSE '1.4.2' END AS app_version,
         any_value(o_orderdate) + to_seconds(l_orderkey % 86400 - 60) AS created_at,
         CASE WHEN tipo = 'DrivingInsightsSpeedingEvents' AND l_orderkey % 53 = 0 THEN 'FAILED'
              WHEN l_orderkey % 10 = 9 OR l_orderkey % 997 = 0 THEN 'PENDING'
              ELSE 'PROCESSED' END AS status,
         CASE WHEN tipo = 'DrivingInsightsSpeedingEvents' AND l_orderkey % 53 = 0 THEN 'missing_transport_id'
              WHEN l_orderkey % 10 = 9 OR l_orderkey % 997 = 0 THEN 'awaiting_parent' END AS reason
  FROM c_lines GROUP BY l_orderkey, tipo
)"""


_W = "user_id, CAST(ts AS DATE), event_id // 4096"


def _event_rows(name: str, base: int, keep: str) -> str:
    return f"""
{name} AS (
  SELECT e.*, concat('u', user_id) AS uid,
         {base} + min(event_id) OVER (PARTITION BY {_W}) AS payload_id,
         row_number() OVER (PARTITION BY {_W} ORDER BY event_id) - 1 AS pos,
         max(ts) OVER (PARTITION BY {_W}) AS payload_created_at,
         concat('e', event_id) AS event_key,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'IN_TRANSPORT' WHEN event_type = 'view' THEN 'STATIONARY'
              WHEN event_type = 'signup' THEN 'OFF_THE_GRID' ELSE 'UNKNOWN' END AS ev_type,
         date_trunc('millisecond', ts) AS start_time,
         (epoch_us(ts) // 1000) AS start_time_epoch,
         CAST(floor(value * 60) AS BIGINT) AS dur,
         date_trunc('millisecond', ts + to_seconds(CAST(floor(value * 60) AS BIGINT))) AS end_time,
         (epoch_us(ts + to_seconds(CAST(floor(value * 60) AS BIGINT))) // 1000) AS end_time_epoch,
         event_id % 5 = 0 AS is_provisional,
         CASE WHEN event_type = 'click' THEN 'CAR' WHEN event_type = 'purchase' THEN 'TRAIN'
              WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'WALKING' END AS transport_mode,
         CAST(value * 100 AS DECIMAL(12, 2)) AS distance_meters,
         CASE WHEN event_type = 'click' THEN 'DRIVER' WHEN event_type = 'purchase' THEN 'PASSENGER' END AS occupant_role,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         50.0 + user_id / 10000.0 AS lat, 4.0 + (event_id % 1000) / 1000.0 AS lon,
         CASE WHEN event_type = 'view' THEN CASE user_id % 3 WHEN 0 THEN 'HOME' WHEN 1 THEN 'WORK'
              ELSE 'POINT_OF_INTEREST' END END AS venue_significance,
         CASE WHEN event_type = 'view' THEN CASE user_id % 3 WHEN 0 THEN 'RESIDENTIAL' WHEN 1 THEN 'OFFICE'
              ELSE 'SHOP' END END AS venue_type
  FROM events e WHERE {keep}
)"""


TIMELINE = _event_rows("tl", TL_BASE, "event_id % 3 <> 0")
CONTEXT = _event_rows("cx", CTX_BASE, "event_id % 3 <> 1")

# flat payloads: one landing row per event
FLAT = f"""
fl AS (
  SELECT e.*, {FLAT_BASE} + event_id AS id, concat('u', user_id) AS uid,
         CASE event_id % 6 WHEN 0 THEN 'VehicleCrash' WHEN 1 THEN 'SDKStatus' WHEN 2 THEN 'UserMetadata'
              WHEN 3 THEN 'UserActivity' WHEN 4 THEN 'TechnicalEvent' ELSE 'DebugLog' END AS tipo,
         CASE WHEN event_id % 6 = 5 THEN 'PENDING'
              WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN 'FAILED'
              WHEN event_id % 6 = 0 AND (event_id % 79 = 0 OR event_id % 89 = 0) THEN 'FAILED'
              WHEN event_id % 83 = 0 AND event_id % 6 = 0 AND event_id % 5 <> 0 THEN 'FAILED'
              WHEN event_id % 83 = 0 AND event_id % 6 = 3 AND event_type = 'view' THEN 'FAILED'
              ELSE 'PROCESSED' END AS status,
         CASE WHEN event_id % 6 = 5 THEN 'unrouted_type'
              WHEN event_id % 97 = 0 THEN 'malformed_json'
              WHEN event_id % 101 = 0 THEN 'wrong_shape'
              WHEN event_id % 6 = 0 AND event_id % 79 = 0 THEN 'wrong_field'
              WHEN event_id % 6 = 0 AND event_id % 89 = 0 THEN 'numeric_overflow'
              WHEN event_id % 83 = 0 AND event_id % 6 = 0 AND event_id % 5 <> 0 THEN 'numeric_overflow'
              WHEN event_id % 83 = 0 AND event_id % 6 = 3 AND event_type = 'view' THEN 'numeric_overflow' END AS reason,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events e
)"""

# payload-level rows of timeline and context (one landing row per group)
TL_PAYLOADS = """
tlp AS (
  SELECT payload_id AS id, any_value(uid) AS user_id, any_value(user_id) AS user_num,
         CASE WHEN day(any_value(CAST(ts AS DATE))) % 2 = 0 THEN 'TimelineEvents' ELSE 'TimelineUpdate' END AS tipo,
         max(ts) AS created_at, count(*) AS n_events
  FROM tl GROUP BY payload_id
)"""
CX_PAYLOADS = """
cxp AS (
  SELECT payload_id AS id, any_value(uid) AS user_id, any_value(user_id) AS user_num,
         CASE WHEN day(any_value(CAST(ts AS DATE))) % 2 = 1 THEN 'UserContextUpdate' ELSE 'requestUserContext' END AS tipo,
         max(ts) AS created_at, min(ts) AS first_ts, count(*) AS n_events, count(DISTINCT k) AS n_segments
  FROM cx GROUP BY payload_id
)"""

# every landing row with its final status
STATUS = """
st AS (
  SELECT id, user_id, 'DrivingInsights' AS tipo, created_at,
         CASE WHEN failed THEN 'FAILED' ELSE 'PROCESSED' END AS status,
         CASE WHEN failed THEN 'numeric_overflow' END AS reason, app_version
  FROM p
  UNION ALL SELECT id, user_id, tipo, created_at, status, reason, app_version FROM c
  UNION ALL SELECT id, user_id, tipo, created_at, 'PROCESSED', NULL, '1.4.2' FROM tlp
  UNION ALL SELECT id, user_id, tipo, created_at, 'PROCESSED', NULL, '1.4.2' FROM cxp
  UNION ALL SELECT id, uid, tipo, ts, status, reason, '1.4.2' FROM fl
)"""

ALL = [PARENTS, CHILDREN, TIMELINE, CONTEXT, FLAT, TL_PAYLOADS, CX_PAYLOADS, STATUS]


def with_(*fragments: str) -> str:
    return "WITH " + ",\n".join(f.strip() for f in fragments) + "\n"


def sql(body: str, *fragments: str) -> str:
    """``body`` after the fragments; a body that starts with a comma brings fragments of its own."""
    return with_(*fragments) + body
