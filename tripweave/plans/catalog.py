"""Named queries: one Spark plan per operator family, each paired with an
independent DuckDB oracle over the base tables (``plans/oracle.py``).

Every query reads the whole supplied tables (through the derived landing
queue) and returns a DataFrame; nothing is collected on the driver.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.plans import oracle as O
from tripweave.plans.pipeline import Pipeline
from tripweave.session import stored, tune, work_folder
from tripweave.sources import fixtures
from tripweave.sources.landing import read_landing, write_landing

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


#: Landings written by this application, by input folder and state of its files.
_LANDINGS: dict[tuple, str] = {}


def _state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells one state of the input files from another: their names, times and lengths, as one number."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in fixtures.TABLES]).select("path", "modificationTime", "length")
    r = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)")).alias("h")).first()
    return spark.sparkContext.applicationId, sf_dir, r.n, str(r.h)


def derive_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing queue of ``sf_dir``: derived once for a state of its files into this application's folder, then read from there."""
    key = _state_of(spark, sf_dir)
    if key not in _LANDINGS:
        path = _folder(spark, "landing")
        write_landing(fixtures.derive_landing(spark, sf_dir), path)
        _LANDINGS[key] = path
    return read_landing(spark, _LANDINGS[key])


def _folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}/{uuid.uuid4().hex}"


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    tune(spark)
    return Pipeline(derive_landing(spark, sf_dir))


def dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


# ---------------------------------------------------------------------------
# Queue, status, quarantine
# ---------------------------------------------------------------------------


@query("queue_pending", O.sql("""
SELECT tipo, reason, count(*) AS n_pending FROM st WHERE status = 'PENDING' GROUP BY tipo, reason
""", *O.ALL))
def queue_pending(spark, sf_dir):
    s = pipeline(spark, sf_dir).landing_status
    return s.filter(F.col("status") == S.PENDING).groupBy("tipo", "reason").agg(F.count("*").alias("n_pending"))


@query("status_conservation", O.sql("""
SELECT tipo, status, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM st GROUP BY tipo, status
""", *O.ALL))
def status_conservation(spark, sf_dir):
    s = pipeline(spark, sf_dir).landing_status
    return s.groupBy("tipo", "status").agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"))


@query("quarantine_reasons", O.sql("""
SELECT tipo, reason, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id
FROM st WHERE status = 'FAILED' GROUP BY tipo, reason
""", *O.ALL))
def quarantine_reasons(spark, sf_dir):
    q = pipeline(spark, sf_dir).quarantine
    return q.groupBy("tipo", "reason").agg(
        F.count("*").alias("n_rows"), F.min("original_id").alias("first_id"), F.max("original_id").alias("last_id"))


@query("unrouted_types", O.sql("""
SELECT tipo, count(*) AS n_rows, count(DISTINCT user_id) AS n_users
FROM st WHERE reason = 'unrouted_type' GROUP BY tipo
""", *O.ALL))
def unrouted_types(spark, sf_dir):
    s = pipeline(spark, sf_dir).landing_status
    return s.filter(F.col("reason") == "unrouted_type").groupBy("tipo").agg(
        F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"))


TYPE_VOLUME_CUTOFF = "2024-01-15 00:00:00"


@query("type_volume", O.sql(f"""
SELECT tipo, count(*) AS n_rows, max(created_at) AS last_seen
FROM st WHERE created_at >= TIMESTAMP '{TYPE_VOLUME_CUTOFF}' GROUP BY tipo
""", *O.ALL))
def type_volume(spark, sf_dir):
    """Volume and last-seen time per type since a cutoff (an argument, not now())."""
    land = derive_landing(spark, sf_dir)
    return land.filter(F.col("created_at") >= F.lit(TYPE_VOLUME_CUTOFF).cast("timestamp_ntz")).groupBy("tipo").agg(
        F.count("*").alias("n_rows"), F.max("created_at").alias("last_seen"))


# ---------------------------------------------------------------------------
# H1 driving insights, J1-J3 children
# ---------------------------------------------------------------------------


@query("insight_trip", O.sql("""
SELECT id AS insight_trip_id, user_id, canonical_id, is_provisional,
       NOT is_provisional AS has_trip,
       CAST(CAST(CASE WHEN k % 997 = 0 THEN 12.5 ELSE (k % 1000) / 1000.0 END AS DECIMAL(4,3)) AS DOUBLE) AS overall_score,
       CAST(CAST((o_custkey % 100) / 100.0 AS DECIMAL(4,3)) AS DOUBLE) AS smooth_score,
       CAST(CAST(CASE WHEN k % 5 <> 0 THEN ((k * 3) % 1000) / 1000.0 END AS DECIMAL(4,3)) AS DOUBLE) AS focus_score,
       CAST(CAST(((k * 7) % 1000) / 1000.0 AS DECIMAL(4,3)) AS DOUBLE) AS legal_score,
       CAST(1.0 AS DOUBLE) AS attention_score,
       CAST(NULL AS DOUBLE) AS harsh_braking_score,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS distance_meters,
       occupant_role,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 2 END AS n_tags
FROM p WHERE NOT failed
""", O.PARENTS))
def insight_trip(spark, sf_dir):
    it = pipeline(spark, sf_dir).insight_trip
    return it.select(
        "insight_trip_id", "user_id", "canonical_id", "is_provisional",
        F.col("trip_id").isNotNull().alias("has_trip"),
        dbl("overall_score"), dbl("smooth_score"), dbl("focus_score"), dbl("legal_score"),
        dbl("attention_score"), dbl("harsh_braking_score"), dbl("distance_meters"), "occupant_role",
        F.when(F.col("transport_tags").isNotNull(), F.size("transport_tags")).alias("n_tags"),
    )


_HARSH_TYPE = "CASE l_returnflag WHEN 'A' THEN 'ACCELERATION' WHEN 'N' THEN 'BRAKING' ELSE 'TURNING' END"
_ACCEPTED_LINE = "l_orderkey % 10 <> 9 AND l_orderkey % 997 <> 0"


@query("harsh_by_type", O.sql(f"""
SELECT {_HARSH_TYPE} AS harsh_type, l_orderkey % 11 = 0 AS is_provisional,
       count(*) AS n_events, count(DISTINCT l_orderkey) AS n_trips,
       CAST(sum(CAST(l_quantity AS DECIMAL(6,3))) AS DOUBLE) AS sum_magnitude,
       CAST(sum(CAST(l_discount * 1000.0 AS DECIMAL(6,3))) AS DOUBLE) AS sum_confidence
FROM c_lines WHERE tipo = 'DrivingInsightsHarshEvents' AND {_ACCEPTED_LINE}
GROUP BY 1, 2
""", O.CHILDREN))
def harsh_by_type(spark, sf_dir):
    """Minimum slice: harsh events per type for trips with insights (H1+H2+J1)."""
    p = pipeline(spark, sf_dir)
    h = p.child(S.HARSH)
    it = p.insight_trip.select("insight_trip_id", "is_provisional")
    return h.join(it, "insight_trip_id").groupBy("harsh_type", "is_provisional").agg(
        F.count("*").alias("n_events"), F.countDistinct("insight_trip_id").alias("n_trips"),
        F.sum("magnitude").cast("double").alias("sum_magnitude"),
        F.sum("confidence").cast("double").alias("sum_confidence"))


_CHILD_SQL = {
    S.HARSH: f"""CAST(CAST(l_quantity AS DECIMAL(6,3)) AS DOUBLE) AS magnitude,
       CAST(CAST(l_discount * 1000.0 AS DECIMAL(6,3)) AS DOUBLE) AS confidence, {_HARSH_TYPE} AS harsh_type,""",
    S.PHONE: """CASE l_returnflag WHEN 'A' THEN 'NO_CALL' WHEN 'N' THEN 'CALL_IN_PROGRESS' ELSE 'UNAVAILABLE' END AS call_state,""",
    S.CALL: """CAST(CAST(l_discount * 100 AS DECIMAL(7,2)) AS DOUBLE) AS min_traveled_speed_mps,
       CAST(CAST((l_discount + l_tax) * 100 AS DECIMAL(7,2)) AS DOUBLE) AS max_traveled_speed_mps,
       CASE l_returnflag WHEN 'A' THEN 'HANDS_FREE' WHEN 'N' THEN 'HANDHELD' ELSE 'UNAVAILABLE' END AS hands_free_state,""",
    S.SPEEDING: "",
    S.WRONG_WAY: "",
}
_CHILD_COLS = {
    S.HARSH: ["magnitude", "confidence", "harsh_type"],
    S.PHONE: ["call_state"],
    S.CALL: ["min_traveled_speed_mps", "max_traveled_speed_mps", "hands_free_state"],
    S.SPEEDING: [],
    S.WRONG_WAY: [],
}


def _child_query(child_type: str) -> tuple[QueryFn, str]:
    kind = S.CHILD_KIND[child_type]
    extra_missing = " AND l_orderkey % 53 <> 0" if child_type == S.SPEEDING else ""
    oracle = O.sql(f"""
SELECT l_orderkey * 1000 + ordinal AS source_event_id, l_orderkey * 1000 + 500 AS insight_trip_id,
       date_trunc('millisecond', l_shipdate + to_seconds(l_partkey % 3600)) AS start_time,
       epoch_ms(l_shipdate + to_seconds(l_partkey % 3600)) AS start_time_epoch,
       date_trunc('millisecond', l_shipdate + to_seconds(l_partkey % 3600 + l_linenumber * 10)) AS end_time,
       {_CHILD_SQL[child_type]}
       l_suppkey % 3 + 1 AS n_waypoints
FROM c_lines WHERE tipo = '{child_type}' AND {_ACCEPTED_LINE}{extra_missing}
""", O.CHILDREN)

    def fn(spark, sf_dir):
        ev = pipeline(spark, sf_dir).child(child_type)
        return ev.select(
            "source_event_id", "insight_trip_id", "start_time", "start_time_epoch", "end_time",
            *[dbl(c) if c not in ("harsh_type", "call_state", "hands_free_state") else F.col(c)
              for c in _CHILD_COLS[child_type]],
            F.size("waypoints").alias("n_waypoints"),
        )

    fn.__name__ = f"child_{kind}"
    return fn, oracle


for _t in S.CHILD_TYPES:
    _fn, _sql = _child_query(_t)
    REGISTRY[f"child_{S.CHILD_KIND[_t]}"] = (_fn, _sql)


@query("child_orphans", O.sql("""
SELECT tipo, status, count(*) AS n_payloads, sum(n_events) AS n_events, count(DISTINCT k) AS n_transports
FROM c GROUP BY tipo, status
""", O.CHILDREN))
def child_orphans(spark, sf_dir):
    """Child payloads matched to a parent (processed), orphaned
    (pending) or without transport id (failed)."""
    p = pipeline(spark, sf_dir)
    r = p.resolved.filter(F.col("tipo").isin(*S.CHILD_TYPES))
    return r.groupBy("tipo", "status").agg(
        F.count("*").alias("n_payloads"),
        F.sum(F.size("p_child.events")).cast("bigint").alias("n_events"),
        F.countDistinct(F.floor(F.col("id") / 1000)).alias("n_transports"))


# ---------------------------------------------------------------------------
# U1 trip fold, J4 lookup
# ---------------------------------------------------------------------------

TRIP_CANDIDATES = """
cand AS (
  SELECT user_id, canonical_id, id::HUGEINT * 10000000000 AS ord, 'DRIVING_INSIGHTS' AS first_seen_from,
         o_orderdate AS start_time, epoch_ms(o_orderdate) AS start_time_epoch,
         o_orderdate + to_seconds(dur) AS end_time, epoch_ms(o_orderdate + to_seconds(dur)) AS end_time_epoch,
         CAST(dur AS DECIMAL(10,0)) AS duration_in_seconds, CAST(o_totalprice AS DECIMAL(12,2)) AS distance_meters,
         transport_mode, occupant_role, id AS src, CASE WHEN n_waypoints > 0 THEN n_waypoints END AS n_waypoints,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 2 END AS n_tags
  FROM p WHERE NOT failed AND NOT is_provisional
  UNION ALL
  SELECT uid, event_key, payload_id::HUGEINT * 10000000000 + pos, 'TIMELINE', start_time, start_time_epoch, end_time, end_time_epoch,
         CAST(dur AS DECIMAL(10,0)), distance_meters, transport_mode, occupant_role, payload_id,
         CASE WHEN ev_type = 'IN_TRANSPORT' THEN 2 END, CASE WHEN ev_type = 'IN_TRANSPORT' THEN 1 END
  FROM tl WHERE (ev_type = 'IN_TRANSPORT' OR transport_mode IS NOT NULL) AND NOT is_provisional
  UNION ALL
  SELECT uid, event_key, payload_id::HUGEINT * 10000000000 + pos, 'CONTEXT', start_time, start_time_epoch, end_time, end_time_epoch,
         CAST(dur AS DECIMAL(10,0)), distance_meters, transport_mode, occupant_role, payload_id,
         CASE WHEN ev_type = 'IN_TRANSPORT' THEN 2 END, CASE WHEN ev_type = 'IN_TRANSPORT' THEN 1 END
  FROM cx WHERE (ev_type = 'IN_TRANSPORT' OR transport_mode IS NOT NULL) AND NOT is_provisional
  UNION ALL
  SELECT uid, concat('activity:', id), id::HUGEINT * 10000000000, 'ACTIVITY', date_trunc('millisecond', ts), NULL, NULL, NULL,
         NULL, NULL, CASE WHEN event_type = 'click' THEN 'TRIP_TYPE_SDK' END, NULL, id, NULL, NULL
  FROM fl WHERE tipo = 'UserActivity' AND status = 'PROCESSED' AND event_type IN ('click', 'purchase')
)"""


def _trip_oracle(enrich: bool) -> str:
    def first(c):
        return f"first({c} ORDER BY ord)" + (f" FILTER (WHERE {c} IS NOT NULL)" if enrich else "")

    def last(c):
        return f"last({c} ORDER BY ord)" + (f" FILTER (WHERE {c} IS NOT NULL)" if enrich else "")

    return O.sql(f"""
SELECT user_id, canonical_id,
       {first('first_seen_from')} AS first_seen_from,
       {first('start_time')} AS start_time, {first('start_time_epoch')} AS start_time_epoch,
       {first('src')} AS creating_source_event_id,
       {first('n_waypoints')} AS n_waypoints, {first('n_tags')} AS n_tags,
       {last('end_time')} AS end_time, {last('end_time_epoch')} AS end_time_epoch,
       CAST({last('duration_in_seconds')} AS DOUBLE) AS duration_in_seconds,
       CAST({last('distance_meters')} AS DOUBLE) AS distance_meters,
       {last('transport_mode')} AS transport_mode, {last('occupant_role')} AS occupant_role,
       {last('src')} AS last_updated_by_source_event_id,
       count(*) AS n_writers
FROM cand GROUP BY user_id, canonical_id
""", O.PARENTS, O.TIMELINE, O.CONTEXT, O.FLAT, TRIP_CANDIDATES)


def _trip_select(t: DataFrame) -> DataFrame:
    return t.select(
        "user_id", "canonical_id", "first_seen_from", "start_time", "start_time_epoch",
        "creating_source_event_id",
        F.when(F.col("waypoints").isNotNull(), F.size("waypoints")).alias("n_waypoints"),
        F.when(F.col("transport_tags").isNotNull(), F.size("transport_tags")).alias("n_tags"),
        "end_time", "end_time_epoch", dbl("duration_in_seconds"), dbl("distance_meters"),
        "transport_mode", "occupant_role", "last_updated_by_source_event_id", "n_writers",
    )


@query("trip_fold", _trip_oracle(False))
def trip_fold(spark, sf_dir):
    return _trip_select(pipeline(spark, sf_dir).trips("reference"))


@query("trip_fold_enrich", _trip_oracle(True))
def trip_fold_enrich(spark, sf_dir):
    return _trip_select(pipeline(spark, sf_dir).trips("enrich"))


_CROSS = """
, x AS (SELECT user_id, canonical_id, id AS ord, 'DRIVING_INSIGHTS' AS origin, date_trunc('millisecond', o_orderdate) AS start_time,
               transport_mode, CAST(o_totalprice AS DOUBLE) AS distance, occupant_role, dur AS duration
        FROM p WHERE NOT failed AND NOT is_provisional
  UNION ALL SELECT concat('c', o_custkey), concat('t', o_orderkey), 4000000000000000000 + o_orderkey, 'TIMELINE',
               o_orderdate + INTERVAL 1 HOUR, 'TRAM', o_orderkey % 1000 + 0.5, NULL, NULL FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 13 <> 0)
SELECT user_id, canonical_id, arg_min(origin, ord) AS first_seen_from, arg_min(start_time, ord) AS start_time,
       arg_max(transport_mode, ord) AS transport_mode, arg_max(distance, ord) AS distance, {role} AS occupant_role,
       CAST({duration} AS DOUBLE) AS duration, count(*) AS n_writers, count(DISTINCT origin) AS n_sources
FROM x GROUP BY user_id, canonical_id
"""


def _cross_fold(spark, sf_dir, policy: str) -> DataFrame:
    from tripweave.sources.tables import read_table
    tune(spark)
    orders = read_table(spark, sf_dir, "orders")
    p = Pipeline(fixtures.parent_payloads(orders).unionByName(fixtures.cross_timelines(orders)))
    sources = p.trip_candidates.groupBy("user_id", "canonical_id").agg(F.countDistinct("first_seen_from").alias("n_sources"))
    return p.trips(policy).join(sources, ["user_id", "canonical_id"]).select(
        "user_id", "canonical_id", "first_seen_from", "start_time", "transport_mode", dbl("distance_meters").alias("distance"), "occupant_role",
        dbl("duration_in_seconds").alias("duration"), "n_writers", "n_sources")


@query("trip_fold_cross", O.sql(_CROSS.format(role="last(occupant_role ORDER BY ord)", duration="last(duration ORDER BY ord)"), O.PARENTS))
def trip_fold_cross(spark, sf_dir):
    """The same transports of the same users reported by insights and by timelines; the last writer's nulls win."""
    return _cross_fold(spark, sf_dir, "reference")


@query("trip_fold_cross_enrich", O.sql(_CROSS.format(
    role="last(occupant_role ORDER BY ord) FILTER (WHERE occupant_role IS NOT NULL)",
    duration="last(duration ORDER BY ord) FILTER (WHERE duration IS NOT NULL)"), O.PARENTS))
def trip_fold_cross_enrich(spark, sf_dir):
    """U1 with the enrich policy over both sources: a later null overwrites nothing."""
    return _cross_fold(spark, sf_dir, "enrich")


@query("trip_lookup", O.sql("""
SELECT p.id AS insight_trip_id, p.canonical_id, p.is_provisional,
       CASE WHEN p.is_provisional THEN NULL ELSE 'DRIVING_INSIGHTS' END AS trip_first_seen_from,
       CASE WHEN p.is_provisional THEN NULL ELSE p.o_orderdate END AS trip_start_time,
       CASE WHEN p.is_provisional THEN NULL WHEN p.k % 7 = 0 THEN 2 ELSE 1 END AS trip_writers
FROM p WHERE NOT p.failed
""", O.PARENTS))
def trip_lookup(spark, sf_dir):
    """J4 + P14: insight rows with their consolidated trip; provisional -> NULLs."""
    from tripweave.operators.trips import trip_lookup as lookup
    p = pipeline(spark, sf_dir).reporting()
    j = lookup(p.insight_trip, p.trips(columns=("first_seen_from", "start_time", "end_time", "transport_mode")))
    return j.select("insight_trip_id", "canonical_id", "is_provisional", "trip_first_seen_from",
                    "trip_start_time", "trip_writers")


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


# ---------------------------------------------------------------------------
# H7 user context (X1-X5, A4), H8 timeline
# ---------------------------------------------------------------------------

_LAT = "CAST(CAST(50.0 + {u} / 10000.0 AS DECIMAL(10,8)) AS DOUBLE)"


@query("context_header", O.sql(f"""
SELECT id AS context_id, user_id,
       CASE WHEN tipo = 'requestUserContext' THEN 'MANUAL' ELSE 'LISTENER' END AS context_source_type,
       CASE WHEN hour(first_ts) < 6 THEN 'NIGHT' WHEN hour(first_ts) < 12 THEN 'MORNING'
            WHEN hour(first_ts) < 18 THEN 'AFTERNOON' ELSE 'EVENING' END AS semantic_time,
       CASE WHEN user_num % 4 <> 0 THEN {_LAT.format(u='user_num')} END AS last_known_latitude,
       CASE WHEN user_num % 4 <> 0 THEN 4.55 END AS last_known_longitude,
       CASE WHEN user_num % 4 <> 0 THEN 20.0 END AS last_known_accuracy
FROM cxp
""", O.CONTEXT, O.CX_PAYLOADS))
def context_header(spark, sf_dir):
    h = pipeline(spark, sf_dir).context_header
    return h.select("context_id", "user_id", "context_source_type", "semantic_time",
                    dbl("last_known_latitude"), dbl("last_known_longitude"), dbl("last_known_accuracy"))


@query("context_criteria", O.sql("""
SELECT id AS context_id, 0 AS pos, CASE WHEN tipo = 'requestUserContext' THEN 'MANUAL_REQUEST' ELSE 'CURRENT_EVENT' END AS criteria_code
FROM cxp
UNION ALL
SELECT id, 1, CASE WHEN user_num % 2 = 0 THEN 'VISITED_VENUES' ELSE 'ACTIVE_SEGMENTS' END
FROM cxp WHERE tipo = 'UserContextUpdate'
""", O.CONTEXT, O.CX_PAYLOADS))
def context_criteria(spark, sf_dir):
    return pipeline(spark, sf_dir).context_criteria.select("context_id", "pos", "criteria_code")


def _place_query(which: str, residue: int, venue: str, lon: float) -> tuple[QueryFn, str]:
    oracle = O.sql(f"""
SELECT id AS context_id, user_id, '{which.upper()}' AS significance, '{venue}' AS venue_type,
       {_LAT.format(u='user_num')} AS latitude, {lon} AS longitude, 15.0 AS accuracy
FROM cxp WHERE user_num % 3 = {residue}
""", O.CONTEXT, O.CX_PAYLOADS)

    def fn(spark, sf_dir):
        t = pipeline(spark, sf_dir)
        df = t.context_home if which == "home" else t.context_work
        return df.select("context_id", "user_id", "significance", "venue_type",
                         dbl("latitude"), dbl("longitude"), dbl("accuracy"))

    return fn, oracle


REGISTRY["context_home"] = _place_query("home", 0, "RESIDENTIAL", 4.5)
REGISTRY["context_work"] = _place_query("work", 1, "OFFICE", 4.6)

SEGMENTS = """
seg AS (
  SELECT payload_id AS context_id, any_value(uid) AS user_id, k,
         row_number() OVER (PARTITION BY payload_id ORDER BY k) - 1 AS pos,
         count(*) AS n, min(ts) AS s_start, max(ts) AS s_end
  FROM cx GROUP BY payload_id, k
)"""


@query("context_segment", O.sql("""
SELECT context_id, user_id, pos, CAST(k AS VARCHAR) AS segment_id,
       CASE k % 3 WHEN 0 THEN 'LEISURE' WHEN 1 THEN 'MOBILITY' ELSE 'WORK_LIFE' END AS category,
       concat('SUB', k % 5) AS subcategory, concat('SEG_', k) AS segment_type,
       date_trunc('millisecond', s_start) AS start_time, epoch_us(s_start) // 1000 AS start_time_epoch,
       date_trunc('millisecond', s_end) AS end_time, epoch_us(s_end) // 1000 AS end_time_epoch
FROM seg
""", O.CONTEXT, SEGMENTS))
def context_segment(spark, sf_dir):
    s = pipeline(spark, sf_dir).context_segment
    return s.select("context_id", "user_id", "pos", "segment_id", "category", "subcategory", "segment_type",
                    "start_time", "start_time_epoch", "end_time", "end_time_epoch")


@query("context_segment_attribute", O.sql("""
SELECT context_id, CAST(k AS VARCHAR) AS segment_id, 0 AS attr_pos, 'k_score' AS attribute_name,
       CAST(CAST(k / 100.0 AS DECIMAL(18,4)) AS DOUBLE) AS attribute_value FROM seg
UNION ALL
SELECT context_id, CAST(k AS VARCHAR), 1, 'n_events', CAST(CAST(n AS DECIMAL(18,4)) AS DOUBLE) FROM seg
""", O.CONTEXT, SEGMENTS))
def context_segment_attribute(spark, sf_dir):
    a = pipeline(spark, sf_dir).context_segment_attribute
    return a.select("context_id", "segment_id", "attr_pos", "attribute_name", dbl("attribute_value"))


@query("segment_attr_count", O.sql("""
SELECT context_id, CAST(k AS VARCHAR) AS segment_id, 2 AS n_attributes FROM seg
""", O.CONTEXT, SEGMENTS))
def segment_attr_count(spark, sf_dir):
    """A4: attributes per segment as aggregate + left join, missing -> 0."""
    p = pipeline(spark, sf_dir)
    n = p.context_segment_attribute.groupBy("segment_detail_id").agg(F.count("*").alias("n_attributes"))
    return p.context_segment.join(n, "segment_detail_id", "left").select(
        "context_id", "segment_id", F.coalesce("n_attributes", F.lit(0)).cast("bigint").alias("n_attributes"))


def _event_oracle(src: str, id_col: str) -> str:
    frag = O.TIMELINE if src == "tl" else O.CONTEXT
    return O.sql(f"""
SELECT payload_id AS {id_col}, uid AS user_id, pos, event_key AS event_id, ev_type AS event_type,
       start_time, start_time_epoch, end_time, end_time_epoch,
       CAST(CAST(dur AS DECIMAL(10,0)) AS DOUBLE) AS duration_in_seconds, is_provisional, transport_mode,
       CAST(distance_meters AS DOUBLE) AS distance_meters, occupant_role,
       CASE WHEN event_type IN ('click', 'purchase') THEN 1 END AS n_tags,
       CAST(CAST(lat AS DECIMAL(10,8)) AS DOUBLE) AS location_latitude,
       CAST(CAST(lon AS DECIMAL(11,8)) AS DOUBLE) AS location_longitude,
       venue_significance, venue_type
FROM {src}
""", frag)


def _event_select(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(
        id_col, "user_id", "pos", "event_id", "event_type", "start_time", "start_time_epoch", "end_time",
        "end_time_epoch", dbl("duration_in_seconds"), "is_provisional", "transport_mode", dbl("distance_meters"),
        "occupant_role", F.when(F.col("transport_tags").isNotNull(), F.size("transport_tags")).alias("n_tags"),
        dbl("location_latitude"), dbl("location_longitude"), "venue_significance", "venue_type")


@query("context_event", _event_oracle("cx", "context_id"))
def context_event(spark, sf_dir):
    return _event_select(pipeline(spark, sf_dir).context_event, "context_id")


@query("timeline_event", _event_oracle("tl", "source_event_id"))
def timeline_event(spark, sf_dir):
    return _event_select(pipeline(spark, sf_dir).timeline_event, "source_event_id")


# ---------------------------------------------------------------------------
# H9-H13 flat handlers
# ---------------------------------------------------------------------------

_FL_OK = "FROM fl WHERE status = 'PROCESSED' AND tipo = '{t}'"


@query("crash_event", O.sql(f"""
SELECT id AS crash_event_id, uid AS user_id, epoch_us(ts) // 1000 AS crash_time_epoch,
       CASE WHEN event_id % 5 <> 0 THEN {_LAT.format(u='user_id')} END AS latitude,
       CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(4.0 + (event_id % 1000) / 1000.0 AS DECIMAL(11,8)) AS DOUBLE) END AS longitude,
       CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) END AS altitude,
       CAST(CAST(value / 10.0 AS DECIMAL(6,3)) AS DOUBLE) AS magnitude,
       CAST(CAST(value AS DECIMAL(7,2)) AS DOUBLE) AS speed_at_impact,
       CAST(CAST(value * 2.0 AS DECIMAL(7,2)) AS DOUBLE) AS delta_v,
       CAST(CAST((event_id % 100) / 100.0 AS DECIMAL(6,3)) AS DOUBLE) AS confidence,
       CASE WHEN value < 10 THEN 'LOW' WHEN value < 100 THEN 'MEDIUM' ELSE 'HIGH' END AS severity,
       CASE WHEN user_id % 2 = 0 THEN 'CAR' ELSE 'TWO_WHEELER' END AS detector_mode,
       CASE WHEN user_id % 5 > 0 THEN user_id % 5 END AS n_preceding
{_FL_OK.format(t='VehicleCrash')}
""", O.FLAT))
def crash_event(spark, sf_dir):
    c = pipeline(spark, sf_dir).crash_event
    return c.select("crash_event_id", "user_id", "crash_time_epoch", dbl("latitude"), dbl("longitude"),
                    dbl("altitude"), dbl("magnitude"), dbl("speed_at_impact"), dbl("delta_v"), dbl("confidence"),
                    "severity", "detector_mode", F.size("preceding_locations").alias("n_preceding"))


@query("sdk_status", O.sql(f"""
SELECT id AS sdk_status_id, uid AS user_id,
       CASE WHEN event_id % 2 = 0 THEN 'STARTED' ELSE 'NOT_STARTED' END AS start_status,
       CASE WHEN event_type = 'error' THEN 'DISABLED' ELSE 'ENABLED_AND_DETECTING' END AS detection_status,
       CASE user_id % 3 WHEN 0 THEN 'ALWAYS' WHEN 1 THEN 'WHILE_IN_USE' ELSE 'NEVER' END AS location_permission,
       event_id % 4 = 0 AS precise_location_granted, event_id % 3 <> 0 AS is_location_available,
       'OK' AS quota_status_wifi, CASE WHEN value > 100 THEN 'EXCEEDED' ELSE 'OK' END AS quota_status_mobile,
       'OK' AS quota_status_disk, user_id % 7 <> 0 AS can_detect
{_FL_OK.format(t='SDKStatus')}
""", O.FLAT))
def sdk_status(spark, sf_dir):
    s = pipeline(spark, sf_dir).sdk_status
    return s.select("sdk_status_id", "user_id", "start_status", "detection_status", "location_permission",
                    "precise_location_granted", "is_location_available", "quota_status_wifi",
                    "quota_status_mobile", "quota_status_disk", "can_detect")


@query("user_activity", O.sql(f"""
SELECT id AS activity_id, uid AS user_id,
       CASE WHEN event_type IN ('click', 'purchase') THEN 'IN_TRANSPORT' WHEN event_type = 'view' THEN 'STATIONARY'
            ELSE 'UNKNOWN' END AS activity_type,
       CASE WHEN event_type = 'click' THEN 'TRIP_TYPE_SDK' END AS trip_type,
       CASE WHEN event_type = 'view' THEN {_LAT.format(u='user_id')} END AS stationary_latitude,
       CASE WHEN event_type = 'view' THEN CAST(CAST(4.0 + (event_id % 1000) / 1000.0 AS DECIMAL(11,8)) AS DOUBLE) END
         AS stationary_longitude,
       event_type IN ('click', 'purchase') AS is_trip
{_FL_OK.format(t='UserActivity')}
""", O.FLAT))
def user_activity(spark, sf_dir):
    a = pipeline(spark, sf_dir).user_activity
    return a.select("activity_id", "user_id", "activity_type", "trip_type", dbl("stationary_latitude"),
                    dbl("stationary_longitude"), "is_trip")


@query("technical_event", O.sql(f"""
SELECT id AS technical_event_id, uid AS user_id, upper(event_type) AS technical_event_type,
       concat('k=', k) AS message
{_FL_OK.format(t='TechnicalEvent')}
""", O.FLAT))
def technical_event(spark, sf_dir):
    return pipeline(spark, sf_dir).technical_event.select(
        "technical_event_id", "user_id", "technical_event_type", "message")


_META_LABEL = "CASE user_id % 3 WHEN 0 THEN 'fleet' WHEN 1 THEN 'tier' ELSE 'vehicle' END"
_META_VALUE = ("CASE (event_id // 6) % 3 WHEN 0 THEN CAST(value AS VARCHAR) "
               "WHEN 1 THEN CASE WHEN user_id % 2 = 0 THEN 'True' ELSE 'False' END ELSE event_type END")


@query("user_metadata", O.sql(f"""
SELECT id AS metadata_id, uid AS user_id, {_META_LABEL} AS label, {_META_VALUE} AS value
{_FL_OK.format(t='UserMetadata')}
""", O.FLAT))
def user_metadata(spark, sf_dir):
    return pipeline(spark, sf_dir).user_metadata.select("metadata_id", "user_id", "label", "value")


# ---------------------------------------------------------------------------
# H0 audit rows, U2-U6 dedup, O6/J8 unified events
# ---------------------------------------------------------------------------

SOURCE_EVENTS = """
se AS (
  SELECT 'DrivingInsights' AS record_type, o_orderdate AS source_time, canonical_id AS ref FROM p WHERE NOT failed
  UNION ALL
  SELECT tipo, created_at, CAST(id AS VARCHAR) FROM c WHERE status = 'PROCESSED'
  UNION ALL
  SELECT any_value(tlp.tipo),
         CASE WHEN any_value(tlp.user_num) % 2 = 0 THEN any_value(tlp.created_at) ELSE arg_min(tl.start_time, tl.event_id) END,
         CASE WHEN any_value(tlp.user_num) % 2 = 0 THEN CAST(tlp.id AS VARCHAR) ELSE concat('e', min(tl.event_id)) END
  FROM tlp JOIN tl ON tl.payload_id = tlp.id GROUP BY tlp.id
  UNION ALL
  SELECT tipo, created_at, CAST(id AS VARCHAR) FROM cxp
  UNION ALL
  SELECT tipo, CASE WHEN tipo = 'UserActivity' THEN date_trunc('millisecond', ts) ELSE ts END, CAST(id AS VARCHAR)
  FROM fl WHERE status = 'PROCESSED'
)"""


@query("source_event", O.sql("""
SELECT record_type, count(*) AS n_rows, count(DISTINCT ref) AS n_refs,
       min(source_time) AS min_source_time, max(source_time) AS max_source_time
FROM se GROUP BY record_type
""", *O.ALL, SOURCE_EVENTS))
def source_event(spark, sf_dir):
    """H0 + P16/P17: audit rows per processed payload."""
    se = pipeline(spark, sf_dir).source_event
    return se.groupBy("record_type").agg(
        F.count("*").alias("n_rows"), F.countDistinct("source_event_ref").alias("n_refs"),
        F.min("source_time").alias("min_source_time"), F.max("source_time").alias("max_source_time"))


@query("payload_dedup", O.sql("""
SELECT 'DrivingInsights' AS tipo, count(*) AS n_rows, count(DISTINCT k) AS n_kept FROM p WHERE NOT failed
UNION ALL SELECT tipo, count(*), count(*) FROM c WHERE status = 'PROCESSED' GROUP BY tipo
UNION ALL SELECT tipo, count(*), count(*) FROM tlp GROUP BY tipo
UNION ALL SELECT tipo, count(*), count(*) FROM cxp WHERE tipo = 'UserContextUpdate' GROUP BY tipo
UNION ALL SELECT tipo, count(*), count(DISTINCT (uid, date_trunc('millisecond', ts), event_type IN ('click', 'purchase'), event_type = 'view', event_type = 'click'))
  FROM fl WHERE status = 'PROCESSED' AND tipo = 'UserActivity' GROUP BY tipo
UNION ALL SELECT tipo, count(*), count(DISTINCT (uid, date_trunc('millisecond', ts), value, event_id % 100, event_id % 5 = 0))
  FROM fl WHERE status = 'PROCESSED' AND tipo = 'VehicleCrash' GROUP BY tipo
""", *O.ALL))
def payload_dedup(spark, sf_dir):
    """First copy per (user, type, payload hash); snapshot types exempt."""
    from tripweave.operators.dedup import payload_dedup as dedup
    p = pipeline(spark, sf_dir)
    # stored: the rows are read for the first copies, for those kept and for the count, their payloads parsed once
    rows = stored(p.source_event.select("source_event_id", "user_id", F.col("record_type").alias("tipo"), F.unhex("payload_hash").alias("payload_hash")), "audit", compression="zstd")
    kept = dedup(rows, key="source_event_id")
    exempt = list(S.SNAPSHOT_TYPES)
    n = rows.filter(~F.col("tipo").isin(*exempt)).groupBy("tipo").agg(F.count("*").alias("n_rows"))
    k = kept.filter(~F.col("tipo").isin(*exempt)).groupBy("tipo").agg(F.count("*").alias("n_kept"))
    return n.join(k, "tipo")


@query("latest_metadata", O.sql(f"""
SELECT uid AS user_id, {_META_LABEL} AS label, arg_max({_META_VALUE}, id) AS value, max(id) AS metadata_id
{_FL_OK.format(t='UserMetadata')} GROUP BY 1, 2
""", O.FLAT))
def latest_metadata(spark, sf_dir):
    from tripweave.operators.dedup import latest_metadata as latest
    return latest(pipeline(spark, sf_dir).user_metadata).select("user_id", "label", "value", "metadata_id")


@query("latest_place", O.sql(f"""
SELECT user_id, CASE WHEN user_num % 3 = 0 THEN 'HOME' ELSE 'WORK' END AS significance,
       max(id) AS context_id, any_value({_LAT.format(u='user_num')}) AS latitude
FROM cxp WHERE user_num % 3 IN (0, 1) GROUP BY 1, 2
""", O.CONTEXT, O.CX_PAYLOADS))
def latest_place(spark, sf_dir):
    from tripweave.operators.dedup import latest_place as latest
    p = pipeline(spark, sf_dir)
    return latest(p.context_home.unionByName(p.context_work)).select(
        "user_id", "significance", "context_id", dbl("latitude"))


@query("segment_dedup", O.sql("""
SELECT user_id, CAST(k AS VARCHAR) AS segment_id, max(context_id) AS context_id, count(*) AS n_versions
FROM seg GROUP BY 1, 2
""", O.CONTEXT, SEGMENTS))
def segment_dedup(spark, sf_dir):
    from tripweave.operators.dedup import latest_by_key
    s = pipeline(spark, sf_dir).context_segment
    return latest_by_key(s, ["user_id", "segment_id"], "segment_detail_id").select(
        "user_id", "segment_id", "context_id", "n_versions")


@query("event_dedup", O.sql("""
SELECT coalesce(cx.uid, tl.uid) AS user_id, coalesce(cx.event_key, tl.event_key) AS event_id,
       CASE WHEN cx.event_id IS NOT NULL THEN 'context' ELSE 'timeline' END AS latest_source,
       (cx.event_id IS NOT NULL)::INT + (tl.event_id IS NOT NULL)::INT AS n_versions
FROM tl FULL OUTER JOIN cx ON tl.event_id = cx.event_id
""", O.TIMELINE, O.CONTEXT))
def event_dedup(spark, sf_dir):
    from tripweave.operators.dedup import latest_by_key
    p = pipeline(spark, sf_dir)
    ev = p.timeline_event.select("user_id", "event_id", F.col("timeline_event_id").alias("detail_id"),
                                 F.lit("timeline").alias("latest_source")).unionByName(
        p.context_event.select("user_id", "event_id", F.col("event_detail_id").alias("detail_id"),
                               F.lit("context").alias("latest_source")))
    return latest_by_key(ev, ["user_id", "event_id"], "detail_id").select(
        "user_id", "event_id", "latest_source", "n_versions")


@query("unified_events", O.sql("""
SELECT uid AS user_id, event_key AS event_id, ev_type AS event_type, start_time, 'timeline' AS fuente FROM tl
UNION
SELECT uid, event_key, ev_type, start_time, 'context' FROM cx
WHERE NOT EXISTS (SELECT 1 FROM tl WHERE tl.uid = cx.uid AND tl.event_key = cx.event_key)
""", O.TIMELINE, O.CONTEXT))
def unified_events(spark, sf_dir):
    from tripweave.operators.dedup import unified_events as unify
    p = pipeline(spark, sf_dir)
    return unify(p.timeline_event, p.context_event)


# ---------------------------------------------------------------------------
# Views: A2 id range, J5/O2 newest insights, J7 lineage, J11 labels
# ---------------------------------------------------------------------------


@query("processed_id_range", O.sql("""
SELECT tipo, min(id) AS min_id, max(id) AS max_id FROM st WHERE status = 'PROCESSED' GROUP BY tipo
""", *O.ALL))
def processed_id_range(spark, sf_dir):
    """A2: min / max processed id per type."""
    s = pipeline(spark, sf_dir).landing_status.filter(F.col("status") == S.PROCESSED)
    return s.groupBy("tipo").agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"))


RECENT_N = 20


@query("recent_insights", O.sql(f"""
SELECT id, user_id, created_at, CASE WHEN failed THEN NULL ELSE id END AS source_event_id,
       CASE WHEN failed THEN NULL ELSE id END AS insight_trip_id,
       CASE WHEN failed THEN NULL ELSE canonical_id END AS canonical_id,
       CASE WHEN failed THEN NULL ELSE is_provisional END AS is_provisional
FROM p ORDER BY created_at DESC, id DESC LIMIT {RECENT_N}
""", O.PARENTS))
def recent_insights(spark, sf_dir):
    """Newest insight payloads with audit row and insight row (left joins)."""
    from tripweave.operators.views import newest_insights
    from tripweave.operators.views import recent_insights as recent
    p = pipeline(spark, sf_dir)
    newest = p.chosen(newest_insights(p.landing, RECENT_N))
    return recent(p.landing, newest.source_event, newest.insight_trip, RECENT_N).select(
        "id", "user_id", "created_at", "source_event_id", "insight_trip_id", "canonical_id", "is_provisional")


_KIND_TIPO = {kind: t for t, kind in S.CHILD_KIND.items()}


@query("lineage_tree", O.sql(f"""
SELECT p.id AS insight_trip_id, p.canonical_id,
       CASE WHEN p.is_provisional THEN NULL ELSE 'DRIVING_INSIGHTS' END AS trip_first_seen_from,
       CASE WHEN p.is_provisional THEN NULL WHEN p.k % 7 = 0 THEN 2 ELSE 1 END AS trip_writers,
       {", ".join(f"coalesce(sum(CASE WHEN l.tipo = '{t}' THEN 1 ELSE 0 END), 0) AS n_{kind}" for t, kind in S.CHILD_KIND.items())}
FROM p LEFT JOIN c_lines l
  ON l.l_orderkey = p.k AND p.id = p.k * 1000 + 500 AND {_ACCEPTED_LINE.replace('l_orderkey', 'l.l_orderkey')}
     AND NOT (l.tipo = 'DrivingInsightsSpeedingEvents' AND l.l_orderkey % 53 = 0)
WHERE NOT p.failed
GROUP BY p.id, p.canonical_id, p.is_provisional, p.k
""", O.PARENTS, O.CHILDREN))
def lineage_tree(spark, sf_dir):
    """Insight -> trip + five child sets, nested; branch sizes reported."""
    from tripweave.operators.views import lineage_tree as tree
    p = pipeline(spark, sf_dir).materialized(bare=True)
    kids = {kind: p.child(t) for t, kind in S.CHILD_KIND.items()}
    t = tree(p.insight_trip, p.trips(), kids)
    return t.select("insight_trip_id", "canonical_id", "trip_first_seen_from", "trip_writers",
                    *[F.size(kind).alias(f"n_{kind}") for kind in kids])


def _labels_values() -> str:
    from tripweave.functions.labels import LABELS
    rows = ", ".join("('{}', '{}')".format(c, lbl.replace("'", "''")) for c, lbl in LABELS)
    return f"lbl(code, label) AS (VALUES {rows})"


@query("enum_labels", O.sql("""
SELECT column_name, value, coalesce(lbl.label, value, 'Desconocido') AS label, count(*) AS n_rows
FROM (SELECT 'event_type' AS column_name, ev_type AS value FROM tl
      UNION ALL SELECT 'transport_mode', transport_mode FROM tl
      UNION ALL SELECT 'venue_type', venue_type FROM tl) v
LEFT JOIN lbl ON lbl.code = v.value
GROUP BY 1, 2, 3
""", O.TIMELINE, _labels_values()))
def enum_labels(spark, sf_dir):
    """Dictionary labels for timeline enums (fixed-size broadcast dimension)."""
    from tripweave.operators.views import label_dim, with_label
    t = pipeline(spark, sf_dir).timeline_event
    dim = label_dim(spark)
    parts = []
    for col in ("event_type", "transport_mode", "venue_type"):
        lab = with_label(t.select(F.col(col).alias("value")), "value", dim, "label")
        parts.append(lab.groupBy("value", "label").agg(F.count("*").alias("n_rows"))
                     .select(F.lit(col).alias("column_name"), "value", "label", "n_rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------------------
# Reconciliation R1-R9 and data quality R10, J12, P25, R8
# ---------------------------------------------------------------------------


def _recon_tables(p: Pipeline) -> dict[str, tuple[DataFrame, str]]:
    t = {
        "insight_trip": (p.insight_trip, "source_event_id"),
        "context_header": (p.context_header, "context_id"),
        "context_criteria": (p.context_criteria, "context_id"),
        "context_home": (p.context_home, "context_id"),
        "context_work": (p.context_work, "context_id"),
        "context_segment": (p.context_segment, "context_id"),
        "context_segment_attribute": (p.context_segment_attribute, "context_id"),
        "context_event": (p.context_event, "context_id"),
        "timeline_event": (p.timeline_event, "source_event_id"),
        "crash_event": (p.crash_event, "source_event_id"),
        "sdk_status": (p.sdk_status, "source_event_id"),
        "user_activity": (p.user_activity, "source_event_id"),
        "technical_event": (p.technical_event, "source_event_id"),
        "user_metadata": (p.user_metadata, "metadata_id"),
    }
    for ty, kind in S.CHILD_KIND.items():
        t[f"insight_{kind}"] = (p.child(ty), "source_event_id")
    return t


def _reconcile(spark, sf_dir) -> DataFrame:
    from tripweave.operators.quality import reconcile
    p = pipeline(spark, sf_dir).materialized(bare=True)
    return reconcile(p.accepted, _recon_tables(p), p.trips())


RECON_EXPECTED = """
tr AS (
  SELECT payload_id, count(*) FILTER (WHERE (ev_type = 'IN_TRANSPORT' OR transport_mode IS NOT NULL)
                                      AND NOT is_provisional) AS n_trips
  FROM (SELECT payload_id, ev_type, transport_mode, is_provisional FROM tl
        UNION ALL SELECT payload_id, ev_type, transport_mode, is_provisional FROM cx) GROUP BY payload_id
),
rx AS (
  SELECT id AS landing_id, 'DrivingInsights' AS tipo, 1 AS expected_rows,
         CASE WHEN is_provisional THEN 0 ELSE 1 END AS expected_trips FROM p WHERE NOT failed
  UNION ALL SELECT id, tipo, n_events, 0 FROM c WHERE status = 'PROCESSED'
  UNION ALL SELECT tlp.id, tlp.tipo, tlp.n_events, tr.n_trips FROM tlp JOIN tr ON tr.payload_id = tlp.id
  UNION ALL SELECT cxp.id, cxp.tipo,
         1 + CASE WHEN cxp.tipo = 'requestUserContext' THEN 1 ELSE 2 END
           + CASE WHEN user_num % 3 IN (0, 1) THEN 1 ELSE 0 END + 3 * n_segments + n_events, tr.n_trips
  FROM cxp JOIN tr ON tr.payload_id = cxp.id
  UNION ALL SELECT id, tipo, 1, CASE WHEN tipo = 'UserActivity' AND event_type IN ('click', 'purchase') THEN 1 ELSE 0 END
  FROM fl WHERE status = 'PROCESSED'
)"""


@query("reconcile_rows", O.sql("""
SELECT landing_id AS id, tipo, expected_rows, expected_rows AS actual_rows, expected_trips,
       expected_trips AS found_trips, 0 AS provisional_in_trip, 'PASS' AS status
FROM rx
""", *O.ALL, RECON_EXPECTED))
def reconcile_rows(spark, sf_dir):
    """Expected (payload arrays) vs actual (tables) per processed landing row."""
    return _reconcile(spark, sf_dir).select("id", "tipo", "expected_rows", "actual_rows", "expected_trips",
                                            "found_trips", "provisional_in_trip", "status")


@query("reconcile_summary", O.sql("""
SELECT tipo, 'PASS' AS status, count(*) AS n_rows,
       CAST(floor(count(*) * 10000 / (SELECT count(*) FROM rx)) AS BIGINT) AS share_bp
FROM rx GROUP BY tipo
""", *O.ALL, RECON_EXPECTED))
def reconcile_summary(spark, sf_dir):
    """PASS/FAIL totals per type with basis-point shares."""
    from tripweave.operators.quality import reconcile_summary as summary
    return summary(_reconcile(spark, sf_dir))


CHECKS = f"""
chk AS (
  SELECT id, tipo, 'source_event' AS check_name, 1 AS expected, 1 AS actual, 'PASS' AS result FROM st WHERE status = 'PROCESSED'
  UNION ALL SELECT id, 'DrivingInsights', 'insight_trip', 1, 1, 'PASS' FROM p WHERE NOT failed
  UNION ALL SELECT id, tipo, concat('insight_', CASE tipo {' '.join(f"WHEN '{t}' THEN '{kind}'" for t, kind in S.CHILD_KIND.items())} END),
         n_events, n_events, 'PASS' FROM c WHERE status = 'PROCESSED'
  UNION ALL SELECT id, tipo, 'parent', 1, CASE status WHEN 'PROCESSED' THEN 1 ELSE 0 END,
         CASE status WHEN 'PROCESSED' THEN 'PASS' ELSE 'FAIL' END FROM c WHERE status <> 'FAILED'
  UNION ALL SELECT id, tipo, 'transport_id', 1, 0, 'WARN' FROM c WHERE status = 'FAILED'
  UNION ALL SELECT id, tipo, 'timeline_event', n_events, n_events, 'PASS' FROM tlp
  UNION ALL SELECT id, tipo, unnest(['context_header', 'context_criteria', 'context_home', 'context_work', 'context_segment',
                                     'context_segment_attribute', 'context_event']), unnest(n), unnest(n), 'PASS'
  FROM (SELECT id, tipo, [1, CASE WHEN tipo = 'requestUserContext' THEN 1 ELSE 2 END, CAST(user_num % 3 = 0 AS INTEGER),
                          CAST(user_num % 3 = 1 AS INTEGER), n_segments, 2 * n_segments, n_events] AS n FROM cxp)
  UNION ALL SELECT id, tipo, CASE tipo WHEN 'VehicleCrash' THEN 'crash_event' WHEN 'SDKStatus' THEN 'sdk_status'
         WHEN 'UserActivity' THEN 'user_activity' WHEN 'TechnicalEvent' THEN 'technical_event' ELSE 'user_metadata' END,
         1, 1, 'PASS' FROM fl WHERE status = 'PROCESSED'
  UNION ALL SELECT id, tipo, unnest(['trip_present', 'trip_absent']), unnest([n, 0]), unnest([n, 0]), 'PASS' FROM (
    SELECT id, 'DrivingInsights' AS tipo, CASE WHEN is_provisional THEN 0 ELSE 1 END AS n FROM p WHERE NOT failed
    UNION ALL SELECT id, tipo, 1 FROM fl
    WHERE status = 'PROCESSED' AND tipo = 'UserActivity' AND event_type IN ('click', 'purchase')
    UNION ALL SELECT e.payload_id, any_value(e.tipo), count(*) FILTER (WHERE NOT is_provisional) FROM (
      SELECT payload_id, tlp.tipo, ev_type, transport_mode, is_provisional FROM tl JOIN tlp ON tlp.id = payload_id
      UNION ALL SELECT payload_id, cxp.tipo, ev_type, transport_mode, is_provisional FROM cx JOIN cxp ON cxp.id = payload_id) e
    WHERE ev_type = 'IN_TRANSPORT' OR transport_mode IS NOT NULL GROUP BY e.payload_id)
  UNION ALL SELECT id, tipo, 'validator', 1, 0, 'WARN' FROM st WHERE reason = 'unrouted_type'
  UNION ALL SELECT id, tipo, 'payload', 1, 0, 'ERROR' FROM st WHERE status = 'FAILED' AND reason <> 'missing_transport_id'
)"""


def _checks(spark, sf_dir) -> DataFrame:
    from tripweave.operators.quality import reconcile_checks as checks
    p = pipeline(spark, sf_dir).materialized(bare=True)
    return checks(p.resolved, _recon_tables(p), p.source_event, p.trips())


@query("reconcile_checks", O.sql("""
SELECT tipo, check_name, result, count(*) AS n_rows, CAST(sum(expected) AS BIGINT) AS n_expected,
       CAST(sum(actual) AS BIGINT) AS n_actual
FROM chk GROUP BY tipo, check_name, result
""", *O.ALL, CHECKS))
def reconcile_checks(spark, sf_dir):
    """Named checks of every landing row, by type and result."""
    return _checks(spark, sf_dir).groupBy("tipo", "check_name", "result").agg(
        F.count("*").alias("n_rows"), F.sum("expected").alias("n_expected"), F.sum("actual").alias("n_actual"))


@query("reconcile_faults", O.sql("""
, d AS (SELECT tipo, check_name, expected, CASE WHEN check_name = 'insight_harsh' THEN expected - CAST((id // 1000) % 10 = 1 AS INT)
               ELSE expected * (1 + CAST(id % 7 = 0 AS INT)) END AS actual FROM chk WHERE check_name IN ('insight_harsh', 'timeline_event'))
SELECT tipo, check_name, CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS result, count(*) AS n_rows,
       CAST(sum(expected) AS BIGINT) AS n_expected, CAST(sum(actual) AS BIGINT) AS n_actual
FROM d GROUP BY ALL
""", *O.ALL, CHECKS))
def reconcile_faults(spark, sf_dir):
    """R1-R7 over damaged tables: the first harsh event of every tenth order lost, every seventh timeline doubled."""
    from tripweave.operators.quality import reconcile_checks as checks
    p = pipeline(spark, sf_dir).materialized(bare=True)
    tables = _recon_tables(p)
    (harsh, key), (timeline, line_key) = tables["insight_harsh"], tables["timeline_event"]
    tables["insight_harsh"] = harsh.filter(~((F.col("pos") == 0) & (F.floor(F.col(key) / 1000) % 10 == 1))), key
    tables["timeline_event"] = timeline.unionByName(timeline.filter(F.col(line_key) % 7 == 0)), line_key
    found = checks(p.resolved, tables, p.source_event, p.trips()).filter(F.col("check_name").isin("insight_harsh", "timeline_event"))
    return found.groupBy("tipo", "check_name", "result").agg(
        F.count("*").alias("n_rows"), F.sum("expected").alias("n_expected"), F.sum("actual").alias("n_actual"))


@query("record_status", O.sql("""
SELECT id, tipo, CASE max(CASE result WHEN 'ERROR' THEN 4 WHEN 'FAIL' THEN 3 WHEN 'WARN' THEN 2 ELSE 1 END)
                 WHEN 4 THEN 'ERROR' WHEN 3 THEN 'FAIL' WHEN 2 THEN 'WARN' ELSE 'PASS' END AS status
FROM chk GROUP BY id, tipo
""", *O.ALL, CHECKS))
def record_status(spark, sf_dir):
    """PASS, WARN, FAIL or ERROR of every landing row."""
    from tripweave.operators.quality import record_status as status
    return status(_checks(spark, sf_dir))


@query("processed_scan", O.sql("""
SELECT id, tipo, user_id FROM st WHERE status = 'PROCESSED'
""", *O.ALL))
def processed_scan(spark, sf_dir):
    """O3: processed rows by ascending id."""
    from tripweave.operators.views import processed
    # stored: a global sort looks at its rows twice (it samples them for its ranges), the payloads are parsed once
    return processed(stored(pipeline(spark, sf_dir).landing_status, "status", compression="zstd")).select("id", "tipo", "user_id")


def _leaf_counts() -> str:
    """(tipo, path, payload, table, matched) of every leaf that the fixture rules give a payload or its rows, as SQL."""
    out: list[str] = []

    def add(source: str, tipo: str, leaves: dict[str, str | tuple[str, str, str]]) -> None:
        """``leaves``: path -> how many a source row has (everywhere), or (payload, table, matched)."""
        for path, n in leaves.items():
            both = n if isinstance(n, tuple) else (n, n, n)
            out.append(f"SELECT {tipo} AS tipo, '{path}' AS path, " + ", ".join(
                f"CAST(coalesce(sum({x}), 0) AS BIGINT) AS {c}" for x, c in zip(both, "ptm")) + f" FROM {source} GROUP BY 1")

    def lost(n: str = "1") -> tuple[str, str, str]:
        return n, "0", "0"

    moves, view = "CAST(event_type IN ('click', 'purchase') AS INT)", "CAST(event_type = 'view' AS INT)"
    click = "CAST(event_type = 'click' AS INT)"
    place = ("location.latitude", "location.longitude", "location.accuracy")
    times = ("startTime", "startTimeEpoch", "endTime", "endTimeEpoch")
    point = ("latitude", "longitude", "accuracy", "timestamp")
    tagged, routed = "CAST(o_orderstatus <> 'P' AS INT)", "CAST(k % 4 <> 0 AS INT)"
    add("p WHERE NOT failed", "'DrivingInsights'", {
        "transportEvent.id": "1", "transportEvent.isProvisional": "1", "transportEvent.distance": "1",
        "transportEvent.occupantRole": "CAST(occupant_role IS NOT NULL AS INT)",
        "transportEvent.transportTags.status": tagged, "transportEvent.transportTags.priority": tagged,
        **{f"transportEvent.{c}": lost() for c in (*times, "lastUpdateTime", "lastUpdateTimeEpoch", "durationInSeconds", "transportMode")},
        **{f"transportEvent.waypoints[].{c}": lost(f"2 * {routed}") for c in (*point, "speedLimitInMps")},
        "transportEvent.waypoints[].speedInMps": lost(f"{routed} * (1 + CAST(k % 3 <> 0 AS INT))"),
        "safetyScores.focusScore": "CAST(k % 5 <> 0 AS INT)",
        **{f"safetyScores.{c}": "1" for c in ("smoothScore", "legalScore", "overallScore", "attentionScore")}})
    lines = "c_lines l JOIN c ON c.k = l.l_orderkey AND c.tipo = l.tipo AND c.status = 'PROCESSED'"
    add("c WHERE status = 'PROCESSED'", "tipo", {"transportId": lost()})
    add(lines, "c.tipo", {**{f"events[].{c}": "1" for c in times},
                          **{f"events[].waypoints[].{c}": "l_suppkey % 3 + 1" for c in (*point, "speedInMps")}})
    add(f"{lines} WHERE c.tipo = '{S.HARSH}'", "c.tipo", {f"events[].{c}": "1" for c in ("magnitude", "confidence", "type")})
    add(f"{lines} WHERE c.tipo = '{S.PHONE}'", "c.tipo", {"events[].callState": "1"})
    mps, in_mps = "CAST(l_linestatus = 'F' AS INT)", "CAST(l_linestatus <> 'F' AS INT)"
    add(f"{lines} WHERE c.tipo = '{S.CALL}'", "c.tipo", {
        "events[].handsFreeState": "1",
        **{f"events[].{c}TraveledSpeedMps": (mps, "1", mps) for c in ("min", "max")},
        **{f"events[].{c}TraveledSpeedInMps": lost(in_mps) for c in ("min", "max")}})
    event = {**{f"events[].{c}": "1" for c in ("id", "type", *times, "lastUpdateTime", "lastUpdateTimeEpoch", "durationInSeconds",
                                              "isProvisional", "distance", *place)},
             "events[].transportMode": "CAST(transport_mode IS NOT NULL AS INT)", "events[].occupantRole": moves, "events[].transportTags.k": moves,
             **{f"events[].waypoints[].{c}": lost(f"2 * {moves}") for c in (*point, "speedInMps")},
             "events[].venue.significance": view, "events[].venue.type": view, **{f"events[].venue.{c}": lost(view) for c in place}}
    add("tl", "CASE WHEN day(CAST(ts AS DATE)) % 2 = 0 THEN 'TimelineEvents' ELSE 'TimelineUpdate' END", event)
    add("cx", "CASE WHEN day(CAST(ts AS DATE)) % 2 = 1 THEN 'UserContextUpdate' ELSE 'requestUserContext' END", event)
    heard, known = "CAST(tipo = 'UserContextUpdate' AS INT)", "CAST(user_num % 4 <> 0 AS INT)"
    home, work = "CAST(user_num % 3 = 0 AS INT)", "CAST(user_num % 3 = 1 AS INT)"
    add("cxp", "tipo", {
        "semanticTime": "1", **{f"lastKnownLocation.{c}": known for c in ("latitude", "longitude", "accuracy")},
        **{f"home.{c}": home for c in ("significance", "type", *place)}, **{f"work.{c}": work for c in ("significance", "type", *place)},
        "criteria[]": (f"2 * {heard}", f"1 + {heard}", f"2 * {heard}"),
        **{f"activeSegments[].{c}": "n_segments" for c in ("id", "category", "subcategory", "type", *times)},
        **{f"activeSegments[].attributes[].{c}": "2 * n_segments" for c in ("name", "value")}})

    def flat(tipo: str, leaves: dict) -> None:
        add(f"fl WHERE tipo = '{tipo}' AND status = 'PROCESSED'", "tipo", leaves)

    located = "CAST(event_id % 5 <> 0 AS INT)"
    flat(S.CRASH, {**{c: "1" for c in ("time", "magnitude", "speedAtImpact", "deltaV", "confidence", "severity", "detectorMode")},
                   **{c: located for c in (*place, "location.altitude")},
                   **{f"precedingLocations[].{c}": "user_id % 5" for c in ("latitude", "longitude", "accuracy", "altitude")}})
    available = "CAST(event_id % 3 <> 0 AS INT)"
    flat(S.STATUS, {**{c: "1" for c in ("startStatus", "detectionStatus", "locationPermission", "isPreciseLocationPermGranted",
                                       "wifiQuotaStatus", "mobileQuotaStatus", "diskQuotaStatus", "canDetect")},
                    "isLocationAvailable": (available, "1", available)})
    # the value column keeps Python's text: 17.0 and True differ from 17 and true
    same = "CASE event_id // 6 % 3 WHEN 0 THEN CAST(value <> floor(value) AS INT) WHEN 1 THEN 0 ELSE 1 END"
    flat(S.METADATA, {"label": "1", "value": ("1", "1", same)})
    flat(S.TECHNICAL, {"type": "1", "message": "1"})
    code, doc = "CAST(user_id % 2 = 0 AS INT)", "CAST(user_id % 2 = 1 AS INT)"
    flat(S.ACTIVITY, {
        "startTime": lost(), "activityType": (code, "1", code), "type": lost(doc),
        "tripType": (f"{code} * {click}", click, f"{code} * {click}"), "tripInfo.type": lost(f"{doc} * {click}"),
        **{f"stationaryLocation.{c}": (f"{code} * {view}", view, f"{code} * {view}") for c in ("latitude", "longitude")},
        **{f"stationaryInfo.location.{c}": lost(f"{doc} * {view}") for c in ("latitude", "longitude")}})
    return ("SELECT tipo, path, p AS n_payload, t AS n_table, m AS n_matched, p - m AS n_missing, t - m AS n_extra FROM (\n"
            + "\nUNION ALL ".join(out) + "\n) WHERE p + t > 0")


@query("payload_diff", O.sql(_leaf_counts(), *O.ALL))
def payload_diff(spark, sf_dir):
    """Every payload leaf of all 15 types against the rows made of it, order-insensitive with repetition."""
    from tripweave.operators.payload_diff import COLUMNS
    from tripweave.operators.payload_diff import payload_diff as diff
    p = pipeline(spark, sf_dir).materialized()
    tables = p.tables(trips=False)
    return diff(p.accepted.select("id", "tipo", "json"), {name: tables[name] for name in COLUMNS})


_POINTS = """
, m AS (SELECT 'DrivingInsights' AS tipo, CASE WHEN k % 4 <> 0 THEN 2 ELSE 0 END AS n FROM p WHERE NOT failed
  UNION ALL SELECT c.tipo, l_suppkey % 3 + 1 FROM c_lines l JOIN c ON c.k = l.l_orderkey AND c.tipo = l.tipo AND c.status = 'PROCESSED'
  UNION ALL SELECT CASE WHEN day(CAST(ts AS DATE)) % 2 = 0 THEN 'TimelineEvents' ELSE 'TimelineUpdate' END, 2 FROM tl
            WHERE event_type IN ('click', 'purchase')
  UNION ALL SELECT CASE WHEN day(CAST(ts AS DATE)) % 2 = 1 THEN 'UserContextUpdate' ELSE 'requestUserContext' END, 2 FROM cx
            WHERE event_type IN ('click', 'purchase'))
SELECT tipo, json_extract_string(json_array(concat('<', n, ' waypoints>')), '$[0]') AS marker, count(*) AS n_markers
FROM m GROUP BY tipo, marker
"""


@query("payload_redacted", O.sql(_POINTS, *O.ALL))
def payload_redacted(spark, sf_dir):
    """Payloads with every waypoint list, at any depth, replaced by a marker of its size; the lists that are left, and the markers."""
    from tripweave.operators.parse import accepted
    from tripweave.operators.trees import leaves, redacted_json
    acc = accepted(pipeline(spark, sf_dir).judged).select("tipo", redacted_json(F.expr("try_parse_json(json)")).alias("text"))
    found = acc.select("tipo", F.explode(leaves(F.expr("try_parse_json(text)"))).alias("x"))
    return found.filter(F.col("x.path").contains("waypoints[]")).groupBy("tipo", F.col("x.value").alias("marker")).agg(
        F.count("*").alias("n_markers"))


_SIMPLE = """
, n AS (SELECT tipo, least(n_events, 3) AS n, 'events[].startTime' AS path, 'events[].waypoints' AS masked FROM c WHERE status = 'PROCESSED'),
 o AS (SELECT tipo, path, n FROM n UNION ALL SELECT tipo, masked, n FROM n
  UNION ALL SELECT tipo, u.path, u.n FROM cxp, (SELECT unnest([
      {'path': concat(w, 'activeSegments[].id'), 'n': least(n_segments, 3)},
      {'path': concat(w, 'activeSegments[].attributes[].name'), 'n': 2 * least(n_segments, 3)},
      {'path': concat(w, 'events[].id'), 'n': least(n_events, 3)}], recursive := true)
    FROM (SELECT CASE WHEN tipo = 'UserContextUpdate' THEN 'userContext.' ELSE '' END AS w)) u
  UNION ALL SELECT tipo, CASE WHEN user_num % 2 = 0 THEN 'events[].id' ELSE '[].id' END, least(n_events, 3) FROM tlp
  UNION ALL SELECT 'DrivingInsights', u.path, u.n FROM p, (SELECT unnest([
      {'path': 'transportEvent.id', 'n': 1}, {'path': 'safetyScores.focusScore', 'n': CAST(k % 5 <> 0 AS INT)},
      {'path': 'transportEvent.waypoints', 'n': CAST(k % 4 <> 0 AS INT)},
      {'path': 'transportEvent.transportTags', 'n': CAST(o_orderstatus <> 'P' AS INT)}], recursive := true)) u WHERE NOT failed)
SELECT tipo, path, CAST(sum(n) AS BIGINT) AS n_leaves FROM o GROUP BY tipo, path HAVING sum(n) > 0
"""
#: The paths that every element of a list has, and the marks.
_SIMPLE_OF = {S.DRIVING_INSIGHTS: ("transportEvent.id", "transportEvent.waypoints", "transportEvent.transportTags", "safetyScores.focusScore"),
              **{t: ("events[].startTime", "events[].waypoints") for t in S.CHILD_TYPES},
              **{t: ("events[].id", "[].id") for t in S.TIMELINE_TYPES},
              S.CONTEXT_MANUAL: ("activeSegments[].id", "activeSegments[].attributes[].name", "events[].id"),
              S.CONTEXT_LISTENER: ("userContext.activeSegments[].id", "userContext.activeSegments[].attributes[].name", "userContext.events[].id")}


@query("payload_simplified", O.sql(_SIMPLE, *O.ALL))
def payload_simplified(spark, sf_dir):
    """Simplified payloads (no nulls, waypoints and tags masked, the first three of every list), by the leaves that are left."""
    from tripweave.operators.parse import accepted
    from tripweave.operators.trees import leaves, simplified_json
    acc = accepted(pipeline(spark, sf_dir).judged).select("tipo", simplified_json(F.expr("try_parse_json(json)")).alias("text"))
    found = acc.select("tipo", F.explode(leaves(F.expr("try_parse_json(text)"))).alias("x")).filter("x.value IS NOT NULL")
    wanted = F.lit(False)
    for tipo, paths in _SIMPLE_OF.items():
        wanted = wanted | ((F.col("tipo") == tipo) & F.col("x.path").isin(*paths))
    return found.filter(wanted).groupBy("tipo", F.col("x.path").alias("path")).agg(F.count("*").alias("n_leaves"))


@query("enum_violations", O.sql("""
SELECT 'trip' AS table_name, 'transport_mode' AS column_name,
       CASE WHEN event_type = 'click' THEN 'TRIP_TYPE_SDK' END AS value, count(*) AS n_rows
FROM fl WHERE tipo = 'UserActivity' AND status = 'PROCESSED' AND event_type IN ('click', 'purchase') GROUP BY 3
UNION ALL
SELECT 'trip', 'first_seen_from', 'ACTIVITY', count(*)
FROM fl WHERE tipo = 'UserActivity' AND status = 'PROCESSED' AND event_type IN ('click', 'purchase')
UNION ALL
SELECT 'trip', 'occupant_role', 'LOW', count(DISTINCT (user_id, canonical_id))
FROM p WHERE NOT failed AND NOT is_provisional AND occupant_role = 'LOW'
UNION ALL
SELECT 'insight_harsh', 'harsh_type', 'TURNING', count(*)
FROM c_lines WHERE tipo = 'DrivingInsightsHarshEvents' AND l_returnflag NOT IN ('A', 'N')
  AND l_orderkey % 10 <> 9 AND l_orderkey % 997 <> 0
UNION ALL
SELECT 'landing', 'tipo', tipo, count(*) FROM st
WHERE tipo NOT IN ('UserContextUpdate', 'requestUserContext', 'TimelineUpdate', 'DrivingInsightsReady', 'CrashEvent')
GROUP BY tipo
""", *O.ALL))
def enum_violations(spark, sf_dir):
    """Closed-enum checks reported per offending value."""
    from tripweave.operators.quality import enum_violations as check
    p = pipeline(spark, sf_dir).materialized(bare=True)
    return check({
        "timeline_event": p.timeline_event, "trip": p.trips(), "insight_harsh": p.child(S.HARSH),
        "crash_event": p.crash_event, "context_segment": p.context_segment,
        "context_criteria": p.context_criteria, "landing": p.landing,
    })


#: What the foreign-key report looks at: landing rows purged by age, audit rows and trips of former years removed without their children.
PURGED_AT, AUDITED_SINCE, AUDITED_UNTIL = "2024-02-10 00:00:00", "2024-01-01 00:00:00", "1998-01-01 00:00:00"


def _children_sql(measure: str) -> str:
    """(fk_name, n_rows, n) over all satellite rows; ``measure`` is a condition on the payload's ``created_at``."""
    parts = [f"SELECT 'insight_trip.source_event_id' AS fk_name, 1 AS n, created_at FROM p WHERE NOT failed"]
    parts += [f"SELECT 'insight_{kind}.source_event_id', n_events, created_at FROM c WHERE status = 'PROCESSED' AND tipo = '{t}'"
              for t, kind in S.CHILD_KIND.items()]
    parts += ["SELECT 'timeline_event.source_event_id', n_events, created_at FROM tlp",
              "SELECT 'context_header.source_event_id', 1, created_at FROM cxp", "SELECT 'context_event.context_id', n_events, created_at FROM cxp",
              "SELECT 'context_segment.context_id', n_segments, created_at FROM cxp"]
    parts += [f"SELECT '{name}.source_event_id', 1, ts FROM fl WHERE status = 'PROCESSED' AND tipo = '{tipo}'" for name, tipo in (
        ("crash_event", S.CRASH), ("sdk_status", S.STATUS), ("user_activity", S.ACTIVITY), ("technical_event", S.TECHNICAL))]
    return (f"SELECT fk_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE {measure}), 0) AS BIGINT) AS n FROM (\n"
            + "\nUNION ALL ".join(parts) + "\n) GROUP BY fk_name")


@query("fk_orphans", O.sql(f"""
, sat AS ({_children_sql(f"created_at < TIMESTAMP '{AUDITED_SINCE}'")})
SELECT fk_name, 'CASCADE' AS on_delete, n_rows, n AS n_orphans FROM sat
UNION ALL SELECT 'source_event.landing_id', 'NO ACTION', count(*),
  count(*) FILTER (WHERE created_at < TIMESTAMP '{PURGED_AT}' - INTERVAL 30 DAY)
  FROM st WHERE status = 'PROCESSED' AND created_at >= TIMESTAMP '{AUDITED_SINCE}'
UNION ALL SELECT 'insight_trip.trip_id', 'NO ACTION', count(*), count(*) FILTER (WHERE NOT is_provisional) FROM p WHERE NOT failed
""", *O.ALL))
def fk_orphans(spark, sf_dir):
    """The 16 documented foreign keys after a purge that took no children along (report, not enforce)."""
    from tripweave.operators.quality import fk_orphans as check
    from tripweave.operators.retention import resolved_purge_plan
    p = pipeline(spark, sf_dir).materialized(bare=True)
    tables = p.tables()
    kept = resolved_purge_plan(p.resolved, PURGED_AT).filter(F.col("action") == "keep")
    since = F.lit(AUDITED_SINCE).cast("timestamp_ntz")
    return check({**tables, "landing": kept, "source_event": tables["source_event"].filter(F.col("created_at") >= since),
                  "trip": tables["trip"].filter(F.col("updated_at") >= since)})


@query("cascade_plan", O.sql(f"""
, sat AS ({_children_sql(f"created_at < TIMESTAMP '{AUDITED_UNTIL}'")}),
t AS (SELECT user_id, canonical_id, count(*) FILTER (WHERE created_at < TIMESTAMP '{AUDITED_UNTIL}') AS d,
             count(*) FILTER (WHERE created_at >= TIMESTAMP '{AUDITED_UNTIL}') AS b
      FROM p WHERE NOT failed AND NOT is_provisional GROUP BY 1, 2)
SELECT fk_name, 'CASCADE' AS on_delete, n AS n_deleted, 0::BIGINT AS n_blocking FROM sat
UNION ALL SELECT 'source_event.landing_id', 'NO ACTION', count(*), 0 FROM st
  WHERE status = 'PROCESSED' AND created_at < TIMESTAMP '{AUDITED_UNTIL}'
UNION ALL SELECT 'insight_trip.trip_id', 'NO ACTION', CAST(coalesce(sum(d), 0) AS BIGINT), CAST(coalesce(sum(b), 0) AS BIGINT) FROM t WHERE d > 0
""", *O.ALL))
def cascade_plan(spark, sf_dir):
    """What the deletion of old audit rows takes along, and what it must not."""
    from tripweave.operators.quality import cascade_plan as plan
    p = pipeline(spark, sf_dir).materialized(bare=True)
    tables = p.tables()
    seeds = tables["source_event"].filter(F.col("created_at") < F.lit(AUDITED_UNTIL).cast("timestamp_ntz")).select("source_event_id")
    return plan(seeds, tables)


_HASHED = (S.DRIVING_INSIGHTS, *S.CHILD_TYPES, *S.TIMELINE_TYPES, S.CONTEXT_LISTENER)


@query("unseen_payloads", O.sql(f"""
SELECT tipo, count(*) AS n_rows FROM (
  SELECT tipo, created_at, CASE WHEN tipo = 'DrivingInsights' THEN min(created_at) OVER (PARTITION BY tipo, id // 1000) ELSE created_at END AS first_at
  FROM st WHERE tipo IN ({', '.join(f"'{t}'" for t in _HASHED)}))
WHERE first_at >= TIMESTAMP '{AUDITED_UNTIL}' GROUP BY tipo
""", *O.ALL))
def unseen_payloads(spark, sf_dir):
    """Payloads whose hash was not audited before a date; the audited hashes are stored in buckets and not moved by the look-up."""
    from tripweave.operators.dedup import already_seen, store_seen
    tune(spark)
    land = derive_landing(spark, sf_dir).filter(F.col("tipo").isin(*_HASHED)).select("tipo", "created_at", F.sha2("json", 256).alias("payload_hash"))
    name = f"seen_{uuid.uuid4().hex[:12]}"
    store_seen(land.filter(F.col("created_at") < F.lit(AUDITED_UNTIL).cast("timestamp_ntz")), name, _folder(spark, name))
    return already_seen(land, spark.table(name)).groupBy("tipo").agg(F.count("*").alias("n_rows"))


@query("version_check", O.sql("""
SELECT tipo, count(*) AS n_rows, count(*) FILTER (WHERE NOT regexp_full_match(app_version, '\\d+\\.\\d+\\.\\d+')) AS n_invalid
FROM st GROUP BY tipo
""", *O.ALL))
def version_check(spark, sf_dir):
    """P25: app_version whitelist per type."""
    from tripweave.operators.quality import version_check as check
    return check(derive_landing(spark, sf_dir))


# ---------------------------------------------------------------------------
# Retention L1, L3
# ---------------------------------------------------------------------------

AS_OF = "2024-02-01 00:00:00"


@query("raw_purge", O.sql(f"""
SELECT tipo, CASE WHEN status = 'PROCESSED' AND created_at < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY
                  THEN 'purge' ELSE 'keep' END AS action, count(*) AS n_rows
FROM st GROUP BY 1, 2
""", *O.ALL))
def raw_purge(spark, sf_dir):
    """L1: processed rows older than 30 days (min 7) as of a fixed date."""
    from tripweave.operators.retention import resolved_purge_plan
    return resolved_purge_plan(pipeline(spark, sf_dir).resolved, AS_OF).groupBy("tipo", "action").agg(
        F.count("*").alias("n_rows"))


@query("cold_purge", O.sql(f"""
SELECT first_seen_from, count(*) AS n_trips,
       count(*) FILTER (WHERE start_time < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY) AS n_cold,
       count(*) FILTER (WHERE NOT coalesce(start_time < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY, false)
                        AND n_waypoints IS NOT NULL) AS n_with_waypoints
FROM (SELECT user_id, canonical_id, first(first_seen_from ORDER BY ord) AS first_seen_from,
             first(start_time ORDER BY ord) AS start_time, first(n_waypoints ORDER BY ord) AS n_waypoints
      FROM cand GROUP BY 1, 2)
GROUP BY 1
""", O.PARENTS, O.TIMELINE, O.CONTEXT, O.FLAT, TRIP_CANDIDATES))
def cold_purge(spark, sf_dir):
    """L3: trips older than 90 days keep the row, lose waypoints and tags."""
    from tripweave.operators.retention import cold_purge as purge
    t = purge(pipeline(spark, sf_dir).trips(), AS_OF)
    return t.groupBy("first_seen_from").agg(
        F.count("*").alias("n_trips"), F.sum(F.col("is_cold").cast("int")).cast("bigint").alias("n_cold"),
        F.sum(F.col("waypoints").isNotNull().cast("int")).cast("bigint").alias("n_with_waypoints"))


# ---------------------------------------------------------------------------
# X12-X14 generators, M1-M9 marts
# ---------------------------------------------------------------------------

TRIP_POINTS = """
wp_cand AS (
  SELECT user_id, canonical_id, id::HUGEINT * 10000000000 AS ord, 0 AS point_pos,
         40.0::DOUBLE + (o_custkey % 1000) / 1000.0::DOUBLE AS latitude,
         -3.0::DOUBLE - (k % 1000) / 1000.0::DOUBLE AS longitude,
         epoch_ms(o_orderdate) AS point_epoch, (k % 40) + 0.5::DOUBLE AS speed_mps
  FROM p WHERE NOT failed AND NOT is_provisional AND k % 4 <> 0
  UNION ALL
  SELECT user_id, canonical_id, id::HUGEINT * 10000000000, 1,
         (40.0::DOUBLE + (o_custkey % 1000) / 1000.0::DOUBLE) + 0.01::DOUBLE,
         (-3.0::DOUBLE - (k % 1000) / 1000.0::DOUBLE) - 0.01::DOUBLE,
         epoch_ms(o_orderdate + to_seconds(dur)), CASE WHEN k % 3 <> 0 THEN (o_custkey % 30) + 0.25::DOUBLE END
  FROM p WHERE NOT failed AND NOT is_provisional AND k % 4 <> 0
  UNION ALL
  SELECT uid, event_key, payload_id::HUGEINT * 10000000000 + pos, 0, 50.0::DOUBLE + user_id / 10000.0::DOUBLE,
         4.0::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE, start_time_epoch, value / 10.0::DOUBLE
  FROM tl WHERE ev_type = 'IN_TRANSPORT' AND NOT is_provisional
  UNION ALL
  SELECT uid, event_key, payload_id::HUGEINT * 10000000000 + pos, 1, (50.0::DOUBLE + user_id / 10000.0::DOUBLE) + 0.02::DOUBLE,
         (4.0::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE) + 0.02::DOUBLE, end_time_epoch, value / 20.0::DOUBLE
  FROM tl WHERE ev_type = 'IN_TRANSPORT' AND NOT is_provisional
  UNION ALL
  SELECT uid, event_key, payload_id::HUGEINT * 10000000000 + pos, 0, 50.0::DOUBLE + user_id / 10000.0::DOUBLE,
         4.0::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE, start_time_epoch, value / 10.0::DOUBLE
  FROM cx WHERE ev_type = 'IN_TRANSPORT' AND NOT is_provisional
  UNION ALL
  SELECT uid, event_key, payload_id::HUGEINT * 10000000000 + pos, 1, (50.0::DOUBLE + user_id / 10000.0::DOUBLE) + 0.02::DOUBLE,
         (4.0::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE) + 0.02::DOUBLE, end_time_epoch, value / 20.0::DOUBLE
  FROM cx WHERE ev_type = 'IN_TRANSPORT' AND NOT is_provisional
),
fw AS (SELECT user_id, canonical_id, min(ord) AS ord FROM cand GROUP BY 1, 2),
pts AS (SELECT w.* FROM wp_cand w JOIN fw USING (user_id, canonical_id, ord))"""

_TRIP_FRAGS = (O.PARENTS, O.TIMELINE, O.CONTEXT, O.FLAT, TRIP_CANDIDATES, TRIP_POINTS)


@query("waypoint_points", O.sql("""
SELECT user_id, canonical_id, point_pos, latitude, longitude, point_epoch, speed_mps FROM pts
""", *_TRIP_FRAGS))
def waypoint_points(spark, sf_dir):
    """Trip waypoints -> point rows (first writer's route)."""
    from tripweave.operators.handlers import waypoint_points as points
    return points(pipeline(spark, sf_dir).trips(), ["user_id", "canonical_id"]).select(
        "user_id", "canonical_id", "point_pos", "latitude", "longitude", "point_epoch", "speed_mps")


@query("preceding_points", O.sql("""
SELECT id AS crash_event_id, i AS point_pos,
       CASE WHEN event_id % 83 = 0 THEN 500.0::DOUBLE ELSE 50.0::DOUBLE + user_id / 10000.0::DOUBLE END - i * 0.001::DOUBLE AS latitude,
       (4.0::DOUBLE + (event_id % 1000) / 1000.0::DOUBLE) - i * 0.001::DOUBLE AS longitude,
       value AS altitude
FROM fl, range(0, 5) r(i)
WHERE tipo = 'VehicleCrash' AND status = 'PROCESSED' AND i < user_id % 5
""", O.FLAT))
def preceding_points(spark, sf_dir):
    """Crash preceding locations -> point rows, as reported: they have no declared range (the payload's own location does)."""
    from tripweave.operators.handlers import preceding_points as points
    return points(pipeline(spark, sf_dir).crash_event).select(
        "crash_event_id", "point_pos", "latitude", "longitude", "altitude")


@query("tag_rows", O.sql("""
SELECT user_id, canonical_id, 'status' AS tag_key, o_orderstatus AS tag_value
FROM p JOIN (SELECT user_id, canonical_id, min(ord) AS ord FROM cand GROUP BY 1, 2) f USING (user_id, canonical_id)
WHERE f.ord = p.id::HUGEINT * 10000000000 AND o_orderstatus <> 'P' AND NOT failed AND NOT is_provisional
UNION ALL
SELECT user_id, canonical_id, 'priority', o_orderpriority
FROM p JOIN (SELECT user_id, canonical_id, min(ord) AS ord FROM cand GROUP BY 1, 2) f USING (user_id, canonical_id)
WHERE f.ord = p.id::HUGEINT * 10000000000 AND o_orderstatus <> 'P' AND NOT failed AND NOT is_provisional
UNION ALL
SELECT e.uid, e.event_key, 'k', CAST(e.k AS VARCHAR)
FROM (SELECT uid, event_key, k, payload_id::HUGEINT * 10000000000 + pos AS ord FROM tl WHERE ev_type = 'IN_TRANSPORT' AND NOT is_provisional
      UNION ALL
      SELECT uid, event_key, k, payload_id::HUGEINT * 10000000000 + pos FROM cx WHERE ev_type = 'IN_TRANSPORT' AND NOT is_provisional) e
JOIN (SELECT user_id, canonical_id, min(ord) AS ord FROM cand GROUP BY 1, 2) f
  ON f.user_id = e.uid AND f.canonical_id = e.event_key AND f.ord = e.ord
""", *_TRIP_FRAGS))
def tag_rows(spark, sf_dir):
    """Trip transport tags -> (key, value) rows."""
    from tripweave.operators.handlers import tag_rows as tags
    return tags(pipeline(spark, sf_dir).trips(), ["user_id", "canonical_id"])


_ROUTE = """
route AS (
  SELECT user_id, canonical_id, count(*) AS n_points,
         arg_min(latitude, point_pos) AS inicio_lat, arg_min(longitude, point_pos) AS inicio_lng,
         arg_max(latitude, point_pos) AS fin_lat, arg_max(longitude, point_pos) AS fin_lng,
         arg_min(point_epoch, point_pos) AS inicio_epoch, arg_max(point_epoch, point_pos) AS fin_epoch,
         max(coalesce(speed_mps, 0.0)) AS maxima_velocidad_mps
  FROM pts GROUP BY 1, 2
),
trips_last AS (
  SELECT user_id, canonical_id, last(distance_meters ORDER BY ord) AS distance_meters,
         last(transport_mode ORDER BY ord) AS transport_mode, first(start_time ORDER BY ord) AS start_time,
         last(end_time ORDER BY ord) AS end_time, last(duration_in_seconds ORDER BY ord) AS duration_in_seconds
  FROM cand GROUP BY 1, 2
)"""


@query("route_summary", O.sql("""
SELECT r.user_id AS usuario, r.canonical_id AS viaje, CAST(t.distance_meters AS DOUBLE) AS distancia_m,
       n_points, inicio_lat, inicio_lng, inicio_epoch, fin_lat, fin_lng, fin_epoch,
       round(maxima_velocidad_mps * 3.6, 1) AS maxima_velocidad
FROM route r JOIN trips_last t USING (user_id, canonical_id)
""", *_TRIP_FRAGS, _ROUTE))
def route_summary(spark, sf_dir):
    """M2 + A8: route geometry per trip (first/last point, max speed), its JSON columns read back."""
    from tripweave.operators.marts import route_mart
    r = route_mart(pipeline(spark, sf_dir).trips())

    def end(col: str, field: str, cast: str):
        return F.get_json_object(col, f"$.{field}").cast(cast)

    ends = [e for c in ("inicio", "fin") for e in (
        end(f"ubicacion_{c}", "latitude", "double").alias(f"{c}_lat"),
        end(f"ubicacion_{c}", "longitude", "double").alias(f"{c}_lng"),
        end(f"ubicacion_{c}", "timestamp", "bigint").alias(f"{c}_epoch"))]
    return r.select("usuario", "viaje", "distancia_m", F.json_array_length("puntos_recorrido").alias("n_points"),
                    *ends, "maxima_velocidad")


def _polyline_chars(delta: str) -> str:
    """SQL text of one signed delta in the public polyline encoding (the deltas of degrees need 7 chunks at most)."""
    z = f"(CASE WHEN {delta} < 0 THEN -2 * {delta} - 1 ELSE 2 * {delta} END)"
    return "concat(" + ", ".join(
        f"CASE WHEN {i} = 0 OR {z} >= {32 ** i} THEN "
        f"chr(CAST(({z} // {32 ** i}) % 32 + CASE WHEN {z} >= {32 ** (i + 1)} THEN 95 ELSE 63 END AS INTEGER)) END"
        for i in range(7)) + ")"


@query("route_polyline", O.sql(f"""
, rounded AS (
  SELECT user_id, canonical_id, point_pos, CAST(floor(latitude * 100000 + 0.5::DOUBLE) AS BIGINT) AS la,
         CAST(floor(longitude * 100000 + 0.5::DOUBLE) AS BIGINT) AS lo
  FROM pts
),
deltas AS (
  SELECT user_id, canonical_id, point_pos, la - coalesce(lag(la) OVER w, 0) AS dla, lo - coalesce(lag(lo) OVER w, 0) AS dlo
  FROM rounded WINDOW w AS (PARTITION BY user_id, canonical_id ORDER BY point_pos)
)
SELECT user_id AS usuario, canonical_id AS viaje,
       string_agg(concat({_polyline_chars('dla')}, {_polyline_chars('dlo')}), '' ORDER BY point_pos) AS polyline
FROM deltas GROUP BY 1, 2
""", *_TRIP_FRAGS))
def route_polyline(spark, sf_dir):
    """M2 polyline, encoded with native expressions."""
    from tripweave.operators.marts import route_mart
    return route_mart(pipeline(spark, sf_dir).trips()).select("usuario", "viaje", "polyline")


@query("mart_trip", O.sql("""
, sources AS (
  SELECT user_id, canonical_id, true AS motorised FROM p WHERE NOT failed AND NOT is_provisional
  UNION
  SELECT x.uid, x.event_key, false FROM cx x JOIN cxp ON cxp.id = x.payload_id
  WHERE cxp.tipo = 'UserContextUpdate' AND (ev_type = 'IN_TRANSPORT' OR transport_mode IS NOT NULL) AND NOT is_provisional
)
SELECT CAST(NULL AS INTEGER) AS IdOffload, CAST(NULL AS DATE) AS FechaOffload,
       t.user_id AS usuario, t.canonical_id AS viaje, t.transport_mode AS modo_transporte,
       t.start_time AS comienzo, t.end_time AS fin, CAST(t.duration_in_seconds AS INTEGER) AS duracion,
       '[]' AS metadata, round(r.maxima_velocidad_mps * 3.6, 1) AS velocidad_maxima
FROM trips_last t
JOIN sources s ON s.user_id = t.user_id AND s.canonical_id = t.canonical_id
     AND s.motorised = coalesce(t.transport_mode IN ('CAR', 'MOTORCYCLE', 'BUS'), false)
LEFT JOIN route r ON r.user_id = t.user_id AND r.canonical_id = t.canonical_id
""", *_TRIP_FRAGS, O.CX_PAYLOADS, _ROUTE))
def mart_trip(spark, sf_dir):
    """M1 Transporte."""
    from tripweave.operators.marts import trip_mart
    from tripweave.operators.trips import current_transports
    p = pipeline(spark, sf_dir)
    return trip_mart(p.trips(), p.insight_trip, current_transports(p.accepted_alone))


@query("mart_role", O.sql("""
SELECT user_id AS usuario, canonical_id AS viaje, last(occupant_role ORDER BY id) AS ocupante,
       last(created_at ORDER BY id) AS registro
FROM p WHERE NOT failed AND NOT is_provisional GROUP BY 1, 2
""", O.PARENTS))
def mart_role(spark, sf_dir):
    """M3 Conduccion."""
    from tripweave.operators.marts import role_mart
    p = pipeline(spark, sf_dir).reporting()
    return role_mart(p.trips(columns=("updated_at", "occupant_role")), p.insight_trip).select("usuario", "viaje", "ocupante", "registro")


def _events_counts(df: DataFrame) -> DataFrame:
    arrays = [c for c in df.columns if c not in ("IdOffload", "FechaOffload", "usuario", "viaje", "celular_fijo", "pantalla")]
    return df.select("usuario", "viaje", *[F.json_array_length(c).alias(f"n_{c}") for c in arrays],
                     "celular_fijo", "pantalla")


def _events_oracle(extra_harsh: str, speeding: str = "exceso_de_velocidad") -> str:
    cats = {
        "aceleracion": "tipo = 'DrivingInsightsHarshEvents' AND l_returnflag = 'A'" + extra_harsh,
        "frenado": "tipo = 'DrivingInsightsHarshEvents' AND l_returnflag = 'N'" + extra_harsh,
        "curvas": "tipo = 'DrivingInsightsHarshEvents' AND l_returnflag NOT IN ('A', 'N')" + extra_harsh,
        "uso_telefono": "tipo = 'DrivingInsightsPhoneEvents'",
        "llamados": "tipo = 'DrivingInsightsCallEvents'",
        speeding: "tipo = 'DrivingInsightsSpeedingEvents' AND l.l_orderkey % 53 <> 0",
    }
    sums = ", ".join(f"coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS n_{col}" for col, cond in cats.items())
    return O.sql(f"""
SELECT t.user_id AS usuario, t.canonical_id AS viaje, {sums}, '[]' AS celular_fijo, '[]' AS pantalla
FROM (SELECT DISTINCT user_id, canonical_id, k FROM p WHERE NOT failed) t
LEFT JOIN c_lines l ON l.l_orderkey = t.k AND t.canonical_id = concat('t', t.k) AND l.l_orderkey % 997 <> 0
GROUP BY 1, 2
""", O.PARENTS, O.CHILDREN)


def _events_mart(spark, sf_dir, *thresholds: float) -> DataFrame:
    from tripweave.operators.handlers import child_items
    from tripweave.operators.marts import EVENT_TYPES, events_mart
    p = pipeline(spark, sf_dir)
    return events_mart(p.insight_trip, child_items(p.accepted, *EVENT_TYPES), *thresholds)


@query("mart_events", _events_oracle(""))
def mart_events(spark, sf_dir):
    """M4 Eventos: JSON arrays per category (sizes; their content is ``mart_event_items``)."""
    return _events_counts(_events_mart(spark, sf_dir))


SIGNIFICANT_MAGNITUDE = 25.0
SIGNIFICANT_CONFIDENCE = 50.0


@query("mart_significant", _events_oracle(
    f" AND l_quantity >= {SIGNIFICANT_MAGNITUDE} AND CAST(l_discount * 1000.0 AS DECIMAL(6,3)) >= {SIGNIFICANT_CONFIDENCE}",
    speeding="exceso_velocidad"))
def mart_significant(spark, sf_dir):
    """M5 EventosSignificantes: M4 with magnitude / confidence thresholds."""
    return _events_counts(_events_mart(spark, sf_dir, SIGNIFICANT_MAGNITUDE, SIGNIFICANT_CONFIDENCE))


_ITEM = ("array<struct<startTimeEpoch:bigint,endTimeEpoch:bigint,magnitude:double,confidence:double,type:string,"
         "callState:string,minTraveledSpeedMps:double,minTraveledSpeedInMps:double,handsFreeState:string,"
         "waypoints:array<struct<latitude:double,timestamp:bigint>>>>")


@query("mart_event_items", O.sql(f"""
SELECT t.user_id AS usuario, t.canonical_id AS viaje,
       CASE l_linenumber WHEN 2 THEN 'uso_telefono' WHEN 3 THEN 'llamados' WHEN 4 THEN 'exceso_de_velocidad'
            ELSE CASE l_returnflag WHEN 'A' THEN 'aceleracion' WHEN 'N' THEN 'frenado' ELSE 'curvas' END END AS columna,
       epoch_ms(l_shipdate + to_seconds(l_partkey % 3600)) AS start_epoch,
       epoch_ms(l_shipdate + to_seconds(l_partkey % 3600 + l_linenumber * 10)) AS end_epoch,
       CASE WHEN ordinal = 1 THEN CAST(l_quantity AS DOUBLE) END AS magnitude,
       CASE WHEN ordinal = 1 THEN round(CAST(l_discount AS DOUBLE) * 1000, 3) END AS confidence,
       CASE WHEN ordinal = 1 THEN {_HARSH_TYPE} END AS harsh_type,
       CASE WHEN ordinal = 2 THEN CASE l_returnflag WHEN 'A' THEN 'NO_CALL' WHEN 'N' THEN 'CALL_IN_PROGRESS'
                                  ELSE 'UNAVAILABLE' END END AS call_state,
       CASE WHEN ordinal = 3 THEN round(CAST(l_discount AS DOUBLE) * 100, 3) END AS min_speed,
       CASE WHEN ordinal = 3 THEN CASE l_returnflag WHEN 'A' THEN 'HANDS_FREE' WHEN 'N' THEN 'HANDHELD'
                                  ELSE 'UNAVAILABLE' END END AS hands_free_state,
       CAST(l_suppkey % 3 + 1 AS INTEGER) AS n_waypoints,
       epoch_ms(l_shipdate + to_seconds(l_partkey % 3600)) AS first_point_epoch
FROM (SELECT DISTINCT user_id, canonical_id, k FROM p WHERE NOT failed) t
JOIN c_lines l ON l.l_orderkey = t.k AND t.canonical_id = concat('t', t.k) AND l.l_orderkey % 997 <> 0
WHERE ordinal <> 5 AND NOT (ordinal = 4 AND l.l_orderkey % 53 = 0)
""", O.PARENTS, O.CHILDREN))
def mart_event_items(spark, sf_dir):
    """M4/A10: every item of the mart's JSON arrays, read back from their text."""
    from tripweave.operators.marts import EVENT_COLUMNS
    m = _events_mart(spark, sf_dir)
    arrays = F.array(*[F.struct(F.lit(c).alias("columna"), F.from_json(c, _ITEM).alias("items")) for c in EVENT_COLUMNS])
    rows = m.select("usuario", "viaje", F.inline(arrays)).select("usuario", "viaje", "columna", F.explode("items").alias("i"))
    return rows.select(
        "usuario", "viaje", "columna", F.col("i.startTimeEpoch").alias("start_epoch"),
        F.col("i.endTimeEpoch").alias("end_epoch"), "i.magnitude", F.round("i.confidence", 3).alias("confidence"),
        F.col("i.type").alias("harsh_type"), F.col("i.callState").alias("call_state"),
        F.round(F.coalesce("i.minTraveledSpeedMps", "i.minTraveledSpeedInMps"), 3).alias("min_speed"),
        F.col("i.handsFreeState").alias("hands_free_state"), F.size("i.waypoints").alias("n_waypoints"),
        F.element_at("i.waypoints", 1)["timestamp"].alias("first_point_epoch"))


@query("mart_scores_primary", O.sql("""
SELECT CAST(NULL AS INTEGER) AS IdOffload, CAST(NULL AS DATE) AS FechaOffload, user_id AS usuario, canonical_id AS viaje,
       CAST(CAST(arg_max(((k * 7) % 1000) / 1000.0, id) AS DECIMAL(4,3)) AS DOUBLE) AS legal,
       CAST(CAST(arg_max((o_custkey % 100) / 100.0, id) AS DECIMAL(4,3)) AS DOUBLE) AS suavidad,
       CAST(CAST(arg_max_null(CASE WHEN k % 5 <> 0 THEN ((k * 3) % 1000) / 1000.0 END, id) AS DECIMAL(4,3)) AS DOUBLE) AS atencion,
       CAST(CAST(arg_max((k % 1000) / 1000.0, id) AS DECIMAL(4,3)) AS DOUBLE) AS promedio
FROM p WHERE NOT failed GROUP BY user_id, canonical_id
""", O.PARENTS))
def mart_scores_primary(spark, sf_dir):
    """M6 PuntajesPrirmariosTr."""
    from tripweave.operators.marts import scores_primary
    return scores_primary(pipeline(spark, sf_dir).insight_trip)


@query("mart_scores_secondary", O.sql(f"""
SELECT CAST(NULL AS INTEGER) AS IdOffload, CAST(NULL AS DATE) AS FechaOffload, t.user_id AS usuario, t.canonical_id AS viaje,
       CAST(CAST(CASE WHEN t.k % 5 <> 0 THEN ((t.k * 3) % 1000) / 1000.0 END AS DECIMAL(4,3)) AS DOUBLE) AS concentracion,
       -1.0 AS aceleracion_fuerte, -1.0 AS frenado_fuerte, -1.0 AS curvas_fuertes, -1.0 AS anticipacion,
       -1 AS celular_fijo, CAST(coalesce(count(l.l_orderkey), 0) AS INTEGER) AS eventos_fuertes
FROM (SELECT DISTINCT user_id, canonical_id, k FROM p WHERE NOT failed) t
LEFT JOIN c_lines l ON l.l_orderkey = t.k AND t.canonical_id = concat('t', t.k) AND l.l_orderkey % 997 <> 0
     AND l.tipo = 'DrivingInsightsHarshEvents'
GROUP BY t.user_id, t.canonical_id, t.k
""", O.PARENTS, O.CHILDREN))
def mart_scores_secondary(spark, sf_dir):
    """M7 PuntajesSecundariosTr + A9 harsh-event count."""
    from tripweave.operators.marts import scores_secondary
    p = pipeline(spark, sf_dir)
    return scores_secondary(p.insight_trip, p.child(S.HARSH))


@query("mart_crash", O.sql("""
SELECT id AS Id, ts AS Registro, id AS EventoId, uid AS usuario, date_trunc('millisecond', ts) AS LeidoFechaHora,
       CASE WHEN value < 10 THEN 'LOW' WHEN value < 100 THEN 'MEDIUM' ELSE 'HIGH' END AS severity, value AS speed, user_id % 5 AS n_preceding
FROM fl WHERE tipo = 'VehicleCrash' AND status = 'PROCESSED'
""", O.FLAT))
def mart_crash(spark, sf_dir):
    """M8 ChoqueDeVehiculo; the raw payload by what it says."""
    from tripweave.operators.marts import crash_mart
    return crash_mart(pipeline(spark, sf_dir).crash_event).select(
        "*", F.get_json_object("json", "$.severity").alias("severity"), F.get_json_object("json", "$.speedAtImpact").cast("double").alias("speed"),
        F.coalesce(F.json_array_length(F.get_json_object("json", "$.precedingLocations")).cast("bigint"), F.lit(0)).alias("n_preceding")).drop("json")


@query("mart_profile", O.sql("""
SELECT arg_max(id, id) AS Id, arg_max(created_at, id) AS Registro, max(id) AS EventoId, user_id AS usuario,
       arg_max(created_at, id) AS LeidoFechaHora,
       arg_max(CASE WHEN hour(first_ts) < 6 THEN 'NIGHT' WHEN hour(first_ts) < 12 THEN 'MORNING' WHEN hour(first_ts) < 18 THEN 'AFTERNOON'
               ELSE 'EVENING' END, id) AS semantic_time, arg_max(n_events, id) AS n_events, arg_max(n_segments, id) AS n_segments
FROM cxp GROUP BY user_id
""", O.CONTEXT, O.CX_PAYLOADS))
def mart_profile(spark, sf_dir):
    """M9 PerfilDeUsuario: latest context payload per user; the raw payload by what it says."""
    from tripweave.operators.marts import profile_mart
    p = pipeline(spark, sf_dir)
    rows = p.accepted.filter(F.col("tipo").isin(*S.CONTEXT_TYPES)).select("id", "user_id", "created_at", "json")
    ctx = F.coalesce(F.get_json_object("json", "$.userContext"), F.col("json"))
    return profile_mart(rows).withColumn("json", ctx).select(
        "*", F.get_json_object("json", "$.semanticTime").alias("semantic_time"),
        F.json_array_length(F.get_json_object("json", "$.events")).cast("bigint").alias("n_events"),
        F.json_array_length(F.get_json_object("json", "$.activeSegments")).cast("bigint").alias("n_segments")).drop("json")


# ---------------------------------------------------------------------------
# Sources: S4/A11 insert-if-absent, S5/O4 historical extract
# ---------------------------------------------------------------------------

INCREMENT_CUTOFF = "2024-01-15 00:00:00"
EXTRACT_SINCE = "2024-01-29 00:00:00"


@query("incremental_landing", O.sql(f"""
SELECT tipo, count(*) FILTER (WHERE created_at >= TIMESTAMP '{INCREMENT_CUTOFF}') AS n_inserted,
       count(*) FILTER (WHERE created_at < TIMESTAMP '{INCREMENT_CUTOFF}') AS n_skipped
FROM st GROUP BY tipo
""", *O.ALL))
def incremental_landing(spark, sf_dir):
    """Replaying the whole landing onto the rows loaded before a cutoff."""
    from tripweave.sources.landing import insert_if_absent_counts
    land = derive_landing(spark, sf_dir)
    existing = land.filter(F.col("created_at") < F.lit(INCREMENT_CUTOFF).cast("timestamp_ntz"))
    return insert_if_absent_counts(land, existing)


@query("tagged_fixture", O.sql("""
SELECT tipo, count(*) AS n_rows, count(*) FILTER (WHERE id % 5 = 0) AS n_unknown FROM st WHERE id % 2 = 0 GROUP BY tipo
""", *O.ALL))
def tagged_fixture(spark, sf_dir):
    """Rows of two tables in one gzip fixture; those tagged for the landing are read, a missing user is 'unknown'."""
    from tripweave.sources.landing import read_tagged_fixture, write_gzip_json
    path = _folder(spark, "tagged")
    rows = derive_landing(spark, sf_dir).select(
        F.when(F.col("id") % 2 == 0, "landing").otherwise("other").alias("table"), "id",
        F.when(F.col("id") % 5 != 0, F.col("user_id")).alias("user_id"), "json", "tipo")
    write_gzip_json(rows, path)
    return read_tagged_fixture(spark, path, lines=True).groupBy("tipo").agg(
        F.count("*").alias("n_rows"), F.sum((F.col("user_id") == "unknown").cast("bigint")).alias("n_unknown"))


@query("landing_reload", O.sql(f"""
SELECT tipo, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id FROM st WHERE created_at >= TIMESTAMP '{INCREMENT_CUTOFF}' GROUP BY tipo
""", *O.ALL))
def landing_reload(spark, sf_dir):
    """A landing that is truncated and loaded anew holds the second load only."""
    from tripweave.sources.landing import reload
    land, path = derive_landing(spark, sf_dir), _folder(spark, "reload")
    for rows in (land, land.filter(F.col("created_at") >= F.lit(INCREMENT_CUTOFF).cast("timestamp_ntz"))):
        reload(rows, path)
    return spark.read.schema(S.LANDING).parquet(path).groupBy("tipo").agg(
        F.count("*").alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("record_lookup", O.sql("""
SELECT id, user_id, tipo, created_at, app_version FROM st WHERE tipo = 'DrivingInsights' AND id = (SELECT max(id) FROM p WHERE id % 1000 = 500)
""", *O.ALL))
def record_lookup(spark, sf_dir):
    """One landing row by type and id (the youngest order's insight)."""
    from tripweave.operators.views import record
    from tripweave.sources.tables import read_table
    last = read_table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return record(derive_landing(spark, sf_dir), S.DRIVING_INSIGHTS, last * 1000 + 500).select("id", "user_id", "tipo", "created_at", "app_version")


@query("browse_processed", O.sql(f"""
SELECT id, user_id, tipo, status FROM st WHERE status = 'PROCESSED' AND tipo = 'UserMetadata' AND id <= {O.FLAT_BASE} + 500 ORDER BY id DESC LIMIT 50
""", *O.ALL))
def browse_processed(spark, sf_dir):
    """The newest processed rows of a type within an id range (a top-n report)."""
    from tripweave.operators.views import browse
    s = pipeline(spark, sf_dir).landing_status.filter(F.col("status") == S.PROCESSED)
    return browse(s, tipo=S.METADATA, max_id=O.FLAT_BASE + 500, n=50).select("id", "user_id", "tipo", "status")


@query("payload_hashes", O.sql("""
SELECT id AS source_event_id, sha256(concat('{"type":"', upper(event_type), '","message":"k=', k, '"}')) AS payload_hash
FROM fl WHERE status = 'PROCESSED' AND tipo = 'TechnicalEvent'
""", O.FLAT))
def payload_hashes(spark, sf_dir):
    """The audit hash is the SHA-256 of the payload text as it landed."""
    p = pipeline(spark, sf_dir)
    return p.source_event.filter(F.col("record_type") == S.TECHNICAL).select("source_event_id", "payload_hash")


@query("transport_any_case", O.sql("""
SELECT user_id, sum(n) AS n_transports FROM (
  SELECT uid AS user_id, count(*) AS n FROM tl WHERE ev_type = 'IN_TRANSPORT' GROUP BY 1
  UNION ALL SELECT uid, count(*) FROM cx WHERE ev_type = 'IN_TRANSPORT' GROUP BY 1) GROUP BY user_id
""", O.TIMELINE, O.CONTEXT))
def transport_any_case(spark, sf_dir):
    """Transports by a type test that ignores case, over types spelt in lower case."""
    from tripweave.operators.quality import case_insensitive_type
    p = pipeline(spark, sf_dir)
    both = p.timeline_event.select("user_id", "event_type").unionByName(p.context_event.select("user_id", "event_type"))
    spelt = both.withColumn("event_type", F.lower("event_type"))
    return spelt.filter(case_insensitive_type("event_type", "in_transport")).groupBy("user_id").agg(F.count("*").alias("n_transports"))


@query("trip_presence", O.sql("""
, t AS (SELECT user_id, canonical_id, arg_min(n_waypoints, ord) AS n_waypoints, arg_min(n_tags, ord) AS n_tags,
               last(end_time ORDER BY ord) AS end_time, last(transport_mode ORDER BY ord) AS transport_mode FROM cand GROUP BY 1, 2)
SELECT coalesce(n_waypoints, 0) > 0 AS has_waypoints, coalesce(n_tags, 0) > 0 AS has_transport_tags, end_time IS NOT NULL AS has_end_time,
       transport_mode IS NOT NULL AS has_transport_mode, count(*) AS n_trips FROM t GROUP BY ALL
""", O.PARENTS, O.TIMELINE, O.CONTEXT, O.FLAT, TRIP_CANDIDATES))
def trip_presence(spark, sf_dir):
    """Trips by which of their nullable columns are there."""
    from tripweave.operators.quality import presence_flags
    columns = ("waypoints", "transport_tags", "end_time", "transport_mode")
    flags = presence_flags(pipeline(spark, sf_dir).trips(columns=columns), list(columns))
    return flags.groupBy(*flags.columns).agg(F.count("*").alias("n_trips"))


@query("ongoing_trips", O.sql("""
SELECT first_seen_from, count(*) AS n_trips FROM (
  SELECT arg_min(first_seen_from, ord) AS first_seen_from, last(end_time ORDER BY ord) AS end_time FROM cand GROUP BY user_id, canonical_id)
WHERE end_time IS NULL GROUP BY first_seen_from
""", O.PARENTS, O.TIMELINE, O.CONTEXT, O.FLAT, TRIP_CANDIDATES))
def ongoing_trips(spark, sf_dir):
    """Trips without an end that are not provisional, by the source that reported them."""
    from tripweave.operators.quality import ongoing_event_nulls
    return ongoing_event_nulls(pipeline(spark, sf_dir).trips()).groupBy("first_seen_from").agg(F.count("*").alias("n_trips"))


@query("guarded_purge", O.sql(f"""
SELECT tipo, count(*) AS n_rows FROM st WHERE status = 'PROCESSED' AND created_at < TIMESTAMP '{AUDITED_UNTIL}' GROUP BY tipo
""", *O.ALL))
def guarded_purge(spark, sf_dir):
    """Processed landing rows that no audit row refers to, once old audit rows are gone."""
    from tripweave.operators.retention import guarded_purge as guarded
    p = pipeline(spark, sf_dir).materialized(("id", "user_id", "tipo", "created_at", "payload_hash", "src_time", "src_ref", "status", "status_reason"))
    kept = p.source_event.filter(F.col("created_at") >= F.lit(AUDITED_UNTIL).cast("timestamp_ntz"))
    return guarded(p.landing, p.landing_status, kept).groupBy("tipo").agg(F.count("*").alias("n_rows"))


@query("expired_pending", O.sql(f"""
SELECT tipo, count(*) AS n_rows, min(created_at) AS first_at FROM st
WHERE reason = 'awaiting_parent' AND created_at < TIMESTAMP '{AUDITED_UNTIL}' - INTERVAL 30 DAY GROUP BY tipo
""", *O.ALL))
def expired_pending(spark, sf_dir):
    """L4: children that wait longer than 30 days as of a date."""
    from tripweave.operators.retention import expired_pending as expired
    p = pipeline(spark, sf_dir).materialized(("id", "user_id", "tipo", "status", "status_reason"))
    return expired(p.landing_status, p.landing, AUDITED_UNTIL).groupBy("tipo").agg(F.count("*").alias("n_rows"), F.min("created_at").alias("first_at"))


@query("json_documents", O.sql("""
SELECT tipo, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, min(id) AS first_id, max(id) AS last_id, max(created_at) AS last_at
FROM st GROUP BY tipo
""", *O.ALL))
def json_documents(spark, sf_dir):
    """The landing as JSON documents, each read by as many tasks as its size asks for."""
    from tripweave.sources.landing import read_json_array, write_json_arrays
    path = _folder(spark, "documents")
    write_json_arrays(derive_landing(spark, sf_dir), path, compression="gzip")
    return read_json_array(spark, path).groupBy("tipo").agg(
        F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.max("created_at").alias("last_at"))


_LOADS = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", None)


def _load_sql(at: str) -> str:
    cases = " ".join(f"WHEN {at} < TIMESTAMP '{t}' THEN {i}" for i, t in enumerate(_LOADS) if t)
    return f"CASE {cases} ELSE {len(_LOADS) - 1} END"



@query("queue_increment", O.sql(f"""
, q AS (SELECT *, {_load_sql("created_at")} AS load,
              -- a child's parent is a minute younger
              CASE WHEN reason = 'awaiting_parent' THEN 99 WHEN status = 'PROCESSED' AND tipo IN ({', '.join(f"'{t}'" for t in S.CHILD_TYPES)})
                   THEN {_load_sql("created_at + INTERVAL 60 SECOND")} ELSE 0 END AS parent_load
        FROM st WHERE reason IS DISTINCT FROM 'unrouted_type')
SELECT r.run, q.tipo, count(*) FILTER (WHERE load = r.run) AS n_new, count(*) FILTER (WHERE load < r.run) AS n_waiting
FROM q, (SELECT unnest(range({len(_LOADS)})) AS run) r WHERE load = r.run OR (load < r.run AND parent_load >= r.run)
GROUP BY r.run, q.tipo
""", *O.ALL))
def queue_increment(spark, sf_dir):
    """Three loads taken one after the other by a cursor: what each run reads anew, and what it takes up again."""
    from functools import reduce

    from tripweave.session import stored
    from tripweave.sources.cursor import QueueCursor, write_load
    tune(spark)
    base = _folder(spark, "queue")
    land, runs, parents, low = derive_landing(spark, sf_dir), [], None, None
    from tripweave.operators import parse as P
    for run, high in enumerate(_LOADS):
        rows = land if low is None else land.filter(F.col("created_at") >= F.lit(low).cast("timestamp_ntz"))
        write_load(rows if high is None else rows.filter(F.col("created_at") < F.lit(high).cast("timestamp_ntz")), f"{base}/landing", run)
        low = high
        cursor = QueueCursor(spark, f"{base}/landing", f"{base}/cursor")
        taken = cursor.pending()  # loads and marks stay as they are: no copy of the queue
        classified = P.classify(P.typed(P.parse(taken.drop("load")), ("p_insight", "p_child")))
        keys = P.parent_keys(P.parent_source(P.parse(taken.drop("load"))))
        parents = stored(keys if parents is None else parents.unionByName(keys).groupBy("user_id", "canonical_id").agg(
            F.min("insight_trip_id").alias("insight_trip_id")), "parents")
        cursor.commit(taken, P.landing_status(P.resolve(classified, parents)))
        runs.append(taken.groupBy("tipo").agg(F.sum((F.col("load") == run).cast("bigint")).alias("n_new"),
                                              F.sum((F.col("load") < run).cast("bigint")).alias("n_waiting")).select(F.lit(run).cast("bigint").alias("run"), "tipo", "n_new", "n_waiting"))
    return reduce(DataFrame.unionByName, runs)


@query("extract_since", O.sql(f"""
SELECT st.id AS original_id, st.user_id AS source_user_id, st.tipo, st.created_at, st.app_version,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL WHEN st.tipo = 'UserMetadata' THEN
              CASE fl.user_id % 3 WHEN 0 THEN 'fleet' WHEN 1 THEN 'tier' ELSE 'vehicle' END
            WHEN st.tipo = 'SDKStatus' THEN CASE WHEN event_id % 2 = 0 THEN 'STARTED' ELSE 'NOT_STARTED' END
            WHEN st.tipo = 'TechnicalEvent' THEN concat('k=', k) WHEN st.tipo = 'DebugLog' THEN concat('debug ', event_id) END AS says
FROM st LEFT JOIN fl ON fl.id = st.id WHERE st.created_at >= TIMESTAMP '{EXTRACT_SINCE}'
""", *O.ALL))
def extract_since(spark, sf_dir):
    """Rows since a cutoff, newest first, id renamed to original_id; payloads of four types by what they say."""
    from tripweave.sources.landing import extract_since as extract
    says = F.lit(None).cast("string")
    for tipo, path in ((S.METADATA, "$.label"), (S.STATUS, "$.startStatus"), (S.TECHNICAL, "$.message"), ("DebugLog", "$.message")):
        says = F.when(F.col("tipo") == tipo, F.get_json_object("json", path)).otherwise(says)
    readable = F.expr("try_parse_json(json)").isNotNull() & F.col("json").startswith("{")
    return extract(derive_landing(spark, sf_dir), EXTRACT_SINCE).withColumn("says", F.when(readable, says)).drop("json")


# ---------------------------------------------------------------------------
# Structured Streaming T1-T7: drain equals batch
# ---------------------------------------------------------------------------


FILES_PER_TRIGGER = 8  # at least: a batch grows with the cores that work on it
#: Drains of this application, by input folder: several reports read one.
_DRAINS: dict[tuple, str] = {}


def _drain(spark, sf_dir):
    """A whole drain of the landing, tables included; run once an application."""
    from tripweave.streaming.stream import Drain, drain, files_per_batch, stage_files
    tune(spark)
    key = _state_of(spark, sf_dir)
    if key not in _DRAINS:
        zone = stage_files(derive_landing(spark, sf_dir), _folder(spark, "zone"))
        _DRAINS[key] = drain(spark, zone, files_per_trigger=files_per_batch(spark, FILES_PER_TRIGGER)).root
    return Drain(spark, _DRAINS[key])


def _ordered_drain(spark, landing, parts, **options):
    """A drain in which event time goes up, a part a batch."""
    from tripweave.streaming.stream import drain_in_order
    tune(spark)
    return drain_in_order(landing, _folder(spark, "zone"), parts, **options)


@query("stream_drain", O.sql("""
SELECT tipo, status, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM st GROUP BY tipo, status
""", *O.ALL))
def stream_drain(spark, sf_dir):
    """availableNow drain in micro-batches; equals the batch status."""
    s = _drain(spark, sf_dir).status()
    return s.groupBy("tipo", "status").agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"))


@query("stream_trips", _trip_oracle(False))
def stream_trips(spark, sf_dir):
    """T4: trips consolidated in buckets across micro-batches equal the batch fold."""
    return _trip_select(_drain(spark, sf_dir).trips())


@query("stream_metrics", O.sql("""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE status = 'PROCESSED') AS n_processed,
       count(*) FILTER (WHERE status = 'FAILED') AS n_failed, 0::BIGINT AS n_expired,
       count(*) FILTER (WHERE reason = 'unrouted_type') AS n_unrouted,
       count(*) FILTER (WHERE reason = 'awaiting_parent') AS depth, 0::BIGINT AS n_unbalanced
FROM st
""", *O.ALL))
def stream_metrics(spark, sf_dir):
    """The counters that the batches left; in each, what came in and what waited equals what was decided and what waits."""
    from pyspark.sql import Window
    m = _drain(spark, sf_dir).metrics()
    # one row a batch: the window sees batches, never rows
    before = F.coalesce(F.lag("depth").over(Window.orderBy("batch_id")), F.lit(0))
    decided = F.col("processed") + F.col("failed") + F.col("expired") + F.col("unrouted")
    m = m.withColumn("balanced", before + F.col("rows_in") == decided + F.col("depth"))
    return m.agg(F.sum("rows_in").alias("rows_in"), F.sum("processed").alias("n_processed"), F.sum("failed").alias("n_failed"),
                 F.sum("expired").alias("n_expired"), F.sum("unrouted").alias("n_unrouted"),
                 F.max_by("depth", "batch_id").alias("depth"), F.sum((~F.col("balanced")).cast("bigint")).alias("n_unbalanced"))


_DEDUP_ORACLE = O.sql("""
SELECT tipo, CASE WHEN tipo = 'DrivingInsights' THEN count(DISTINCT id // 1000) ELSE count(*) END AS n_rows
FROM st GROUP BY tipo
""", *O.ALL)


@query("stream_dedup", _DEDUP_ORACLE)
def stream_dedup(spark, sf_dir):
    """Retried payloads (same user, type, hash) dropped across micro-batches, against the hashes of all batches."""
    from tripweave.streaming.stream import drain, files_per_batch, stage_files
    tune(spark)
    zone = stage_files(derive_landing(spark, sf_dir), _folder(spark, "zone"))
    s = drain(spark, zone, files_per_trigger=files_per_batch(spark, FILES_PER_TRIGGER), dedup="exact").status()
    return s.groupBy("tipo").agg(F.count("*").alias("n_rows"))


@query("stream_dedup_watermark", _DEDUP_ORACLE)
def stream_dedup_watermark(spark, sf_dir):
    """The same by the engine's watermark state, over files in which event time goes up (a retry comes within the hour)."""
    s = _ordered_drain(spark, derive_landing(spark, sf_dir), 3, dedup="watermark").status()
    return s.groupBy("tipo").agg(F.count("*").alias("n_rows"))


EXPIRY_DAYS = 90


@query("stream_expiry", O.sql(f"""
, latest AS (SELECT max(created_at) AS top FROM (SELECT created_at FROM p UNION ALL SELECT created_at FROM c)),
r AS (SELECT 'DrivingInsights' AS tipo, CASE WHEN failed THEN 'FAILED' ELSE 'PROCESSED' END AS status, created_at FROM p
      UNION ALL SELECT tipo, CASE WHEN status = 'PENDING' AND created_at < top - INTERVAL {EXPIRY_DAYS} DAY THEN 'EXPIRED' ELSE status END, created_at
      FROM c, latest)
SELECT tipo, status, count(*) AS n_rows, min(created_at) AS first_at FROM r GROUP BY tipo, status
""", O.PARENTS, O.CHILDREN))
def stream_expiry(spark, sf_dir):
    """Children that wait longer than their time to live leave the queue; the rest equals the batch status."""
    from tripweave.streaming.stream import TimeToLive
    kinds = (S.DRIVING_INSIGHTS, *S.CHILD_TYPES)
    landing = derive_landing(spark, sf_dir).filter(F.col("tipo").isin(*kinds))
    s = _ordered_drain(spark, landing, 4, ttl=TimeToLive(pending=EXPIRY_DAYS)).status()
    return s.join(landing.select("id", "created_at"), "id").groupBy("tipo", "status").agg(
        F.count("*").alias("n_rows"), F.min("created_at").alias("first_at"))


KEY_MOD = 1_000_003

_STREAM_TABLES = {
    # table -> (key column compared)
    "source_event": "source_event_id", "quarantine": "original_id", "insight_trip": "insight_trip_id",
    "context_header": "context_id", "context_segment": "context_id", "context_event": "context_id",
    "timeline_event": "source_event_id", "user_metadata": "metadata_id", "crash_event": "crash_event_id",
    "sdk_status": "sdk_status_id", "user_activity": "activity_id", "technical_event": "technical_event_id",
    **{f"insight_{kind}": "insight_trip_id" for kind in S.CHILD_KIND.values()},
}


def _stream_tables_oracle() -> str:
    def part(name: str, key: str, source: str) -> str:
        return (f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(sum({key} % {KEY_MOD}) AS BIGINT) AS key_sum "
                f"FROM {source}")
    parts = [
        part("source_event", "id", "st WHERE status = 'PROCESSED'"),
        part("quarantine", "id", "st WHERE status = 'FAILED'"),
        part("insight_trip", "id", "p WHERE NOT failed"),
        part("context_header", "id", "cxp"),
        part("context_event", "payload_id", "cx"),
        part("timeline_event", "payload_id", "tl"),
        f"SELECT 'context_segment', CAST(sum(n_segments) AS BIGINT), CAST(sum(n_segments * (id % {KEY_MOD})) AS BIGINT) FROM cxp",
    ]
    parts += [part(t, "id", f"fl WHERE status = 'PROCESSED' AND tipo = '{tipo}'") for t, tipo in (
        ("user_metadata", S.METADATA), ("crash_event", S.CRASH), ("sdk_status", S.STATUS),
        ("user_activity", S.ACTIVITY), ("technical_event", S.TECHNICAL))]
    # a child's parent is the first insight of its order, never the retried copy
    parts += [f"SELECT 'insight_{kind}', CAST(sum(n_events) AS BIGINT), "
              f"CAST(sum(n_events * ((k * 1000 + 500) % {KEY_MOD})) AS BIGINT) "
              f"FROM c WHERE status = 'PROCESSED' AND tipo = '{t}'" for t, kind in S.CHILD_KIND.items()]
    return O.sql("\nUNION ALL ".join(parts), *O.ALL)


def _table_sums(tables: Callable[[str], DataFrame]) -> DataFrame:
    """Rows and a sum over the key of every domain table."""
    out = None
    for name, key in _STREAM_TABLES.items():
        t = tables(name).agg(F.count("*").alias("n_rows"), F.sum(F.col(key) % KEY_MOD).alias("key_sum")).select(
            F.lit(name).alias("table_name"), "n_rows", "key_sum")
        out = t if out is None else out.unionByName(t)
    return out


@query("stream_tables", _stream_tables_oracle())
def stream_tables(spark, sf_dir):
    """Every domain table written by the drain, by rows and by a sum over its key; equals the batch tables."""
    return _table_sums(_drain(spark, sf_dir).table)


@query("write_all", _stream_tables_oracle())
def write_all(spark, sf_dir):
    """The whole model written as one published version and read back."""
    from tripweave.plans.pipeline import read_all
    from tripweave.plans.pipeline import write_all as write
    tune(spark)
    out = _folder(spark, "model")
    write(derive_landing(spark, sf_dir), out)
    return _table_sums(read_all(spark, out).get)
