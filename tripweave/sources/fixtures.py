"""Landing rows derived from the supplied base tables.

The base tables hold no telemetry, so a landing queue is *computed* from
them with column expressions only.  Every input row lands somewhere; the
modulo rules below only choose the *shape* of a payload (which type, which
JSON variant, whether a field is null), never whether a row is used.

Rules (ids are unique across rules):

* parents  (orders, every row)      ``DrivingInsights``; id = orderkey*1000+500;
  transport id 't'||orderkey, or 'r'||orderkey when orderkey % 10 = 9 (its
  children stay orphans); provisional when orderkey % 11 = 0; score 12.5
  (overflow) when orderkey % 997 = 0; identical retry copy at id+400 when
  orderkey % 7 = 0.
* children (lineitem x orders)      one payload per (order, kind); kind from
  l_linenumber: 2 phone, 3 call, 4 speeding, 5 wrong-way, else harsh;
  id = orderkey*1000 + kind ordinal, i.e. below the parent id (child first);
  speeding payloads of orderkey % 53 = 0 omit the transport id.
* timeline (events, event_id % 3 <> 0) and context (events, event_id % 3
  <> 1): payloads per (user, day, event_id div 4096), so payload size is
  bounded by 4096 events whatever the skew of users.
* flat     (events, every row)      by event_id % 6: crash, status,
  metadata, activity, technical, DebugLog (unrouted); text cut in half
  when event_id % 97 = 0 (malformed JSON), an array root when event_id % 101
  = 0 (wrong shape); crash magnitude 1000+value when event_id % 89 = 0 and
  crash or stationary latitude 500 when event_id % 83 = 0 (numeric overflow);
  crash location a text when event_id % 79 = 0 (wrong field).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions import epoch_ms, iso_ms
from tripweave.sources.tables import read_table

#: The input tables of the landing.
TABLES = ("orders", "lineitem", "events")
BLOCK = 4096  # parameter of the fixture: a payload of a (user, day) covers event ids of one block
# id bands apart by 10^18: orderkey * 1000 stays in the first for 10^15 orders, event ids in theirs for 10^18 events
TIMELINE_BASE = 10**18
CONTEXT_BASE = 2 * 10**18
FLAT_BASE = 3 * 10**18

_EXPLICIT_NULLS = {"ignoreNullFields": "false"}


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, sf_dir, n) for n in names]


#: Rows that a task makes payloads of: the lists that it collects stay within its memory, whatever the size of the table.
LINES_PER_TASK, EVENTS_PER_TASK = 100_000, 40_000


def _tasks(rows: DataFrame, per_task: int) -> int:
    """How many tasks the rows ask for (the tables' row counts lie in the files' footers)."""
    return max(1, -(-rows.count() // per_task))


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def _landing(df: DataFrame) -> DataFrame:
    # producers name the text user id ``uid_text`` so that it never shadows a
    # numeric ``user_id`` input column inside the same projection
    user = "uid_text" if "uid_text" in df.columns else "user_id"
    return df.select(
        F.col("id").cast("bigint").alias("id"),
        F.col(user).cast("string").alias("user_id"),
        F.col("tipo").cast("string").alias("tipo"),
        F.col("json").cast("string").alias("json"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("app_version").cast("string").alias("app_version"),
    )


# ---------------------------------------------------------------------------
# F1 parents
# ---------------------------------------------------------------------------
def parent_payloads(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    start = F.col("o_orderdate")
    dur = (k % 180 + 1) * 60
    end = _plus_seconds(start, dur)
    upd = _plus_seconds(end, F.lit(5))
    lat0 = F.lit(40.0) + (F.col("o_custkey") % 1000) / F.lit(1000.0)
    lon0 = F.lit(-3.0) - (k % 1000) / F.lit(1000.0)
    wp0 = F.struct(
        lat0.alias("latitude"), lon0.alias("longitude"), F.lit(5.0).alias("accuracy"),
        epoch_ms(start).alias("timestamp"), ((k % 40) + F.lit(0.5)).alias("speedInMps"),
        F.lit(27.78).alias("speedLimitInMps"),
    )
    wp1 = F.struct(
        (lat0 + F.lit(0.01)).alias("latitude"), (lon0 - F.lit(0.01)).alias("longitude"),
        F.lit(5.0).alias("accuracy"), epoch_ms(end).alias("timestamp"),
        F.when(k % 3 != 0, (F.col("o_custkey") % 30) + F.lit(0.25)).alias("speedInMps"),
        F.lit(27.78).alias("speedLimitInMps"),
    )
    transport = F.struct(
        F.when(k % 10 == 9, F.concat(F.lit("r"), k.cast("string")))
        .otherwise(F.concat(F.lit("t"), k.cast("string"))).alias("id"),
        iso_ms(start).alias("startTime"), epoch_ms(start).alias("startTimeEpoch"),
        iso_ms(upd).alias("lastUpdateTime"), epoch_ms(upd).alias("lastUpdateTimeEpoch"),
        iso_ms(end).alias("endTime"), epoch_ms(end).alias("endTimeEpoch"),
        dur.alias("durationInSeconds"),
        F.col("o_totalprice").alias("distance"),
        F.when(F.col("o_orderstatus") == "F", "CAR").when(F.col("o_orderstatus") == "O", "MOTORCYCLE")
        .otherwise("BUS").alias("transportMode"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "DRIVER")
        .when(F.col("o_orderpriority") == "2-HIGH", "PASSENGER")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "UNAVAILABLE")
        .when(F.col("o_orderpriority") == "5-LOW", "LOW").alias("occupantRole"),
        (k % 11 == 0).alias("isProvisional"),
        F.when(F.col("o_orderstatus") == "P", F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(F.lit("status"), F.col("o_orderstatus"),
                                F.lit("priority"), F.col("o_orderpriority"))).alias("transportTags"),
        F.filter(F.array(wp0, wp1), lambda _: k % 4 != 0).alias("waypoints"),
    )
    scores = F.struct(
        ((F.col("o_custkey") % 100) / F.lit(100.0)).alias("smoothScore"),
        F.when(k % 5 != 0, ((k * 3) % 1000) / F.lit(1000.0)).alias("focusScore"),
        (((k * 7) % 1000) / F.lit(1000.0)).alias("legalScore"),
        F.when(k % 997 == 0, F.lit(12.5)).otherwise((k % 1000) / F.lit(1000.0)).alias("overallScore"),
        F.lit(1.0).alias("attentionScore"),
    )
    payload = F.to_json(F.struct(transport.alias("transportEvent"), scores.alias("safetyScores")),
                        _EXPLICIT_NULLS)
    base = orders.select(
        (k * 1000 + 500).alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.lit(S.DRIVING_INSIGHTS).alias("tipo"),
        payload.alias("json"),
        _plus_seconds(start, k % 86400).alias("created_at"),
        F.when(F.col("o_custkey") % 17 == 0, "1.1.17-test").otherwise("1.4.2").alias("app_version"),
        (k % 7 == 0).alias("_retry"),
    )
    retry = base.filter("_retry").select(
        (F.col("id") + 400).alias("id"), "user_id", "tipo", "json",
        _plus_seconds(F.col("created_at"), F.lit(60)).alias("created_at"), "app_version")
    return _landing(base).unionByName(_landing(retry))


# ---------------------------------------------------------------------------
# F2 children
# ---------------------------------------------------------------------------
CHILD_ORDINAL = {S.HARSH: 1, S.PHONE: 2, S.CALL: 3, S.SPEEDING: 4, S.WRONG_WAY: 5}


def child_kind(linenumber: Column) -> Column:
    return (
        F.when(linenumber == 2, S.PHONE).when(linenumber == 3, S.CALL)
        .when(linenumber == 4, S.SPEEDING).when(linenumber == 5, S.WRONG_WAY)
        .otherwise(S.HARSH)
    )


#: The columns of a line that its event is made of.
_LINE = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
         "l_linestatus", "l_shipdate")


def child_event(line: Column, kind: Column) -> Column:
    """The event of one line (a struct of ``_LINE``) in a payload of type ``kind``."""
    start = _plus_seconds(line["l_shipdate"], line["l_partkey"] % 3600)
    end = _plus_seconds(start, line["l_linenumber"] * 10)
    flag = line["l_returnflag"]
    n_points = line["l_suppkey"] % 3 + 1
    waypoints = F.transform(
        F.sequence(F.lit(0), (n_points - 1).cast("int")),
        lambda i: F.struct(
            (F.lit(40.0) + (line["l_suppkey"] % 100) / F.lit(100.0) + i * F.lit(0.001)).alias("latitude"),
            (F.lit(-3.0) - (line["l_partkey"] % 100) / F.lit(100.0) - i * F.lit(0.001)).alias("longitude"),
            F.lit(8.0).alias("accuracy"),
            (epoch_ms(start) + i * 1000).alias("timestamp"),
            (line["l_extendedprice"] / F.lit(1000.0) + i).alias("speedInMps"),
        ),
    )
    mps_key = line["l_linestatus"] == "F"
    low, high = line["l_discount"] * 100, (line["l_discount"] + line["l_tax"]) * 100
    return F.struct(
        iso_ms(start).alias("startTime"), epoch_ms(start).alias("startTimeEpoch"),
        iso_ms(end).alias("endTime"), epoch_ms(end).alias("endTimeEpoch"),
        F.when(kind == S.HARSH, line["l_quantity"]).alias("magnitude"),
        F.when(kind == S.HARSH, line["l_discount"] * F.lit(1000.0)).alias("confidence"),
        F.when(kind == S.HARSH, F.when(flag == "A", "ACCELERATION").when(flag == "N", "BRAKING")
               .otherwise("TURNING")).alias("type"),
        F.when(kind == S.PHONE, F.when(flag == "A", "NO_CALL").when(flag == "N", "CALL_IN_PROGRESS")
               .otherwise("UNAVAILABLE")).alias("callState"),
        F.when((kind == S.CALL) & mps_key, low).alias("minTraveledSpeedMps"),
        F.when((kind == S.CALL) & ~mps_key, low).alias("minTraveledSpeedInMps"),
        F.when((kind == S.CALL) & mps_key, high).alias("maxTraveledSpeedMps"),
        F.when((kind == S.CALL) & ~mps_key, high).alias("maxTraveledSpeedInMps"),
        F.when(kind == S.CALL, F.when(flag == "A", "HANDS_FREE").when(flag == "N", "HANDHELD")
               .otherwise("UNAVAILABLE")).alias("handsFreeState"),
        waypoints.alias("waypoints"),
    )


def child_payloads(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    # dealt by order before the join: the groups need no further shuffle, and no map task collects lists
    li = lineitem.select("l_orderkey", *_LINE).repartition(_tasks(lineitem, LINES_PER_TASK), "l_orderkey")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(o, "l_orderkey")
    kind = child_kind(F.col("l_linenumber"))
    ordinal = F.lit(0)
    for t, n in CHILD_ORDINAL.items():
        ordinal = F.when(kind == t, F.lit(n)).otherwise(ordinal)
    # the shuffle and the groups hold the few input columns, never the texts:
    # those are many times as long and made of a whole group; the payload array
    # is ordered by the event text, which starts with its start time
    grouped = (
        j.select("l_orderkey", "o_custkey", "o_orderdate", kind.alias("tipo"), ordinal.alias("ordinal"),
                 F.struct(*_LINE).alias("line"))
        .groupBy("l_orderkey", "tipo", "o_custkey", "o_orderdate", "ordinal")
        .agg(F.collect_list("line").alias("lines"))
    )
    events = F.array_sort(F.transform("lines", lambda x: F.to_json(child_event(x, F.col("tipo")))))
    k = F.col("l_orderkey")
    tid = F.when((F.col("tipo") == S.SPEEDING) & (k % 53 == 0), F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("t"), k.cast("string")))
    return _landing(grouped.select(
        (k * 1000 + F.col("ordinal")).alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user_id"),
        "tipo",
        F.concat(F.lit("{"), F.when(tid.isNotNull(), F.concat(F.lit('"transportId":"'), tid, F.lit('",')))
                 .otherwise(F.lit("")),
                 F.lit('"events":['), F.array_join(events, ","), F.lit("]}")).alias("json"),
        _plus_seconds(F.col("o_orderdate"), k % 86400 - 60).alias("created_at"),
        F.when(F.col("o_custkey") % 17 == 0, "1.1.17-test").otherwise("1.4.2").alias("app_version"),
    ))


# ---------------------------------------------------------------------------
# Shared event shape for timeline and context payloads
# ---------------------------------------------------------------------------
def event_type_of(event_type: Column) -> Column:
    return (
        F.when(event_type.isin("click", "purchase"), "IN_TRANSPORT")
        .when(event_type == "view", "STATIONARY")
        .when(event_type == "signup", "OFF_THE_GRID")
        .otherwise("UNKNOWN")
    )


def _props_k(props: Column | None = None) -> Column:
    return F.get_json_object(F.col("props") if props is None else props, "$.k").cast("bigint")


#: The columns of ``events`` that an event is made of.
_EVENT = ("event_id", "ts", "user_id", "event_type", "value", "props")


def event_struct(event: Column) -> Column:
    """The telemetry event of one row (a struct of ``_EVENT``)."""
    et = event["event_type"]
    eid = event["event_id"]
    uid = event["user_id"]
    ts = event["ts"]
    value = event["value"]
    dur = F.floor(value * 60).cast("bigint")
    end = _plus_seconds(ts, dur)
    in_transport = et.isin("click", "purchase")
    mode = F.when(et == "click", "CAR").when(et == "purchase", "TRAIN") \
        .when((et == "error") & (eid % 4 == 0), "WALKING")
    loc = F.struct(
        (F.lit(50.0) + uid / F.lit(10000.0)).alias("latitude"),
        (F.lit(4.0) + (eid % 1000) / F.lit(1000.0)).alias("longitude"),
        F.lit(10.0).alias("accuracy"),
    )
    venue = F.when(et == "view", F.struct(
        loc.alias("location"),
        F.when(uid % 3 == 0, "HOME").when(uid % 3 == 1, "WORK").otherwise("POINT_OF_INTEREST").alias("significance"),
        F.when(uid % 3 == 0, "RESIDENTIAL").when(uid % 3 == 1, "OFFICE").otherwise("SHOP").alias("type"),
    ))
    wps = F.when(in_transport, F.array(
        F.struct(loc["latitude"].alias("latitude"), loc["longitude"].alias("longitude"),
                 F.lit(10.0).alias("accuracy"), epoch_ms(ts).alias("timestamp"),
                 (value / F.lit(10.0)).alias("speedInMps")),
        F.struct((loc["latitude"] + F.lit(0.02)).alias("latitude"), (loc["longitude"] + F.lit(0.02)).alias("longitude"),
                 F.lit(10.0).alias("accuracy"), epoch_ms(end).alias("timestamp"),
                 (value / F.lit(20.0)).alias("speedInMps")),
    ))
    return F.struct(
        F.concat(F.lit("e"), eid.cast("string")).alias("id"),
        event_type_of(et).alias("type"),
        iso_ms(ts).alias("startTime"), epoch_ms(ts).alias("startTimeEpoch"),
        iso_ms(end).alias("lastUpdateTime"), epoch_ms(end).alias("lastUpdateTimeEpoch"),
        iso_ms(end).alias("endTime"), epoch_ms(end).alias("endTimeEpoch"),
        dur.alias("durationInSeconds"),
        (eid % 5 == 0).alias("isProvisional"),
        mode.alias("transportMode"),
        (value * 100).alias("distance"),
        F.when(et == "click", "DRIVER").when(et == "purchase", "PASSENGER").alias("occupantRole"),
        F.when(in_transport, F.create_map(F.lit("k"), _props_k(event["props"]).cast("string"))).alias("transportTags"),
        wps.alias("waypoints"),
        loc.alias("location"),
        venue.alias("venue"),
    )


#: A payload's group: user, day and block of event ids.
_GROUP = ("user_id", "day", "blk")


def _grouped(events: DataFrame) -> DataFrame:
    return events.select(*_EVENT, F.to_date("ts").alias("day"), F.floor(F.col("event_id") / BLOCK).alias("blk"))


def _dealt(events: DataFrame) -> DataFrame:
    """Rows dealt by group before they are collected: no map task collects lists."""
    return _grouped(events).repartition(_tasks(events, EVENTS_PER_TASK), *_GROUP)


# ---------------------------------------------------------------------------
# F3 timeline
# ---------------------------------------------------------------------------
def _events() -> Column:
    """The input columns of a group's rows: the shuffle and the groups never hold the texts, which are many times as long."""
    return F.collect_list(F.struct(*_EVENT))


def _array_text(col: str, explicit_nulls: bool) -> Column:
    """Collected rows of a group as one JSON array text, ordered by id, then text."""
    opts = _EXPLICIT_NULLS if explicit_nulls else {}
    texts = F.sort_array(F.transform(col, lambda x: F.struct(x["event_id"].alias("event_id"), F.to_json(event_struct(x), opts).alias("j"))))
    return F.concat(F.lit("["), F.array_join(F.transform(texts, lambda x: x["j"]), ","), F.lit("]"))


def timeline_payloads(events: DataFrame) -> DataFrame:
    g = (
        _dealt(events.filter(F.col("event_id") % 3 != 0))
        .groupBy(*_GROUP)
        .agg(F.min("event_id").alias("first_id"), F.max("ts").alias("last_ts"),
             _events().alias("evs"))
    )
    arr = _array_text("evs", False)
    body = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit('{"events":'), arr, F.lit("}"))).otherwise(arr)
    return _landing(g.select(
        (F.lit(TIMELINE_BASE) + F.col("first_id")).alias("id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid_text"),
        F.when(F.dayofmonth("day") % 2 == 0, S.TIMELINE).otherwise(S.TIMELINE_UPDATE).alias("tipo"),
        body.alias("json"),
        F.col("last_ts").alias("created_at"),
        F.lit("1.4.2").alias("app_version"),
    ))


# ---------------------------------------------------------------------------
# F4 context
# ---------------------------------------------------------------------------
def context_payloads(events: DataFrame) -> DataFrame:
    # segments and events are dealt alike: both are grouped where they lie and meet without a further shuffle
    ev = _dealt(events.filter(F.col("event_id") % 3 != 1))
    keys = [F.col(c) for c in _GROUP]
    seg = (
        ev.groupBy(*keys, _props_k().alias("k"))
        .agg(F.count("*").alias("n"), F.min("ts").alias("s_start"), F.max("ts").alias("s_end"))
        .select("user_id", "day", "blk", F.struct(
            F.col("k").alias("id"),
            F.when(F.col("k") % 3 == 0, "LEISURE").when(F.col("k") % 3 == 1, "MOBILITY")
            .otherwise("WORK_LIFE").alias("category"),
            F.concat(F.lit("SUB"), (F.col("k") % 5).cast("string")).alias("subcategory"),
            F.concat(F.lit("SEG_"), F.col("k").cast("string")).alias("type"),
            iso_ms("s_start").alias("startTime"), epoch_ms("s_start").alias("startTimeEpoch"),
            iso_ms("s_end").alias("endTime"), epoch_ms("s_end").alias("endTimeEpoch"),
            F.array(
                F.struct(F.lit("k_score").alias("name"), (F.col("k") / F.lit(100.0)).alias("value")),
                F.struct(F.lit("n_events").alias("name"), F.col("n").cast("double").alias("value")),
            ).alias("attributes"),
        ).alias("seg"))
        .groupBy("user_id", "day", "blk").agg(F.sort_array(F.collect_list("seg")).alias("segments"))
    )
    g = (
        ev.groupBy(*keys)
        .agg(F.min("event_id").alias("first_id"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
             _events().alias("evs"))
        .join(seg, ["user_id", "day", "blk"])
    )
    uid = F.col("user_id")
    hour = F.hour("first_ts")
    place = lambda sig, typ: F.struct(
        F.struct((F.lit(50.0) + uid / F.lit(10000.0)).alias("latitude"),
                 F.lit(4.5 if sig == "HOME" else 4.6).alias("longitude"),
                 F.lit(15.0).alias("accuracy")).alias("location"),
        F.lit(sig).alias("significance"), F.lit(typ).alias("type"))
    ctx = F.struct(
        F.when(hour < 6, "NIGHT").when(hour < 12, "MORNING").when(hour < 18, "AFTERNOON")
        .otherwise("EVENING").alias("semanticTime"),
        F.when(uid % 4 != 0, F.struct((F.lit(50.0) + uid / F.lit(10000.0)).alias("latitude"),
                                      F.lit(4.55).alias("longitude"), F.lit(20.0).alias("accuracy")))
        .alias("lastKnownLocation"),
        F.when(uid % 3 == 0, place("HOME", "RESIDENTIAL")).alias("home"),
        F.when(uid % 3 == 1, place("WORK", "OFFICE")).alias("work"),
        F.col("segments").alias("activeSegments"),
    )
    ctx_text = F.to_json(ctx, _EXPLICIT_NULLS)
    # splice the pre-serialised events array in as the last member
    ctx_text = F.concat(F.substring(ctx_text, F.lit(1), F.length(ctx_text) - 1),
                        F.lit(',"events":'), _array_text("evs", True), F.lit("}"))
    listener = F.dayofmonth("day") % 2 == 1
    criteria = F.array(F.lit("CURRENT_EVENT"),
                       F.when(uid % 2 == 0, "VISITED_VENUES").otherwise("ACTIVE_SEGMENTS"))
    body = F.when(listener, F.concat(F.lit('{"criteria":'), F.to_json(criteria), F.lit(',"userContext":'),
                                     ctx_text, F.lit("}"))).otherwise(ctx_text)
    return _landing(g.select(
        (F.lit(CONTEXT_BASE) + F.col("first_id")).alias("id"),
        F.concat(F.lit("u"), uid.cast("string")).alias("uid_text"),
        F.when(listener, S.CONTEXT_LISTENER).otherwise(S.CONTEXT_MANUAL).alias("tipo"),
        body.alias("json"),
        F.col("last_ts").alias("created_at"),
        F.lit("1.4.2").alias("app_version"),
    ))


# ---------------------------------------------------------------------------
# F5-F7 flat types, malformed text, unrouted type
# ---------------------------------------------------------------------------
FLAT_KIND = (S.CRASH, S.STATUS, S.METADATA, S.ACTIVITY, S.TECHNICAL, "DebugLog")


def flat_payloads(events: DataFrame) -> DataFrame:
    eid, uid, et, val = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value")
    # CASE over literals (not an array lookup) so that a filter on ``tipo``
    # folds at plan time and prunes this branch when no flat type is needed
    kind = F.when(eid % 6 == 0, FLAT_KIND[0])
    for i, k in enumerate(FLAT_KIND[1:], start=1):
        kind = kind.when(eid % 6 == i, k)
    loc = F.struct(F.when(eid % 83 == 0, F.lit(500.0)).otherwise(F.lit(50.0) + uid / F.lit(10000.0)).alias("latitude"),
                   (F.lit(4.0) + (eid % 1000) / F.lit(1000.0)).alias("longitude"),
                   F.lit(10.0).alias("accuracy"), val.alias("altitude"))
    preceding = F.transform(
        F.sequence(F.lit(0), (uid % 5).cast("int")),
        lambda i: F.struct((loc["latitude"] - i * F.lit(0.001)).alias("latitude"),
                           (loc["longitude"] - i * F.lit(0.001)).alias("longitude"),
                           F.lit(12.0).alias("accuracy"), val.alias("altitude")))
    crash = F.to_json(F.struct(
        epoch_ms("ts").alias("time"),
        F.when(eid % 5 != 0, loc).alias("location"),
        F.when(eid % 89 == 0, F.lit(1000.0) + val).otherwise(val / F.lit(10.0)).alias("magnitude"),
        val.alias("speedAtImpact"),
        (val * F.lit(2.0)).alias("deltaV"),
        ((eid % 100) / F.lit(100.0)).alias("confidence"),
        F.when(val < 10, "LOW").when(val < 100, "MEDIUM").otherwise("HIGH").alias("severity"),
        F.when(uid % 2 == 0, "CAR").otherwise("TWO_WHEELER").alias("detectorMode"),
        F.slice(preceding, 1, (uid % 5).cast("int")).alias("precedingLocations"),
    ), _EXPLICIT_NULLS)
    status = F.to_json(F.struct(
        F.when(eid % 2 == 0, "STARTED").otherwise("NOT_STARTED").alias("startStatus"),
        F.when(et == "error", "DISABLED").otherwise("ENABLED_AND_DETECTING").alias("detectionStatus"),
        F.when(uid % 3 == 0, "ALWAYS").when(uid % 3 == 1, "WHILE_IN_USE").otherwise("NEVER").alias("locationPermission"),
        (eid % 4 == 0).alias("isPreciseLocationPermGranted"),
        F.when(eid % 3 != 0, F.lit(True)).alias("isLocationAvailable"),
        F.lit("OK").alias("wifiQuotaStatus"),
        F.when(val > 100, "EXCEEDED").otherwise("OK").alias("mobileQuotaStatus"),
        F.lit("OK").alias("diskQuotaStatus"),
        F.when(uid % 7 == 0, F.lit("false")).otherwise(F.lit("true")).alias("canDetect"),
    ))
    mkind = F.floor(eid / 6) % 3
    label = F.when(uid % 3 == 0, "fleet").when(uid % 3 == 1, "tier").otherwise("vehicle")
    metadata = (
        F.when(mkind == 0, F.to_json(F.struct(label.alias("label"), val.alias("value"))))
        .when(mkind == 1, F.to_json(F.struct(label.alias("label"), (uid % 2 == 0).alias("value"))))
        .otherwise(F.to_json(F.struct(label.alias("label"), et.alias("value"))))
    )
    a_type = F.when(et.isin("click", "purchase"), "IN_TRANSPORT").when(et == "view", "STATIONARY").otherwise("UNKNOWN")
    a_trip = F.when(et == "click", "TRIP_TYPE_SDK")
    a_loc = F.when(et == "view", F.struct(loc["latitude"].alias("latitude"), loc["longitude"].alias("longitude")))
    activity = F.when(uid % 2 == 0, F.to_json(F.struct(
        a_type.alias("activityType"), a_trip.alias("tripType"), iso_ms("ts").alias("startTime"),
        a_loc.alias("stationaryLocation")))).otherwise(F.to_json(F.struct(
            a_type.alias("type"), F.struct(a_trip.alias("type")).alias("tripInfo"),
            iso_ms("ts").alias("startTime"), F.struct(a_loc.alias("location")).alias("stationaryInfo"))))
    technical = F.to_json(F.struct(F.upper(et).alias("type"),
                                   F.concat(F.lit("k="), _props_k().cast("string")).alias("message")))
    debug = F.to_json(F.struct(F.concat(F.lit("debug "), eid.cast("string")).alias("message")))
    body = (
        F.when(kind == S.CRASH, crash).when(kind == S.STATUS, status).when(kind == S.METADATA, metadata)
        .when(kind == S.ACTIVITY, activity).when(kind == S.TECHNICAL, technical).otherwise(debug)
    )
    crash_text = F.regexp_replace(body, r'"location":(\{[^}]*\}|null)', '"location":"unknown"')
    body = F.when((kind == S.CRASH) & (eid % 79 == 0), crash_text).otherwise(body)
    body = F.when(eid % 101 == 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    body = F.when(eid % 97 == 0, F.substring(body, 1, (F.length(body) / 2).cast("int"))).otherwise(body)
    return _landing(events.select(
        (F.lit(FLAT_BASE) + eid).alias("id"),
        F.concat(F.lit("u"), uid.cast("string")).alias("uid_text"),
        kind.alias("tipo"),
        body.alias("json"),
        F.col("ts").alias("created_at"),
        F.lit("1.4.2").alias("app_version"),
    ))


def derive_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole landing queue derived from ``sf_dir`` (all rules)."""
    orders, lineitem, events = _tables(spark, sf_dir, *TABLES)
    return (
        parent_payloads(orders)
        .unionByName(child_payloads(lineitem, orders))
        .unionByName(timeline_payloads(events))
        .unionByName(context_payloads(events))
        .unionByName(flat_payloads(events))
    )


CROSS_BASE = 4 * 10**18


def cross_timelines(orders: DataFrame) -> DataFrame:
    """Timelines of the drivers themselves: most orders' transports once more, by another source (id band of their own).

    orderkey % 3 = 0 has none; provisional when orderkey % 13 = 0; duration and role are left out.
    """
    k = F.col("o_orderkey")
    start, end = _plus_seconds(F.col("o_orderdate"), F.lit(3600)), _plus_seconds(F.col("o_orderdate"), F.lit(7200))
    event = F.struct(
        F.concat(F.lit("t"), k.cast("string")).alias("id"), F.lit("IN_TRANSPORT").alias("type"),
        iso_ms(start).alias("startTime"), epoch_ms(start).alias("startTimeEpoch"), iso_ms(end).alias("endTime"), epoch_ms(end).alias("endTimeEpoch"),
        (k % 13 == 0).alias("isProvisional"), F.lit("TRAM").alias("transportMode"), ((k % 1000) + F.lit(0.5)).alias("distance"))
    return _landing(orders.filter(k % 3 != 0).select(
        (F.lit(CROSS_BASE) + k).alias("id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.lit(S.TIMELINE).alias("tipo"), F.concat(F.lit("["), F.to_json(event), F.lit("]")).alias("json"),
        end.alias("created_at"), F.lit("1.4.2").alias("app_version")))


def derive_insights_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the driving-insights part (parents + children): orders, lineitem."""
    orders, lineitem = _tables(spark, sf_dir, "orders", "lineitem")
    return parent_payloads(orders).unionByName(child_payloads(lineitem, orders))


def derive_events_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the events-derived part (timeline, context, flat types)."""
    (events,) = _tables(spark, sf_dir, "events")
    return (timeline_payloads(events).unionByName(context_payloads(events))
            .unionByName(flat_payloads(events)))
