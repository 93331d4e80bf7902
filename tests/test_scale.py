"""What a plan reads, stores and writes, where that decides how it grows."""

from __future__ import annotations

import datetime as dt
import glob
import tempfile

import pytest
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions import overflows
from tripweave.operators import parse as P
from tripweave.operators.trees import leaves, number_text, redacted_json
from tripweave.plans import catalog
from tripweave.plans.pipeline import Pipeline
from tripweave.session import stored, tune
from tripweave.sources.landing import read_json_array, write_json_arrays
from tripweave.streaming.stream import drain, stage_files

_POINT = {"latitude": 1.0, "longitude": 2.0, "accuracy": 3.0}
_OBJECTS = ({"semanticTime": "NIGHT", "events": []}, {"events": [1]}, {"events": {"a": 1}}, {"events": None}, {"events": [None]},
            {"activeSegments": 3}, {"activeSegments": [{"attributes": [{"name": "a", "value": 1e18}]}]}, {"home": []}, {"work": {"location": {"latitude": 500.0}}},
            {"lastKnownLocation": "x"}, {"events": [{"id": "e", "distance": 1e30}]}, {"events": [{"location": {"latitude": 500.0}}]}, {})
_ODD = [
    *[(S.CONTEXT_MANUAL, o) for o in _OBJECTS], *[(S.CONTEXT_LISTENER, o) for o in _OBJECTS], *[(S.CONTEXT_LISTENER, {"userContext": o}) for o in _OBJECTS],
    *[(S.CONTEXT_LISTENER, {"userContext": o, "events": [1], "home": 4}) for o in (None, 1, [], [1], "x", {}, {"other": 1}, {"events": {}})],
    *[(S.TIMELINE, o) for o in (*_OBJECTS, [], [1], [None], [{"id": "e"}], [{"distance": 1e30}], 5, "x", None, {"events": "x"})],
    *[(S.HARSH, {"transportId": "t1", **o}) for o in (*_OBJECTS, {"events": [{"magnitude": 1e9}]}, {"events": [{"magnitude": "x", "confidence": 1}]})],
    *[(S.HARSH, o) for o in ({}, {"transportId": ""}, {"transportId": "t9", "events": [{"confidence": 1e9}]}, [])],
    *[(S.CALL, {"transportId": "t1", "events": [{c: 1e9}]}) for c in ("minTraveledSpeedMps", "minTraveledSpeedInMps", "maxTraveledSpeedMps", "maxTraveledSpeedInMps")],
    *[(S.DRIVING_INSIGHTS, o) for o in ({"transportEvent": {"id": "t1"}}, {"transportEvent": 3}, {"safetyScores": []}, {"transportEvent": {"id": "t2", "distance": 1e30}},
                                        {"transportEvent": {"id": "t3", "durationInSeconds": 1e30}}, {"safetyScores": {"overallScore": 12.5}}, {"transportEvent": None})],
    *[(S.CRASH, o) for o in ({"location": 3}, {"location": None}, {"location": {**_POINT, "altitude": 1e12}}, {"magnitude": 1e9}, {"deltaV": 1e9},
                             {"speedAtImpact": 1e9}, {"confidence": 1e9}, {"precedingLocations": [1]}, [])],
    *[(S.ACTIVITY, o) for o in ({"stationaryLocation": {"latitude": 500.0}}, {"stationaryInfo": {"location": {"longitude": 5e9}}}, {"type": "A"})],
    *[(t, o) for t in (S.STATUS, S.METADATA, S.TECHNICAL, "DebugLog") for o in ({"value": 1}, [], "{broken")],
]


def _odd(landing):
    return landing([(i, "u", tipo, payload) for i, (tipo, payload) in enumerate(_ODD)])


def _rows(df):
    return sorted(map(str, df.collect()))


def test_status_is_judged_without_the_whole_payloads(spark, landing):
    p = Pipeline(_odd(landing))
    assert _rows(p.landing_status) == _rows(P.landing_status(p.resolved))
    assert _rows(p.quarantine) == _rows(P.quarantine(p.resolved))
    assert _rows(p.source_event) == _rows(P.source_event(p.accepted))
    assert {r.reason for r in p.landing_status.collect()} >= {"wrong_field", "numeric_overflow", "wrong_shape", "malformed_json", "missing_transport_id"}
    for df in (p.landing_status, p.quarantine, p.source_event):
        assert "waypoints" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_kinds_of_fields_are_judged_as_by_their_whole_values(spark, landing):
    """The cheap tests for an object, an array and a missing member say what reading the value itself says."""
    rows = P.parse(_odd(landing)).filter(~F.col("malformed"))
    for path in ("$.events", "$.userContext", "$"):
        got = rows.select(F.when(P._no_array(path), "no").otherwise("yes").alias("a"), F.try_variant_get("v", path, "array<variant>").isNotNull().alias("b"),
                          F.when(P._no_object(path), "no").otherwise("yes").alias("c"), F.try_variant_get("v", path, "map<string,variant>").isNotNull().alias("d"))
        assert all((r.a == "yes") == r.b and (r.c == "yes") == r.d for r in got.collect())


@pytest.mark.parametrize("name", ["processed_scan", "payload_dedup"])
def test_payloads_are_parsed_before_rows_are_read_twice(spark, name):
    from tripweave.plans import catalog
    plan = catalog.REGISTRY[name][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "try_variant_get" not in plan and "parse_json" not in plan.lower()


def test_leaves_of_scalars_are_not_looked_into_again(spark):
    texts = ["5", '{"a":{"b":[1,{"c":[]},[2.50,"x"]],"d":null},"e":{}}', "[]", "[[[[1]]]]", "null", '{"a":1e30,"b":-0.0000001,"c":100,"d":true}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t"), leaves(F.expr("try_parse_json(t)"), 3).alias("x"))
    got = {r.t: sorted((x.path, x.kind, x.value) for x in r.x) for r in df.collect()}
    assert got[texts[0]] == [("", "number", "5")]
    assert got[texts[1]] == [("a.b[]", "number", "1"), ("a.b[]", "tree", '[2.5,"x"]'), ("a.b[]", "tree", '{"c":[]}'), ("a.d", "null", None)]
    assert got["[]"] == [] and got["[[[[1]]]]"] == [("[][][]", "tree", "[1]")]
    assert ("c", "number", "100") in got[texts[5]] and ("d", "boolean", "true") in got[texts[5]]
    x = spark.range(1).select(*[number_text(F.lit(n)).alias(str(i)) for i, n in enumerate((5.0, 100.0, 0.0, 2.5, 1e33, -0.25))]).first()
    assert list(x)[:4] == ["5", "100", "0", "2.5"] and x[5] == "-0.25"
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "forall" in plan and plan.lower().count("schemaofvariant(") + plan.count("schema_of_variant(") == 1


def test_compressed_documents_are_bounded_and_read_back(spark, landing):
    rows = landing([(i, f"u{i}", S.STATUS, {"a": '},{"', "i": i}) for i in range(25)])
    path = f"{tempfile.mkdtemp(prefix='tripweave-docs-')}/gz"
    write_json_arrays(rows.coalesce(1), path, compression="gzip", rows_per_file=10)
    assert len(glob.glob(f"{path}/*.gz")) == 3
    assert _rows(read_json_array(spark, path)) == _rows(rows.select("id", "user_id", "tipo", "json", "created_at", "app_version"))


def test_waiting_children_are_kept_without_their_texts(spark, landing):
    rows = landing([(1, "u", S.HARSH, {"transportId": "t1", "events": [{"magnitude": 1.0}]}), (2, "u", S.HARSH, {"transportId": "t1", "events": [{"magnitude": 1e9}]})])
    proc = drain(spark, stage_files(rows, f"{tempfile.mkdtemp(prefix='tripweave-zone-')}/zone"))
    assert {r.id: r.json is None for r in proc.state.read("pending").collect()} == {1: True, 2: False}


def test_stored_stage_has_no_second_copy_of_trip_candidates(spark, landing):
    rows = landing([(1, "u", S.TIMELINE, [{"id": "e", "type": "IN_TRANSPORT", "startTime": "2024-01-01T10:00:00.000Z", "waypoints": [_POINT]}]),
                    (2, "u", S.DRIVING_INSIGHTS, {"transportEvent": {"id": "e", "distance": 5.0}})])
    p = Pipeline(rows)
    stored = p.materialized(texts=False).trips()
    assert _rows(stored) == _rows(p.trips())
    assert not [f for f in stored.inputFiles() if "/trip_candidates/" in f]


def test_guard_moves_no_texts(spark, landing):
    """The texts are dropped below the join by which children find their parents."""
    plan = Pipeline(_odd(landing)).staged._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    assert any("AS json" in line for line in plan[join:])
    assert _rows(Pipeline(_odd(landing)).materialized(texts=False).quarantine) == _rows(Pipeline(_odd(landing)).quarantine)


def test_segments_and_events_of_a_context_are_dealt_once_each(spark, monkeypatch):
    from tripweave.sources import fixtures
    monkeypatch.setattr(fixtures, "EVENTS_PER_TASK", 3)
    data = [(i, f"2024-01-0{i % 3 + 1} 10:00:00", i % 2, "click", 1.0, f'{{"k": {i % 4}}}') for i in range(30)]
    events = spark.createDataFrame(data, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    out = fixtures.context_payloads(events)
    exchanges = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("REPARTITION_BY_NUM" in line for line in exchanges)
    assert out.count() == 4


def test_audit_fields_are_found_in_one_look(spark, landing):
    """An object is read once for all audit fields; they equal those that each path leads to."""
    texts = ['{"transportEvent":{"id":"t","startTime":"2024-01-01T10:00:00.000Z"},"id":"x"}', '{"transportEvent":{"id":""},"id":7,"startTime":"2024-01-01T10:00:00"}',
             '{"transportEvent":[{"id":"t"}],"startTime":""}', '[{"id":"e","startTime":"2024-02-02T10:00:00"},{"id":"f"}]', '[5]', '[]', '5', 'null', '{"id":{"a":1}}',
             '{"transportEvent":3,"id":true}', '{"transportEvent":null,"id":null}', '{"id":"a","id":"b"}', '{broken']
    rows = P.parse(landing([(i, "u", S.TECHNICAL, t) for i, t in enumerate(texts)]))
    at = lambda p: F.when(F.length(F.try_variant_get("v", p, "string")) > 0, F.try_variant_get("v", p, "string"))
    want = rows.select("id", F.coalesce(at("$.transportEvent.startTime"), at("$[0].startTime"), at("$.startTime")).isNotNull().alias("timed"),
                       F.coalesce(at("$.transportEvent.id"), at("$[0].id"), at("$.id")).alias("ref"))
    got = P.typed(rows, ("p_activity",), judged=True)
    assert _rows(got.select("id", F.col("src_time").isNotNull().alias("timed"), F.col("src_ref").alias("ref"))) == _rows(want)
    plan = got.select("src_time", "src_ref")._jdf.queryExecution().optimizedPlan().toString()
    assert "$.transportEvent" not in plan
    assert plan.count("transportEvent,StructType") == 1


def test_families_are_typed_in_steps_of_their_own(spark, landing):
    """No generator holds all families: the JVM does not compile a method that long."""
    plan = P.typed(P.parse(_odd(landing)), judged=True)._jdf.queryExecution().analyzed().toString()
    assert sum("Generate inline" in line for line in plan.splitlines()) == len(P.JUDGED)


@pytest.mark.parametrize("kind", [S.DEC_SCORE, S.DEC_MAGNITUDE, S.DEC_METRES, S.DEC_LAT])
def test_overflow_is_judged_as_by_the_cast(spark, kind):
    top = {S.DEC_SCORE: 10.0, S.DEC_MAGNITUDE: 1000.0, S.DEC_METRES: 1e10, S.DEC_LAT: 100.0}[kind]
    values = [v for x in (0.0, 0.5, top - 1, top - 1.0001, top - 0.5, top - 0.0005, top - 0.0004, top - 0.005, top - 1e-9, top, top * 2) for v in (x, -x)]
    df = spark.createDataFrame([(v,) for v in (*values, float("nan"), float("inf"), float("-inf"), None)], "x double")
    got = df.select("x", overflows("x", kind).alias("a"), (F.col("x").isNotNull() & F.col("x").try_cast(kind).isNull()).alias("b"))
    assert all(r.a == r.b for r in got.collect()) and {r.a for r in got.collect()} == {True, False}


def test_trips_and_insight_rows_come_from_one_pass_without_waypoints(spark, landing):
    """The stored copy gives the same insight rows and trips as the whole payloads, and no payload is parsed again."""
    extra = [(1000 + i, "u", tipo, payload) for i, (tipo, payload) in enumerate((
        (S.DRIVING_INSIGHTS, {"transportEvent": {"id": "t1", "isProvisional": True, "waypoints": [_POINT]}}),
        (S.TIMELINE, [{"id": "t1", "type": "IN_TRANSPORT", "occupantRole": "A", "venue": {"type": "x"}, "waypoints": [_POINT], "transportTags": {"a": "b"}}]),
        (S.CONTEXT_LISTENER, {"userContext": {"events": [{"id": "t9", "transportMode": "BUS", "endTime": "2024-01-01T10:00:00.000Z"}]}}),
        (S.ACTIVITY, {"type": "IN_TRANSPORT", "startTime": "2024-01-01T10:00:00.000Z"})))]
    p = Pipeline(_odd(landing).unionByName(landing(extra)))
    q = p.reporting()
    assert _rows(q.insight_trip) == _rows(p.insight_trip)
    columns = ["trip_id", "updated_at", "occupant_role", "first_seen_from", "start_time", "end_time", "transport_mode", "n_writers"]
    assert _rows(q.trips().select(columns)) == _rows(p.trips().select(columns)) and q.trips().count() == 3
    few = p.trips(columns=("waypoints", "transport_tags"))
    assert "end_time" not in few.columns and _rows(few.select("trip_id", "waypoints", "transport_tags")) == _rows(p.trips().select("trip_id", "waypoints", "transport_tags"))
    assert _rows(p.trips("enrich", ("waypoints", "end_time")).select("trip_id", "waypoints", "end_time")) == _rows(p.trips("enrich").select("trip_id", "waypoints", "end_time"))
    plan = q.insight_trip._jdf.queryExecution().optimizedPlan().toString()
    assert "parse" not in plan.lower() and "waypoints" not in str(q.resolved.schema)


def test_shuffle_files_go_with_the_write_that_made_them(spark, landing):
    """A plan of several stored steps holds the shuffle of one step, not of all."""
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return sum("shuffle_" in str(store.getAllFiles().apply(i)) for i in range(store.getAllFiles().size()))

    tune(spark)
    before = files()
    for n in (10, 20, 30):
        assert stored(spark.range(1000).groupBy((F.col("id") % n).alias("k")).count(), "t").count() == n
    assert files() <= before


def test_bare_stage_has_no_waypoints_and_the_same_tables(spark, landing):
    """Tables over the narrow copy equal those over the whole one, but for what it leaves out."""
    whole = Pipeline(_odd(landing))
    copy = whole.materialized(bare=True)
    assert "waypoints" not in copy.resolved.schema.simpleString() and "payload_hash" not in copy.resolved.columns
    left_out = {"insight_harsh": ["waypoints"], "source_event": ["payload_hash"], "trip": ["waypoints"]}
    tables, narrow = whole.tables(), copy.tables()
    assert set(tables) == set(narrow)
    for name, df in narrow.items():
        gone = [c for c in tables[name].columns if c not in df.columns]
        assert gone == left_out.get(name, ["waypoints"] if name.startswith("insight_") and name != "insight_trip" else [])
        assert _rows(df) == _rows(tables[name].drop(*gone)), name


def _over(monkeypatch, rows):
    monkeypatch.setattr(catalog, "pipeline", lambda *_: Pipeline(rows))
    monkeypatch.setattr(catalog, "derive_landing", lambda *_: rows)


@pytest.mark.parametrize("name, found", [("payload_redacted", [(S.HARSH, "<2 waypoints>", 1)]), ("payload_simplified", [(S.HARSH, "events[].startTime", 1), (S.HARSH, "events[].waypoints", 1)])])
def test_rewritten_payloads_are_judged_without_their_points(spark, landing, monkeypatch, name, found):
    """the status of a payload asks for no typed waypoints."""
    rows = landing([(2, "u", S.DRIVING_INSIGHTS, {"transportEvent": {"id": "t"}, "safetyScores": {}}),
                    (1, "u", S.HARSH, {"transportId": "t", "events": [{"startTime": "x", "waypoints": [{"latitude": 1.0}, {"latitude": 2.0}]}]})])
    _over(monkeypatch, rows)
    df = catalog.REGISTRY[name][0](spark, "")
    assert [tuple(r) for r in sorted(df.collect()) if r.tipo == S.HARSH] == found
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "speedLimitInMps" not in plan


def test_names_and_empty_values_are_kept_by_the_rewritten_text(spark):
    """What needs no escaping is quoted as it is, all else by the writer."""
    texts = ['{"a\\n":[1,{}],"a b":[],"c\\"d":{"x-y_1.0":null},"é":"\\u0001"}', "[]", "{}", '"s"', "5.0", "null"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr("try_parse_json(t)").alias("v"))
    for r in rows.select(redacted_json(F.col("v")).alias("x"), F.to_json("v").alias("y")).collect():
        assert r.x == r.y
    got = rows.select(leaves(F.col("v")).alias("x")).collect()
    assert [sorted((e.path, e.kind, e.value) for e in r.x) for r in got] == [
        [("a\n[]", "number", "1"), ('c"d.x-y_1.0', "null", None), ("é", "string", "\x01")], [], [], [("", "string", "s")], [("", "number", "5")], [("", "null", None)]]


def test_the_queue_is_not_copied_by_its_runs(spark, landing, monkeypatch):
    """what a run takes is read from the loads, not stored once more."""
    days = [dt.datetime(y, 6, 1) for y in (1996, 1998, 2000)]
    rows = landing([(1, "u", S.HARSH, {"transportId": "t", "events": []}, days[0]), (2, "u", S.STATUS, {"startStatus": "STARTED"}, days[1]),
                    (3, "u", S.DRIVING_INSIGHTS, {"transportEvent": {"id": "t"}}, days[2])])
    _over(monkeypatch, rows)
    df = catalog.queue_increment(spark, "")
    assert sorted(map(tuple, df.collect())) == [(0, S.HARSH, 1, 0), (1, S.HARSH, 0, 1), (1, S.STATUS, 1, 0), (2, S.DRIVING_INSIGHTS, 1, 0), (2, S.HARSH, 0, 1)]
    read = [p for p in df.inputFiles() if not p.endswith(".crc")]
    assert read and not any("/taken/" in p for p in read)
