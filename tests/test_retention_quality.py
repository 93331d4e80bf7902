"""Retention plans and data-quality helpers on literal landing rows."""

from __future__ import annotations

import datetime as dt
import json

from tripweave import schemas as S
from tripweave.operators import marts as M
from tripweave.operators import quality as Q
from tripweave.operators import retention as R
from tripweave.operators import trips as T
from tripweave.operators import views as V
from tripweave.operators.handlers import child_items
from tripweave.plans.pipeline import Pipeline

TE = {"id": "t1", "isProvisional": False, "startTime": "2024-01-01T10:00:00.000Z",
      "waypoints": [{"latitude": 1.0, "longitude": 2.0}], "transportTags": {"a": "b"}}


def _pipe(landing):
    return Pipeline(landing([
        (1, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}, dt.datetime(2024, 1, 1)),
        (2, "u", S.HARSH, {"transportId": "t9", "events": [{}]}, dt.datetime(2023, 1, 1)),
        (3, "u", "DebugLog", {}, dt.datetime(2023, 1, 1)),
        (4, "u", S.METADATA, '{"label":', dt.datetime(2023, 1, 1)),
    ]))


def test_raw_purge_only_old_processed_rows(landing):
    p = _pipe(landing)
    plan = {r["id"]: r["action"] for r in R.raw_purge_plan(p.landing, p.landing_status, "2024-03-01").collect()}
    assert plan == {1: "purge", 2: "keep", 3: "keep", 4: "keep"}
    plan = {r["id"]: r["action"] for r in R.raw_purge_plan(p.landing, p.landing_status, "2024-01-05", days=1).collect()}
    assert plan[1] == "keep"  # minimum retention of 7 days


def test_guarded_purge_is_empty_for_processed_rows(landing):
    p = _pipe(landing)
    assert R.guarded_purge(p.landing, p.landing_status, p.source_event).count() == 0


def test_cold_purge_keeps_row_drops_arrays(landing):
    t = R.cold_purge(_pipe(landing).trips(), "2024-06-01").first()
    assert t["is_cold"] and t["waypoints"] is None and t["transport_tags"] is None


def test_expired_pending_orphans(landing):
    p = _pipe(landing)
    assert [r["id"] for r in R.expired_pending(p.landing_status, p.landing, "2024-01-01").collect()] == [2]


def test_lookup_browse_and_ranges(landing):
    p = _pipe(landing)
    assert V.record(p.landing, S.HARSH, 2).count() == 1
    assert [r["id"] for r in V.browse(p.landing, n=2).collect()] == [4, 3]
    assert V.id_range(p.landing).first().asDict() == {"min_id": 1, "max_id": 4}
    assert {r["tipo"]: r["pending"] for r in V.queue_depth(p.landing_status).collect()} == {S.HARSH: 1, "DebugLog": 1}


def test_redaction_and_presence(landing):
    trips = _pipe(landing).trips()
    red = Q.redact_waypoints(trips).first()
    assert red["waypoints_count"] == 1 and "waypoints" not in red.asDict()
    flags = Q.presence_flags(trips, ["end_time", "start_time"]).first()
    assert flags.asDict() == {"has_end_time": False, "has_start_time": True}


def test_ongoing_event_rule(landing):
    p = Pipeline(landing([(1, "u", S.TIMELINE, [{"id": "e1", "isProvisional": False},
                                                {"id": "e2", "isProvisional": True},
                                                {"id": "e3", "endTime": "2024-01-01T00:00:00.000Z"}])]))
    assert [r["event_id"] for r in Q.ongoing_event_nulls(p.timeline_event).collect()] == ["e1"]


def test_named_checks_and_record_status(landing):
    p = Pipeline(landing([
        (1, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
        (2, "u", S.HARSH, {"transportId": "t1", "events": [{}, {}]}),
        (3, "u", S.HARSH, {"transportId": "t9", "events": [{}]}),
        (4, "u", S.SPEEDING, {"events": []}),
        (5, "u", "DebugLog", {}),
        (6, "u", S.METADATA, '{"label":'),
    ]))
    lost = p.child(S.HARSH).filter("pos = 0")  # a table that lost a row
    checks = Q.reconcile_checks(p.resolved, {"insight_trip": (p.insight_trip, "source_event_id"),
                                             "insight_harsh": (lost, "source_event_id")}, p.source_event, p.trips())
    got = {(r["id"], r["check_name"]): (r["expected"], r["actual"], r["result"]) for r in checks.collect()}
    assert got == {
        (1, "insight_trip"): (1, 1, "PASS"), (1, "source_event"): (1, 1, "PASS"),
        (1, "trip_present"): (1, 1, "PASS"), (1, "trip_absent"): (0, 0, "PASS"),
        (2, "insight_harsh"): (2, 1, "FAIL"), (2, "source_event"): (1, 1, "PASS"), (2, "parent"): (1, 1, "PASS"),
        (3, "parent"): (1, 0, "FAIL"), (4, "transport_id"): (1, 0, "WARN"), (5, "validator"): (1, 0, "WARN"),
        (6, "payload"): (1, 0, "ERROR")}
    assert {r["id"]: r["status"] for r in Q.record_status(checks).collect()} == {
        1: "PASS", 2: "FAIL", 3: "FAIL", 4: "WARN", 5: "WARN", 6: "ERROR"}
    assert [r["id"] for r in V.processed(p.landing_status, top=1).collect()] == [1]


def test_trip_mart_takes_each_mode_from_its_source(landing):
    def ctx(criteria, *events):
        return {"criteria": criteria, "userContext": {"events": [
            {"id": i, "type": "IN_TRANSPORT", "transportMode": m, "isProvisional": False} for i, m in events]}}
    p = Pipeline(landing([
        (1, "u", S.DRIVING_INSIGHTS, {"transportEvent": {**TE, "transportMode": "CAR"}}),
        (2, "u", S.CONTEXT_LISTENER, ctx(["CURRENT_EVENT"], ("c1", "CAR"), ("c2", "TRAIN"))),
        (3, "u", S.CONTEXT_LISTENER, ctx(["VISITED_VENUES"], ("c3", "TRAIN"))),
        (4, "u", S.TIMELINE, [{"id": "e1", "type": "IN_TRANSPORT", "transportMode": "WALKING"}]),
    ]))
    m = M.trip_mart(p.trips(), p.insight_trip, T.current_transports(p.accepted_alone))
    assert sorted(r["viaje"] for r in m.collect()) == ["c2", "t1"]


def test_event_mart_keeps_whole_events_in_time_order(landing):
    p = Pipeline(landing([
        (1, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
        (2, "u", S.HARSH, {"transportId": "t1", "events": [
            {"startTimeEpoch": 9, "magnitude": 2.5, "confidence": 80.0, "type": "BRAKING"},
            {"startTimeEpoch": 4, "magnitude": 1.5, "type": "BRAKING", "waypoints": [{"latitude": 1.0, "longitude": 2.0}]}]}),
        (3, "u", S.CALL, {"transportId": "t1", "events": [{"handsFreeState": "HANDHELD", "minTraveledSpeedMps": 3.0}]}),
    ]))
    items = child_items(p.accepted, *M.EVENT_TYPES)
    row = M.events_mart(p.insight_trip, items).first()
    assert json.loads(row["frenado"]) == [
        {"startTimeEpoch": 4, "magnitude": 1.5, "type": "BRAKING", "waypoints": [{"latitude": 1.0, "longitude": 2.0}]},
        {"startTimeEpoch": 9, "magnitude": 2.5, "confidence": 80.0, "type": "BRAKING"}]
    assert json.loads(row["llamados"]) == [{"handsFreeState": "HANDHELD", "minTraveledSpeedMps": 3.0}]
    assert row["aceleracion"] == row["curvas"] == row["uso_telefono"] == row["exceso_de_velocidad"] == "[]"
    row = M.events_mart(p.insight_trip, items, min_magnitude=2.0).first()
    assert [e["startTimeEpoch"] for e in json.loads(row["frenado"])] == [9] and row["exceso_velocidad"] == "[]"
