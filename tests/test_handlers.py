"""Handler extraction, routing, guard, quarantine (ported reference cases + gaps)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.plans.pipeline import Pipeline

TE = {
    "id": "t1", "startTime": "2026-04-21T10:00:00.000Z", "startTimeEpoch": 1776765600000,
    "lastUpdateTime": "2026-04-21T10:30:00.000Z", "endTime": "2026-04-21T10:30:00.000Z",
    "durationInSeconds": 1800, "distance": 2035.5, "transportMode": "CAR", "occupantRole": "DRIVER",
    "isProvisional": False, "transportTags": {"a": "b"},
    "waypoints": [{"latitude": 1.0, "longitude": 2.0, "timestamp": 1, "speedInMps": 3.5}],
}
SCORES = {"smoothScore": 0.1, "focusScore": 0.2, "legalScore": 0.3, "callWhileMovingScore": 0.4,
          "overallScore": 0.8362, "harshBrakingScore": 0.5, "harshTurningScore": 0.6,
          "harshAccelerationScore": 0.7, "wrongWayDrivingScore": 0.8, "attentionScore": 0.9}


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_insight_scores_in_order_and_narrowed(landing):
    p = Pipeline(landing([(1, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE, "safetyScores": SCORES})]))
    r = p.insight_trip.first()
    got = [float(r[dst]) for _, dst in S.SCORE_FIELDS]
    assert got == [0.1, 0.2, 0.3, 0.4, 0.836, 0.5, 0.6, 0.7, 0.8, 0.9]
    assert r["canonical_id"] == "t1" and r["trip_id"] is not None and r["transport_tags"] == {"a": "b"}


def test_insight_null_scores_and_empty_tags(landing):
    te = dict(TE, transportTags={})
    p = Pipeline(landing([(1, "u", S.DRIVING_INSIGHTS, {"transportEvent": te, "safetyScores": {"overallScore": None}})]))
    r = p.insight_trip.first()
    assert r["overall_score"] is None and r["smooth_score"] is None and r["transport_tags"] is None


def test_inline_sub_events_ignored(landing):
    payload = {"transportEvent": TE, "safetyScores": SCORES, "harshDrivingEvents": [{"magnitude": 1}]}
    p = Pipeline(landing([(1, "u", S.DRIVING_INSIGHTS, payload)]))
    assert p.child(S.HARSH).count() == 0 and p.insight_trip.count() == 1


def test_provisional_insight_has_no_trip(landing):
    te = dict(TE, isProvisional=True)
    p = Pipeline(landing([(1, "u", S.DRIVING_INSIGHTS, {"transportEvent": te})]))
    assert p.insight_trip.first()["trip_id"] is None
    assert p.trips().count() == 0


CTX = {"semanticTime": "MORNING", "lastKnownLocation": {"latitude": 1.5, "longitude": 2.5, "accuracy": 10},
       "home": {"location": {"latitude": 1, "longitude": 2}, "significance": "HOME", "type": "RESIDENTIAL"},
       "work": None,
       "activeSegments": [{"id": 7, "category": "MOBILITY", "attributes": [{"name": "a", "value": 1.25}]}],
       "events": [{"id": "e1", "type": "IN_TRANSPORT", "transportMode": "CAR", "isProvisional": False},
                  {"id": "e2", "type": "STATIONARY", "venue": None}]}


def test_context_listener_and_manual(landing):
    p = Pipeline(landing([
        (1, "u", S.CONTEXT_LISTENER, {"criteria": ["CURRENT_EVENT", "VISITED_VENUES"], "userContext": CTX}),
        (2, "u", S.CONTEXT_MANUAL, CTX),
    ]))
    assert rows(p.context_header, "context_id", "context_source_type") == [(1, "LISTENER"), (2, "MANUAL")]
    assert rows(p.context_criteria, "context_id", "criteria_code") == [
        (1, "CURRENT_EVENT"), (1, "VISITED_VENUES"), (2, "MANUAL_REQUEST")]
    assert rows(p.context_home, "context_id", "significance") == [(1, "HOME"), (2, "HOME")]
    assert p.context_work.count() == 0
    assert rows(p.context_segment, "context_id", "segment_id") == [(1, "7"), (2, "7")]
    assert [float(v) for (v,) in rows(p.context_segment_attribute, "attribute_value")] == [1.25, 1.25]
    ev = rows(p.context_event, "context_id", "event_id", "venue_type")
    assert ev == [(1, "e1", None), (1, "e2", None), (2, "e1", None), (2, "e2", None)]
    t = p.trips().collect()
    assert len(t) == 1 and t[0]["n_writers"] == 2 and t[0]["first_seen_from"] == "CONTEXT"


def test_context_explicit_nulls_are_missing(landing):
    ctx = {"semanticTime": None, "lastKnownLocation": None, "activeSegments": None, "events": None}
    p = Pipeline(landing([(1, "u", S.CONTEXT_LISTENER, {"criteria": None, "userContext": ctx})]))
    assert p.landing_status.first()["status"] == S.PROCESSED
    h = p.context_header.first()
    assert h["last_known_latitude"] is None and p.context_event.count() == 0 and p.context_criteria.count() == 0


CRASH = {"time": 1700000000000, "location": {"latitude": 1.5, "longitude": 2.5, "accuracy": 3, "altitude": 4},
         "magnitude": 2.5, "speedAtImpact": 10.0, "deltaV": 3.0, "confidence": 57, "severity": "HIGH",
         "detectorMode": "CAR", "precedingLocations": [{"latitude": 1, "longitude": 2}, {"latitude": 3, "longitude": 4}]}


def test_crash_destructured_and_empty_location(landing):
    p = Pipeline(landing([(1, "u", S.CRASH, CRASH), (2, "u", S.CRASH, dict(CRASH, location={}))]))
    r = {x["crash_event_id"]: x for x in p.crash_event.collect()}
    assert float(r[1]["latitude"]) == 1.5 and float(r[1]["altitude"]) == 4.0 and float(r[1]["confidence"]) == 57.0
    assert r[2]["latitude"] is None and len(r[2]["preceding_locations"]) == 2


def test_status_flags(landing):
    base = {"startStatus": "STARTED", "detectionStatus": "ENABLED_AND_DETECTING", "locationPermission": "ALWAYS"}
    p = Pipeline(landing([
        (1, "u", S.STATUS, dict(base, isPreciseLocationPermGranted=True, isLocationAvailable=False, canDetect=True)),
        (2, "u", S.STATUS, base),
        (3, "u", S.STATUS, dict(base, canDetect="false")),
    ]))
    got = rows(p.sdk_status, "sdk_status_id", "precise_location_granted", "is_location_available", "can_detect")
    assert got == [(1, True, False, True), (2, False, False, False), (3, False, False, False)]


def test_metadata_values(landing):
    p = Pipeline(landing([(1, "u", S.METADATA, {"label": "n", "value": 42}),
                          (2, "u", S.METADATA, {"label": "b", "value": True}),
                          (3, "u", S.METADATA, {"label": "z", "value": None})]))
    assert rows(p.user_metadata, "metadata_id", "value") == [(1, "42"), (2, "True"), (3, None)]


TL_EVENTS = [{"id": "e1", "type": "IN_TRANSPORT", "isProvisional": True, "venue": None},
             {"id": "e2", "type": "IN_TRANSPORT", "isProvisional": False, "transportMode": "BUS",
              "startTime": "2026-01-01T10:00:00.000Z"}]


def test_timeline_both_shapes_and_provisional(landing):
    p = Pipeline(landing([(1, "u", S.TIMELINE, {"events": TL_EVENTS}), (2, "v", S.TIMELINE_UPDATE, TL_EVENTS)]))
    t = rows(p.timeline_event, "source_event_id", "event_id", "is_provisional", "venue_significance")
    assert t == [(1, "e1", True, None), (1, "e2", False, None), (2, "e1", True, None), (2, "e2", False, None)]
    trips = rows(p.trips(), "user_id", "canonical_id")
    assert trips == [("u", "e2"), ("v", "e2")]


def test_activity_trip_and_document_keys(landing):
    p = Pipeline(landing([(1, "u", S.ACTIVITY, {"activityType": "IN_TRANSPORT", "startTime": "2026-01-01T10:00:00.000Z"}),
                          (2, "u", S.ACTIVITY, {"type": "STATIONARY", "stationaryInfo": {"location": {"latitude": 5}}})]))
    a = rows(p.user_activity, "activity_id", "activity_type", "is_trip")
    assert a == [(1, "IN_TRANSPORT", True), (2, "STATIONARY", False)]
    assert float(p.user_activity.filter("activity_id = 2").first()["stationary_latitude"]) == 5.0
    assert rows(p.trips(), "canonical_id", "first_seen_from") == [("activity:1", "ACTIVITY")]


def test_call_speed_key_variants(landing):
    ev1 = {"minTraveledSpeedMps": 1.5, "maxTraveledSpeedMps": 9.0}
    ev2 = {"minTraveledSpeedInMps": 2.5, "maxTraveledSpeedInMps": 8.0}
    p = Pipeline(landing([(5, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
                          (6, "u", S.CALL, {"transportId": "t1", "events": [ev1, ev2]})]))
    got = sorted((float(r["min_traveled_speed_mps"]), float(r["max_traveled_speed_mps"])) for r in p.child(S.CALL).collect())
    assert got == [(1.5, 9.0), (2.5, 8.0)]


def test_routing_covers_fifteen_types(landing):
    assert len(S.ROUTES) == 15 and len(set(S.ROUTES.values())) == 13


def test_guard_pending_failed_processed(landing):
    harsh = {"events": [{"magnitude": 1.0, "confidence": 0.5, "type": "BRAKING"}]}
    p = Pipeline(landing([
        (1, "u", S.HARSH, dict(harsh, transportId="t1")),      # child before parent
        (2, "u", S.HARSH, harsh),                               # no transport id
        (3, "u", S.HARSH, dict(harsh, transportId="t9")),       # no parent at all
        (4, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
        (5, "u", "DebugLog", {"message": "x"}),
    ]))
    st = rows(p.landing_status, "id", "status", "reason")
    assert st == [(1, "PROCESSED", None), (2, "FAILED", "missing_transport_id"), (3, "PENDING", "awaiting_parent"),
                  (4, "PROCESSED", None), (5, "PENDING", "unrouted_type")]
    h = p.child(S.HARSH).collect()
    assert len(h) == 1 and h[0]["insight_trip_id"] == 4 and h[0]["harsh_type"] == "BRAKING"


def test_guard_uses_lowest_parent_id(landing):
    p = Pipeline(landing([(9, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
                          (7, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
                          (8, "u", S.PHONE, {"transportId": "t1", "events": [{"callState": "NO_CALL"}]})]))
    assert [r["insight_trip_id"] for r in p.child(S.PHONE).collect()] == [7]


def test_quarantine_malformed_duplicate_keys_overflow(landing):
    p = Pipeline(landing([
        (1, "u", S.METADATA, '{"label": "a", "value": '),
        (2, "u", S.METADATA, '{"label": "a", "label": "b", "value": 1}'),
        (3, "u", S.CRASH, dict(CRASH, magnitude=12345.0)),
    ]))
    q = rows(p.quarantine, "original_id", "reason")
    assert q == [(1, "malformed_json"), (3, "numeric_overflow")]
    assert p.user_metadata.first()["label"] == "b"
    assert p.crash_event.count() == 0


def test_failed_parent_leaves_children_pending(landing):
    te = dict(TE)
    p = Pipeline(landing([(1, "u", S.DRIVING_INSIGHTS, {"transportEvent": te, "safetyScores": {"overallScore": 12.5}}),
                          (2, "u", S.SPEEDING, {"transportId": "t1", "events": [{}]})]))
    assert rows(p.landing_status, "id", "status") == [(1, "FAILED"), (2, "PENDING")]


def test_source_event_time_and_ref(landing):
    p = Pipeline(landing([
        (1, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}),
        (2, "u", S.TIMELINE, TL_EVENTS),
        (3, "u", S.CRASH, CRASH, dt.datetime(2025, 5, 5, 5, 5, 5)),
    ]))
    se = {r["source_event_id"]: r for r in p.source_event.collect()}
    assert se[1]["source_time"] == dt.datetime(2026, 4, 21, 10) and se[1]["source_event_ref"] == "t1"
    assert se[2]["source_event_ref"] == "e1"
    assert se[3]["source_time"] == dt.datetime(2025, 5, 5, 5, 5, 5) and se[3]["source_event_ref"] == "3"


def test_detail_rows_follow_array_order(landing):
    p = Pipeline(landing([(1, "u", S.TIMELINE, {"events": [{"id": "b"}, {"id": "a"}]})]))
    assert rows(p.timeline_event, "pos", "event_id") == [(0, "b"), (1, "a")]
    assert F is not None


def test_values_of_the_wrong_kind_are_quarantined(landing):
    te = {"id": "t1", "isProvisional": False}
    cases = [
        (S.TIMELINE, '"abc"', "wrong_shape"), (S.TIMELINE, '{"events":"xx"}', "wrong_field"),
        (S.TIMELINE, '[{"id":"e"}, 3]', "wrong_field"), (S.TIMELINE, '{"foo":1}', None), (S.TIMELINE, '{"events":null}', None),
        (S.DRIVING_INSIGHTS, '[{"transportEvent":{}}]', "wrong_shape"), (S.DRIVING_INSIGHTS, '{"transportEvent":"x"}', "wrong_field"),
        (S.DRIVING_INSIGHTS, {"transportEvent": te}, None), (S.HARSH, '[1]', "wrong_shape"),
        (S.HARSH, {"transportId": "t1", "events": "xx"}, "wrong_field"), (S.HARSH, {"transportId": "t1", "events": [None]}, "wrong_field"),
        (S.HARSH, {"transportId": "t1", "events": None}, None), (S.HARSH, {"transportId": "zz", "events": "xx"}, "awaiting_parent"),
        (S.CONTEXT_LISTENER, {"userContext": [1]}, "wrong_field"), (S.CONTEXT_LISTENER, {"userContext": {"events": {}}}, "wrong_field"),
        (S.CONTEXT_MANUAL, {"home": 4}, "wrong_field"), (S.CONTEXT_MANUAL, {"home": None}, None),
        (S.CRASH, {"location": "here"}, "wrong_field"), (S.STATUS, "7", "wrong_shape"), (S.METADATA, "null", "wrong_shape"),
    ]
    p = Pipeline(landing([(i, "u", t, body) for i, (t, body, _) in enumerate(cases)]))
    got = {r["id"]: r["reason"] for r in p.landing_status.collect()}
    assert [(i, got[i]) for i in sorted(got)] == [(i, c[2]) for i, c in enumerate(cases)]


def test_locations_out_of_range_are_quarantined(landing):
    far = {"latitude": 500.0, "longitude": 1.0}
    p = Pipeline(landing([
        (1, "u", S.CRASH, dict(CRASH, location=far)), (2, "u", S.CONTEXT_MANUAL, {"lastKnownLocation": far}),
        (3, "u", S.CONTEXT_MANUAL, {"home": {"location": far}}), (4, "u", S.CONTEXT_MANUAL, {"events": [{"location": far}]}),
        (5, "u", S.TIMELINE, [{"id": "e", "location": {"accuracy": 1e11}}]),
        (6, "u", S.ACTIVITY, {"stationaryLocation": far}), (7, "u", S.CRASH, dict(CRASH, location={"longitude": 1000.0})),
    ]))
    assert {r["reason"] for r in p.landing_status.collect()} == {"numeric_overflow"} and p.quarantine.count() == 7
