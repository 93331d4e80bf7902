"""Trip fold U1: first/last writer rules, enrich policy, incremental refold."""

from __future__ import annotations

import datetime as dt

from tripweave import schemas as S
from tripweave.operators.handlers import detail_id
from tripweave.operators import trips as T
from tripweave.plans.pipeline import Pipeline


DAY = dt.datetime(2024, 1, 1)


def _ev(**kw):
    base = {"id": "e1", "type": "IN_TRANSPORT", "isProvisional": False}
    base.update(kw)
    return base


def test_first_and_last_writer_with_nulls(landing):
    p = Pipeline(landing([
        (1, "u", S.TIMELINE, [_ev(startTime="2026-01-01T10:00:00.000Z", transportMode="CAR", distance=10.0,
                                  waypoints=[{"latitude": 1, "longitude": 1}])]),
        (2, "u", S.TIMELINE, [_ev(startTime="2026-01-01T11:00:00.000Z", distance=None, transportMode="BUS",
                                  endTime="2026-01-01T12:00:00.000Z")]),
        (3, "u", S.TIMELINE, [_ev(transportMode=None)]),
    ]))
    ref = p.trips("reference").first()
    assert str(ref["start_time"]) == "2026-01-01 10:00:00"           # first writer
    assert ref["creating_source_event_id"] == 1 and len(ref["waypoints"]) == 1
    assert ref["transport_mode"] is None and ref["distance_meters"] is None  # last writer, NULL overwrites
    assert ref["end_time"] is None and ref["last_updated_by_source_event_id"] == 3 and ref["n_writers"] == 3
    enr = p.trips("enrich").first()
    assert enr["transport_mode"] == "BUS" and float(enr["distance_meters"]) == 10.0
    assert str(enr["end_time"]) == "2026-01-01 12:00:00"


def test_first_writer_null_is_kept(landing):
    p = Pipeline(landing([(1, "u", S.TIMELINE, [_ev()]),
                          (2, "u", S.TIMELINE, [_ev(startTime="2026-01-01T11:00:00.000Z")])]))
    assert p.trips().first()["start_time"] is None
    assert str(p.trips("enrich").first()["start_time"]) == "2026-01-01 11:00:00"


def test_refold_equals_full_fold(landing):
    rows = [(i, "u", S.TIMELINE, [_ev(id=f"e{i % 3}", transportMode=m, distance=float(i))])
            for i, m in enumerate(["CAR", None, "BUS", "TRAIN", None, "CAR", "WALKING"], start=1)]
    full = Pipeline(landing(rows)).trips()
    first = Pipeline(landing(rows[:3])).trips()
    rest = Pipeline(landing(rows[3:])).trip_candidates
    inc = T.refold(first, rest)
    cols = ["user_id", "canonical_id", "transport_mode", "distance_meters", "creating_source_event_id",
            "last_updated_by_source_event_id", "n_writers"]
    assert sorted(full.select(cols).collect()) == sorted(inc.select(cols).collect())


def test_ids_and_positions_beyond_packed_ranges(spark, landing):
    p = Pipeline(landing([(10**18 + 7, "u", S.TIMELINE, [_ev(id="a", transportMode="CAR")], DAY),
                          (10**13, "u", S.TIMELINE, [_ev(id="a", transportMode="BUS")], DAY)]))
    t = p.trips().first()
    assert t["creating_source_event_id"] == 10**13 and t["transport_mode"] == "CAR"
    keys = spark.createDataFrame([(1, 1_500_000), (2, 0), (-1, 5), (2**63 - 1, 2**31 - 1)], "id bigint, pos int").select(
        "id", "pos", detail_id().alias("k")).orderBy("k").collect()
    assert [(r["id"], r["pos"]) for r in keys] == [(-1, 5), (1, 1_500_000), (2, 0), (2**63 - 1, 2**31 - 1)]
    assert len({r["k"] for r in keys}) == 4


def test_fold_keeps_nested_columns_out_of_aggregates(landing):
    p = Pipeline(landing([(1, "u", S.TIMELINE, [_ev()])]))
    plan = p.trips()._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    enrich = p.trips("enrich")._jdf.queryExecution().executedPlan().toString()
    assert not [ln for ln in enrich.splitlines() if "Aggregate(" in ln and "waypoints#" in ln and "functions=[" in ln
                and ("max_by(waypoints" in ln or "min_by(waypoints" in ln)]


def test_trips_of_unknown_users_are_kept(landing):
    p = Pipeline(landing([(1, None, S.TIMELINE, [_ev(transportMode="CAR")]),
                          (2, None, S.TIMELINE, [_ev(transportMode="BUS")])]))
    (t,) = p.trips().collect()
    assert t["user_id"] is None and t["transport_mode"] == "BUS" and t["creating_source_event_id"] == 1
