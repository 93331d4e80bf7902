"""Payload differences, foreign keys, hash look-ups, large documents and the queue cursor."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.operators import dedup as D
from tripweave.operators import parse as P
from tripweave.operators import quality as Q
from tripweave.operators.handlers import preceding_points
from tripweave.operators.payload_diff import COLUMNS, payload_diff
from tripweave.plans.pipeline import Pipeline
from tripweave.sources.cursor import QueueCursor, write_load
from tripweave.sources.landing import array_separator, read_json_array, write_json_arrays

DAY = dt.datetime(2024, 1, 1)
TE = {"id": "t1", "isProvisional": False, "distance": 12.5, "transportTags": {"a": "b"}, "startTime": "2024-01-01T10:00:00.000Z"}


def model(landing):
    return Pipeline(landing([
        (1, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE, "safetyScores": {"smoothScore": 0.5, "focusScore": None}}),
        (2, "u", S.HARSH, {"transportId": "t1", "events": [
            {"type": "BRAKING", "magnitude": 2.5, "waypoints": [{"latitude": 1.0, "longitude": 2, "isSynthetic": True}]}, {"type": "BRAKING"}]}),
        (3, "u", S.TIMELINE, [{"id": "e1", "type": "STATIONARY", "venue": {"type": "SHOP", "location": {"latitude": 1.5}}}]),
        (4, "u", S.CONTEXT_LISTENER, {"criteria": ["A", "B", "A"], "userContext": {"semanticTime": "MORNING", "activeSegments": [
            {"id": 7, "attributes": [{"name": "x", "value": 1.25}]}]}}),
        (5, "u", S.METADATA, {"label": "on", "value": True}),
        (6, "u", S.TECHNICAL, '{"type":'),
    ])).materialized()


def diff_of(p, **changed):
    tables = {name: df for name, df in p.tables(trips=False).items() if name in COLUMNS}
    got = payload_diff(p.accepted, {**tables, **changed}).collect()
    return {(r["tipo"], r["path"]): (r["n_payload"], r["n_table"], r["n_matched"], r["n_missing"], r["n_extra"]) for r in got}


def test_payload_diff_counts_every_leaf(landing):
    got = diff_of(model(landing))
    assert got[S.DRIVING_INSIGHTS, "transportEvent.distance"] == (1, 1, 1, 0, 0)
    assert got[S.DRIVING_INSIGHTS, "transportEvent.transportTags.a"] == (1, 1, 1, 0, 0)
    assert got[S.DRIVING_INSIGHTS, "transportEvent.startTime"] == (1, 0, 0, 1, 0)  # kept in the trip, not in the insight
    assert (S.DRIVING_INSIGHTS, "safetyScores.focusScore") not in got  # an explicit null
    assert got[S.HARSH, "events[].type"] == (2, 2, 2, 0, 0) and got[S.HARSH, "transportId"] == (1, 0, 0, 1, 0)
    assert got[S.HARSH, "events[].waypoints[].isSynthetic"] == (1, 1, 1, 0, 0)
    assert got[S.TIMELINE, "events[].venue.location.latitude"] == (1, 0, 0, 1, 0)
    assert got[S.TIMELINE, "events[].isProvisional"] == (0, 1, 0, 0, 1)  # missing reads as false
    assert got[S.CONTEXT_LISTENER, "criteria[]"] == (3, 3, 3, 0, 0)
    assert got[S.CONTEXT_LISTENER, "activeSegments[].attributes[].value"] == (1, 1, 1, 0, 0)
    assert got[S.METADATA, "value"] == (1, 1, 0, 1, 1)  # true against True
    assert not [k for k in got if k[0] == S.TECHNICAL]


def test_payload_diff_finds_lost_and_changed_rows(landing):
    p = model(landing)
    harsh = p.child(S.HARSH)
    got = diff_of(p, insight_harsh=harsh.filter("pos = 0").withColumn("magnitude", F.lit(9.0)))
    assert got[S.HARSH, "events[].type"] == (2, 1, 1, 1, 0) and got[S.HARSH, "events[].magnitude"] == (1, 1, 0, 1, 1)
    got = diff_of(p, user_metadata=p.user_metadata.withColumn("metadata_id", F.lit(99).cast("bigint")))
    assert got[None, "label"] == (0, 1, 0, 0, 1) and got[S.METADATA, "label"] == (1, 0, 0, 1, 0)


def test_reconciliation_sees_lost_and_doubled_rows(landing):
    p = model(landing)
    tables = {"insight_harsh": (p.child(S.HARSH).filter("pos = 0"), "source_event_id"),
              "timeline_event": (p.timeline_event.unionByName(p.timeline_event), "source_event_id")}
    got = {(r["id"], r["check_name"]): (r["expected"], r["actual"], r["result"])
           for r in Q.reconcile_checks(p.resolved, tables, p.source_event, p.trips()).collect()}
    assert got[2, "insight_harsh"] == (2, 1, "FAIL") and got[3, "timeline_event"] == (1, 2, "FAIL")


def test_foreign_keys_and_the_cascade(landing):
    p = model(landing)
    tables = {**p.tables(), "landing": p.landing}
    clean = {r["fk_name"]: (r["on_delete"], r["n_rows"], r["n_orphans"]) for r in Q.fk_orphans(tables).collect()}
    assert len(clean) == 16 and {n for _, _, n in clean.values()} == {0}
    assert clean["insight_harsh.source_event_id"] == ("CASCADE", 2, 0) and clean["insight_trip.trip_id"] == ("NO ACTION", 1, 0)
    lost = {r["fk_name"]: r["n_orphans"] for r in Q.fk_orphans({**tables, "source_event": p.source_event.filter("source_event_id <> 2"),
                                                               "trip": p.trips().limit(0)}).collect()}
    assert {k: n for k, n in lost.items() if n} == {"insight_harsh.source_event_id": 2, "insight_trip.trip_id": 1}
    plan = {r["fk_name"]: (r["n_deleted"], r["n_blocking"]) for r in Q.cascade_plan(p.source_event.filter("source_event_id < 3"), tables).collect()}
    assert {k: n for k, n in plan.items() if n != (0, 0)} == {
        "source_event.landing_id": (2, 0), "insight_trip.source_event_id": (1, 0), "insight_harsh.source_event_id": (2, 0), "insight_trip.trip_id": (1, 0)}


def test_a_trip_stays_blocked_by_its_other_insight(landing):
    p = Pipeline(landing([(i, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}) for i in (1, 2, 3)])).materialized()
    plan = {r["fk_name"]: (r["n_deleted"], r["n_blocking"]) for r in Q.cascade_plan(p.source_event.filter("source_event_id = 2"), {**p.tables(), "landing": p.landing}).collect()}
    assert plan["insight_trip.trip_id"] == (1, 2)


def test_preceding_points_out_of_range_are_kept(landing):
    p = Pipeline(landing([(1, "u", S.CRASH, {"time": 1, "precedingLocations": [{"latitude": 500.0, "longitude": 1.0}, {"latitude": 2.0}]})]))
    assert p.landing_status.first()["status"] == S.PROCESSED
    assert [(r["point_pos"], r["latitude"]) for r in preceding_points(p.crash_event).orderBy("point_pos").collect()] == [(0, 500.0), (1, 2.0)]


def test_seen_hashes_are_not_moved(spark):
    rows = spark.createDataFrame([(i, f"h{i}") for i in range(50)] + [(99, None)], "id int, payload_hash string")
    path = tempfile.mkdtemp(prefix="tripweave-seen-")
    name = f"seen_{os.path.basename(path).replace('-', '_')}"
    D.store_seen(rows.filter("id < 30"), name, f"{path}/t", buckets=8)
    out = D.already_seen(rows, spark.table(name))
    assert sorted(r["id"] for r in out.collect()) == [*range(30, 50), 99]
    plan = out._jdf.queryExecution().executedPlan().toString()
    seen_side = plan[plan.rindex("Scan parquet") - 600 :]
    assert plan.count("Exchange hashpartitioning") <= 2 and "Bucketed: true" in plan and "Exchange hashpartitioning" not in seen_side.split("Scan parquet")[0][-200:]
    spark.sql(f"DROP TABLE {name}")


def elements(n):
    text = json.dumps({"a": [{"b": 1}, {"c": '},{"original_id":5'}], "d": "],["})
    return [{"original_id": i, "user_id": f"u{i % 7}", "json": text if i % 3 else None, "tipo": "X", "created_at": "2024-01-01 00:00:00", "app_version": None if i % 2 else "}"}
            for i in range(n)]


def test_one_large_document_is_read_by_several_tasks(spark):
    folder = tempfile.mkdtemp(prefix="tripweave-doc-")
    data = elements(60_000)
    with open(f"{folder}/big.json", "w") as f:
        json.dump(data, f, separators=(",", ":"))
    df = read_json_array(spark, f"{folder}/big.json")
    assert os.path.getsize(f"{folder}/big.json") > 8_000_000 and df.rdd.getNumPartitions() > 1
    assert df.count() == 60_000 and df.select("id").distinct().count() == 60_000
    r = df.filter("id = 59999").first()
    assert (r["user_id"], r["json"], r["app_version"]) == (data[-1]["user_id"], data[-1]["json"], data[-1]["app_version"])
    assert df.filter("id % 3 <> 0 AND json <> '" + data[1]["json"].replace("\\", "\\\\").replace("'", "\\'") + "'").count() == 0


def test_documents_in_other_formats(spark):
    for kw in ({"indent": 2}, {"separators": (", ", ": ")}, {"indent": 0}):
        folder = tempfile.mkdtemp(prefix="tripweave-doc-")
        for n, name in ((9, "a"), (1, "b"), (0, "c")):
            with open(f"{folder}/{name}.json", "w") as f:
                json.dump(elements(n), f, **kw)
        got = read_json_array(spark, f"{folder}/a.json").collect()
        assert [(r["id"], r["json"], r["app_version"]) for r in sorted(got, key=lambda r: r["id"])] == [(e["original_id"], e["json"], e["app_version"]) for e in elements(9)]
        assert read_json_array(spark, f"{folder}/b.json", separator=array_separator(json.dumps(elements(2), **kw))).count() == 1
        assert read_json_array(spark, f"{folder}/c.json", separator='},{"').count() == 0


def test_written_arrays_read_back(spark, landing):
    land = landing([(i, "u", S.METADATA, {"label": 'q"},{"', "value": i}) for i in range(20)])
    path = tempfile.mkdtemp(prefix="tripweave-doc-")
    write_json_arrays(land.repartition(3), path)
    assert sorted(map(str, read_json_array(spark, path).select(*land.columns).collect())) == sorted(map(str, land.collect()))


def test_a_second_run_reads_new_loads_only(spark, landing):
    base = tempfile.mkdtemp(prefix="tripweave-queue-")
    first = [(1, "u", S.HARSH, {"transportId": "t1", "events": [{}]}), (2, "u", S.METADATA, {"label": "a"}), (3, "u", "DebugLog", {})]
    second = [(4, "u", S.DRIVING_INSIGHTS, {"transportEvent": TE}), (0, "u", S.STATUS, {})]
    write_load(landing(first), f"{base}/landing", 0)

    def run(parents):
        cursor = QueueCursor(spark, f"{base}/landing", f"{base}/cursor")
        taken = cursor.pending()
        ids = sorted(r["id"] for r in taken.collect())
        files = {f.split("load=")[1][0] for f in taken.inputFiles() if "load=" in f}
        rows = landing([r for r in [*first, *second] if r[0] in ids])
        keys = P.parent_keys(P.classify(P.typed(P.parse(landing(parents)))))
        cursor.commit(taken, P.landing_status(P.resolve(P.classify(P.typed(P.parse(rows))), keys)))
        return ids, files

    assert run([]) == ([1, 2], {"0"})
    write_load(landing(second), f"{base}/landing", 1)
    assert QueueCursor(spark, f"{base}/landing", f"{base}/cursor").pending(limit=1).first()["id"] == 0
    assert run(second[:1])[0] == [0, 1, 4]
    cursor = QueueCursor(spark, f"{base}/landing", f"{base}/cursor")
    assert (cursor.mark, cursor.loads) == (1, []) and cursor.pending().count() == 0
    plan = cursor.pending()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "load" in plan and "Join" not in plan


def test_newest_insights_parse_no_other_payload(spark, landing):
    """Rows of one id and a child under an insight's id included, the result is that of the joins over all rows."""
    from tripweave.operators.views import newest_insights, recent_insights
    rows = landing([*[(i, "u", S.DRIVING_INSIGHTS, {"transportEvent": {"id": f"t{i}"}}) for i in range(1, 9)], (8, "u", S.HARSH, {"transportId": "t2", "events": [{}]}),
                    (9, "u", S.DRIVING_INSIGHTS, "{broken"), (10, "u", S.METADATA, {"label": "a", "value": 1})])
    p = Pipeline(rows)
    ids = newest_insights(rows, 3)
    few = p.chosen(ids)
    assert sorted(r.id for r in few.classified.select("id").collect()) == [7, 8, 8, 9]
    whole = recent_insights(rows, p.source_event, p.insight_trip, 5)
    got = recent_insights(rows, few.source_event, few.insight_trip, 3)
    assert sorted(map(str, got.collect())) == sorted(map(str, recent_insights(rows, p.source_event, p.insight_trip, 3).collect()))
    assert [r.id for r in whole.collect()] == [9, 8, 8, 7, 6] and [r.id for r in got.collect()] == [9, 8, 8]
