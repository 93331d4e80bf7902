"""The stored stage: what is written once for many tables, and what a plan doesn't compute."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.plans.pipeline import Pipeline, read_all, write_all

ROWS = [(1, "u", S.STATUS, {"startStatus": "STARTED"}), (2, "u", S.CRASH, {"time": 5, "magnitude": 1.5}),
        (3, "u", S.TECHNICAL, {"type": "A", "message": "m"}), (4, "u", S.METADATA, "{broken"),
        (5, "u", S.TIMELINE, [{"id": "e", "type": "IN_TRANSPORT", "startTime": "2024-01-01T10:00:00.000Z"}])]


def _text(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


def test_stage_keeps_texts_only_where_a_table_does(spark, landing):
    rows = landing(ROWS)
    texts = _text(rows, "id", "json")
    out = tempfile.mkdtemp(prefix="tripweave-model-")
    write_all(rows, out)
    stage = spark.read.schema("id long, json string").parquet(f"{out}/resolved/v=0")
    assert _text(stage, "id", "json") == {1: None, 2: texts[2], 3: texts[3], 4: texts[4], 5: None}
    tables = read_all(spark, out)
    assert _text(tables["crash_event"], "source_event_id", "payload_json") == {2: texts[2]}
    assert _text(tables["technical_event"], "source_event_id", "payload_json") == {3: texts[3]}
    assert _text(tables["quarantine"], "original_id", "raw_json") == {4: texts[4]}
    whole = Pipeline(rows)
    for copy in (whole.materialized(texts=False), whole.materialized()):
        assert sorted(map(str, copy.source_event.collect())) == sorted(map(str, whole.source_event.collect()))
    assert _text(whole.materialized().resolved, "id", "json") == texts


def test_stage_has_the_named_columns_only(spark, landing):
    whole = Pipeline(landing(ROWS))
    some = whole.materialized(("id", "user_id", "tipo", "status", "status_reason"))
    assert set(some.resolved.columns) == {"id", "user_id", "tipo", "status", "status_reason"}
    assert sorted(map(str, some.landing_status.collect())) == sorted(map(str, whole.landing_status.collect()))


def test_audit_fields_are_read_by_the_audit_table_alone(spark, landing):
    p = Pipeline(landing(ROWS))

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "$[0].startTime" in plan(p.source_event)
    assert "$[0].startTime" not in plan(p.landing_status.groupBy("status").agg(F.count("*")))
