"""Pure scalar rules: timestamps, hashes, empty values, polyline."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tripweave.functions import encoded_polyline, format_ts, nonempty, payload_hash, scalar_text, truthy


def _one(spark, col, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("out")).first()["out"]


def test_format_ts_keeps_wall_clock_with_ms(spark):
    assert _one(spark, format_ts("s"), "2026-04-21T15:04:23.824Z") == dt.datetime(2026, 4, 21, 15, 4, 23, 824000)


def test_format_ts_cuts_long_fractions_to_ms(spark):
    assert _one(spark, format_ts("s"), "2026-04-21T15:04:23.824123456Z") == dt.datetime(2026, 4, 21, 15, 4, 23, 824000)
    assert _one(spark, format_ts("s"), "2026-04-21T15:04:23.824123Z") == dt.datetime(2026, 4, 21, 15, 4, 23, 824000)


def test_format_ts_falsy_is_null(spark):
    for v in (None, "", "0"):
        assert _one(spark, format_ts("s"), v) is None


def test_format_ts_day_edges(spark):
    assert _one(spark, format_ts("s"), "2026-01-01T00:00:00.000Z") == dt.datetime(2026, 1, 1)
    assert _one(spark, format_ts("s"), "2026-01-01T23:59:59.999Z") == dt.datetime(2026, 1, 1, 23, 59, 59, 999000)


def test_format_ts_offset_dropped_without_shift(spark):
    assert _one(spark, format_ts("s"), "2026-04-21T15:04:23.824-0300") == dt.datetime(2026, 4, 21, 15, 4, 23, 824000)
    assert _one(spark, format_ts("s"), "2026-04-21T15:04:23-03:00") == dt.datetime(2026, 4, 21, 15, 4, 23)


def test_hash_is_sha256_hex(spark):
    for text in ("", '{"a":1}', '{"a": 1}', '{"b":1,"a":2}'):
        got = _one(spark, payload_hash("s"), text)
        assert got == hashlib.sha256(text.encode()).hexdigest()
        assert len(got) == 64 and got == got.lower()
    assert _one(spark, payload_hash("s"), '{"a":1,"b":2}') != _one(spark, payload_hash("s"), '{"b":2,"a":1}')


def test_empty_nested_values_become_null(spark):
    df = spark.createDataFrame([([],), ([1, 2],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(nonempty("a")).collect()] == [None, [1, 2], None]


def test_truthy(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("1",), ("x",)], "s string")
    assert [r[0] for r in df.select(truthy("s")).collect()] == [True, False, False, True, False]


def test_scalar_text_matches_python_str(spark):
    rows = [('{"value": 42}', "42"), ('{"value": true}', "True"), ('{"value": false}', "False"),
            ('{"value": 17.0}', "17.0"), ('{"value": 1.5}', "1.5"), ('{"value": "txt"}', "txt"),
            ('{"value": null}', None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "json string").select(
        "json", F.expr("try_parse_json(json)").alias("v"))
    got = [r[0] for r in df.select(scalar_text("v", "json")).collect()]
    assert got == [r[1] for r in rows]


def test_polyline_public_vector(spark):
    df = spark.createDataFrame([([(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)],), ([],)],
                               "w array<struct<latitude:double,longitude:double>>")
    got = [r[0] for r in df.select(encoded_polyline("w")).collect()]
    assert got == ["_p~iF~ps|U_ulLnnqC_mqNvxq`@", None]
