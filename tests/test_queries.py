"""Driver contract, invariants and a few registered queries on sf0.001."""

from __future__ import annotations

import pyspark.sql.functions as F

import __spark_entry__ as E
from tripweave.plans import catalog
from tripweave.plans.pipeline import Pipeline
from tripweave.sources.fixtures import derive_landing

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"harsh_type", "n_events"}


def test_every_query_has_a_function_and_most_an_oracle():
    q, o = catalog.queries(), catalog.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(q) >= 60 and len(o) >= len(q) - 2


def test_row_conservation(spark):
    land = derive_landing(spark, SF)
    st = Pipeline(land).landing_status
    assert st.count() == land.count() == land.select("id").distinct().count()
    by = {r["status"]: r["count"] for r in st.groupBy("status").count().collect()}
    assert set(by) == {"PROCESSED", "FAILED", "PENDING"}


def test_reconciliation_all_pass(spark):
    s = E.queries()["reconcile_summary"](spark, SF)
    assert {r["status"] for r in s.collect()} == {"PASS"}


def test_label_lookup(spark):
    from tripweave.operators.views import label_dim, with_label
    df = spark.createDataFrame([("CAR",), ("SHOP",), (None,), ("",)], "m string")
    got = [r["m_label"] for r in with_label(df, "m", label_dim(spark)).orderBy(F.col("m").asc_nulls_first()).collect()]
    assert got == ["Desconocido", "", "Coche", "SHOP"]
