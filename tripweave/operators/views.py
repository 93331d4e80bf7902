"""Browse, lineage and label views.

Top-n views use ``orderBy(...).limit(n)``, which Spark plans as
TakeOrderedAndProject (a per-partition top-n plus a final merge of n rows per
partition), so no full sort of the input is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions.labels import LABELS, UNKNOWN_LABEL


def record(landing: DataFrame, tipo: str, record_id: int) -> DataFrame:
    """Single-record lookup by (type, id); pushed down to the scan."""
    return landing.filter((F.col("tipo") == tipo) & (F.col("id") == record_id))


def browse(rows: DataFrame, tipo: str | None = None, min_id: int | None = None, max_id: int | None = None,
           n: int = 50) -> DataFrame:
    """Optional type / id-range predicates, newest ``n`` by id."""
    if tipo is not None:
        rows = rows.filter(F.col("tipo") == tipo)
    if min_id is not None:
        rows = rows.filter(F.col("id") >= min_id)
    if max_id is not None:
        rows = rows.filter(F.col("id") <= max_id)
    return rows.orderBy(F.desc("id")).limit(n)


def id_range(rows: DataFrame) -> DataFrame:
    """A2: min / max processed id."""
    return rows.agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"))


def queue_depth(status: DataFrame) -> DataFrame:
    """A1: remaining pending rows per type (unrouted included)."""
    return status.filter(F.col("status") == S.PENDING).groupBy("tipo").agg(F.count("*").alias("pending"))


def newest_insights(landing: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest insight payloads by their times alone: no text is read."""
    return (landing.filter(F.col("tipo") == S.DRIVING_INSIGHTS).select("id", "user_id", "created_at")
            .orderBy(F.desc("created_at"), F.desc("id")).limit(n))


def recent_insights(landing: DataFrame, source_event: DataFrame, insight: DataFrame, n: int = 20) -> DataFrame:
    """J5 + O2: landing -> source event -> insight trip (two left joins), newest first."""
    se = source_event.select(F.col("landing_id").alias("id"), "source_event_id", "source_time")
    it = insight.select("source_event_id", "insight_trip_id", "canonical_id", "is_provisional")
    return (
        newest_insights(landing, n).join(se, "id", "left").join(it, "source_event_id", "left")
        .orderBy(F.desc("created_at"), F.desc("id")).limit(n)
    )


def lineage_tree(insight: DataFrame, trips: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """One nested row per insight payload: its trip and its five child sets.

    Each child set is aggregated per parent first (``collect_list`` of a small
    struct, sorted), so every join is 1:1 on ``insight_trip_id``.
    """
    out = insight.select("insight_trip_id", "user_id", "canonical_id", "trip_id", "is_provisional")
    out = out.join(trips.select("trip_id", F.col("first_seen_from").alias("trip_first_seen_from"),
                                F.col("n_writers").alias("trip_writers")), "trip_id", "left")
    for kind, df in children.items():
        agg = df.groupBy("insight_trip_id").agg(
            F.sort_array(F.collect_list(F.struct("start_time", "child_event_id"))).alias(kind))
        out = out.join(agg, "insight_trip_id", "left").withColumn(
            kind, F.coalesce(F.col(kind), F.array().cast(agg.schema[kind].dataType)))
    return out


def label_dim(spark: SparkSession) -> DataFrame:
    """The fixed label dictionary as a 152-row dimension (broadcast-sized by construction)."""
    return spark.createDataFrame(list(LABELS), "code string, label string")


def with_label(df: DataFrame, col: str, dim: DataFrame, out: str | None = None) -> DataFrame:
    """``t(value)``: dictionary label, else the value itself, else 'Desconocido'.

    The dimension has a fixed size, so it is broadcast explicitly.
    """
    out = out or f"{col}_label"
    d = F.broadcast(dim.select(F.col("code").alias(f"_{col}_code"), F.col("label").alias(f"_{col}_label")))
    j = df.join(d, F.col(col) == F.col(f"_{col}_code"), "left")
    return j.withColumn(out, F.coalesce(F.col(f"_{col}_label"), F.col(col), F.lit(UNKNOWN_LABEL))) \
        .drop(f"_{col}_code", f"_{col}_label")


def table_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """A3: actual rows per (source landing id, table): one union of keys, one aggregate."""
    parts = [df.select(F.col(key).alias("landing_id"), F.lit(name).alias("table_name")) for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("landing_id", "table_name").agg(F.count("*").alias("n_rows"))


FLAT_TABLES = {S.CRASH: "crash_event", S.STATUS: "sdk_status", S.ACTIVITY: "user_activity",
               S.TECHNICAL: "technical_event", S.METADATA: "user_metadata"}


def expected_tables() -> Column:
    """A5: (table_name, expected) of every table that a payload of an accepted row's type feeds, from its array sizes."""
    def sz(c: str) -> Column:
        return F.coalesce(F.size(F.col(c)), F.lit(0))

    def listing(**expected) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("table_name"), F.lit(e).cast("bigint").alias("expected"))
                         for n, e in expected.items()])

    ctx, t = "p_context.ctx", F.col("tipo")
    seg_attrs = F.coalesce(F.aggregate(F.col(f"{ctx}.activeSegments"), F.lit(0),
                                       lambda n, s: n + F.coalesce(F.size(s["attributes"]), F.lit(0))), F.lit(0))
    out = F.when(t == S.DRIVING_INSIGHTS, listing(insight_trip=1))
    for child_type, kind in S.CHILD_KIND.items():
        out = out.when(t == child_type, listing(**{f"insight_{kind}": sz("p_child.events")}))
    out = out.when(t.isin(*S.TIMELINE_TYPES), listing(timeline_event=sz("p_timeline")))
    out = out.when(t.isin(*S.CONTEXT_TYPES), listing(
        context_header=1, context_criteria=sz("p_context.criteria"),
        context_home=F.col(f"{ctx}.home").isNotNull().cast("int"),
        context_work=F.col(f"{ctx}.work").isNotNull().cast("int"), context_segment=sz(f"{ctx}.activeSegments"),
        context_segment_attribute=seg_attrs, context_event=sz(f"{ctx}.events")))
    for flat_type, name in FLAT_TABLES.items():
        out = out.when(t == flat_type, listing(**{name: 1}))
    return out


def expected_counts() -> Column:
    """A5: detail rows a payload should produce in all tables together."""
    return F.aggregate(expected_tables(), F.lit(0), lambda n, x: n + x["expected"].cast("int"))


def processed(rows: DataFrame, top: int | None = None) -> DataFrame:
    """O3: processed rows by ascending id, all or the first ``top``."""
    out = rows.filter(F.col("status") == S.PROCESSED).orderBy("id")
    return out if top is None else out.limit(top)
