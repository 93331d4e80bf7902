"""Dedup and unified views.

All of them are keyed window or aggregate operations whose partitioning key
includes a high-cardinality column (payload hash, event id, segment id), so
a hot user is spread over many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave import schemas as S


def payload_dedup(rows: DataFrame, key: str = "id", hash_col: str = "payload_hash") -> DataFrame:
    """Keep the first row (lowest ``key``) per (user, type, payload hash).

    Snapshot types are passed through unchanged (divergence D11).  Written as
    an aggregate of the minimum key and a semi join rather than a window, so
    partial aggregation collapses repeated retries before the shuffle.
    """
    snap = F.col("tipo").isin(*S.SNAPSHOT_TYPES)
    firsts = rows.filter(~snap).groupBy("user_id", "tipo", hash_col).agg(F.min(key).alias(key))
    kept = rows.filter(~snap).join(firsts, ["user_id", "tipo", hash_col, key], "left_semi")
    return kept.unionByName(rows.filter(snap))


def store_seen(seen: DataFrame, name: str, path: str, buckets: int = 16, hash_col: str = "payload_hash") -> None:
    """The audited hashes as a table that is bucketed by hash: a look-up never moves it again."""
    (seen.select(hash_col).distinct().repartition(buckets, hash_col).write.mode("overwrite").option("compression", "zstd").option("path", path)
     .bucketBy(buckets, hash_col).sortBy(hash_col).saveAsTable(name))


def already_seen(new: DataFrame, seen: DataFrame, hash_col: str = "payload_hash") -> DataFrame:
    """New rows whose payload hash was never audited before (anti join).

    With a table of ``store_seen`` only the new rows are shuffled, to its
    buckets; rows without a payload have no hash and are kept.
    """
    return new.join(seen.select(hash_col).hint("merge"), hash_col, "left_anti")


def latest_by_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Latest row per key by ``order_col`` plus the number of versions.

    ``max_by`` over a struct keeps the whole winning row; the aggregate has a
    partial (map-side) phase, so a hot key is reduced before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.col(order_col)).alias("_w"), F.count(F.lit(1)).alias("n_versions"))
    return agg.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in others], "n_versions")


def latest_metadata(meta: DataFrame) -> DataFrame:
    """Latest value per (user, label); history stays queryable as is."""
    return meta.groupBy("user_id", "label").agg(
        F.max_by("value", "metadata_id").alias("value"), F.max("metadata_id").alias("metadata_id"))


def latest_place(places: DataFrame) -> DataFrame:
    """Last known home / work per user (by context id)."""
    return latest_by_key(places, ["user_id", "significance"], "context_id")


def unified_events(timeline: DataFrame, context: DataFrame) -> DataFrame:
    """Timeline events plus context events not already in the timeline.

    Null-safe (divergence D32): an event without user or id is in nobody's
    timeline; set semantics as in the documented UNION.  One pass over both
    sides and one shuffle by (user, event id): the distinct rows of a key meet
    there, and a window tells whether the timeline has it.
    """
    cols = ["user_id", "event_id", "event_type", "start_time"]
    both = timeline.select(*cols, F.lit("timeline").alias("fuente")).unionByName(context.select(*cols, F.lit("context").alias("fuente")))
    named = F.col("user_id").isNotNull() & F.col("event_id").isNotNull()
    keyed = both.filter(named).repartition("user_id", "event_id").distinct()
    known = F.max(F.col("fuente") == "timeline").over(Window.partitionBy("user_id", "event_id"))
    kept = keyed.withColumn("_known", known).filter((F.col("fuente") == "timeline") | ~F.col("_known")).drop("_known")
    return kept.unionByName(both.filter(~named).distinct())
