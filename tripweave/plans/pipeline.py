"""The batch pipeline as a set of lazily built DataFrames.

``Pipeline(landing)`` builds nothing until a table is asked for, and each
table's plan contains only the branches that table needs.  ``families`` limits
which payload families are extracted at all.  The trip table stores its
candidates first.

``write_all`` materialises the model as one version: the parsed/typed landing
is written once (partitioned by type, so every handler scans only its own
partition) and every output table is then built from that stored copy; this
also cuts lineage, so a lost executor re-runs only the stage it was in.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators import handlers as H
from tripweave.operators import parse as P
from tripweave.operators import trips as T
from tripweave import schemas as S
from tripweave.session import remove, stored, tune
from tripweave.sources import published


#: Types whose tables keep the raw text of the payload.
TEXT_KEPT = (S.CRASH, S.ACTIVITY, S.TECHNICAL)


def _stage(resolved: DataFrame) -> DataFrame:
    """The resolved stage as it is stored for the tables: typed columns, and the raw text only where a table keeps it."""
    kept = F.col("tipo").isin(*TEXT_KEPT) | (F.col("status") == S.FAILED)
    return resolved.drop("v").withColumn("json", F.when(kept, F.col("json")))  # VARIANT stays transient


def without_texts(classified: DataFrame) -> DataFrame:
    """Classified rows whose raw text goes on only where a table or the quarantine may keep it: waiting or guarded children move without theirs."""
    kept = F.col("tipo").isin(*TEXT_KEPT) | F.col("reason").isNotNull()
    return classified.withColumn("json", F.when(kept, F.col("json")))


class Pipeline:
    def __init__(self, landing: DataFrame, families: tuple[str, ...] | None = None, parents: DataFrame | None = None):
        self.landing = landing
        self.families = families
        self.parents = landing if parents is None else parents

    def chosen(self, ids: DataFrame) -> "Pipeline":
        """The rows with these ids alone: no other payload is parsed, but as a child's parent."""
        return Pipeline(self.landing.join(ids.select("id"), "id", "left_semi"), self.families, self.parents)

    # -- stage 1: parse, type, classify, guard ------------------------------
    @cached_property
    def classified(self) -> DataFrame:
        return P.classify(P.typed(P.parse(self.landing), self.families))

    @cached_property
    def resolved(self) -> DataFrame:
        return self._guarded(self.classified)

    @cached_property
    def staged(self) -> DataFrame:
        """``resolved`` as it is stored for the tables; the texts are gone before the guard moves the children."""
        return _stage(self._guarded(without_texts(self.classified)))

    def _bare(self) -> list[DataFrame]:
        """``staged`` without waypoints and payload hashes: the rows that wait for no parent, then the children type by type."""
        classified = without_texts(P.classify(P.typed(P.parse(self.landing), self.families, bare=True)).drop("payload_hash", "v"))
        keys = stored(P.parent_keys(P.parent_source(P.parse(self.parents))), "parents", compression="zstd")
        children = [P.resolve_children(classified.filter(F.col("tipo") == t), keys) for t in S.CHILD_TYPES]
        return [_stage(rows) for rows in (P.resolve_alone(classified), *children)]

    def _guarded(self, classified: DataFrame) -> DataFrame:
        # the guard's parent side re-reads only the narrow insight fields
        return P.resolve(classified, P.parent_keys(P.parent_source(P.parse(self.parents))))

    @cached_property
    def judged(self) -> DataFrame:
        """The rows of ``resolved`` with the fields that the status is read from alone (and the audit fields)."""
        return self._guarded(P.classify(P.typed(P.parse(self.landing), self.families, judged=True)))

    @cached_property
    def accepted(self) -> DataFrame:
        return P.accepted(self.resolved)

    @cached_property
    def accepted_alone(self) -> DataFrame:
        return P.accepted_alone(self.classified)

    def materialized(self, columns: tuple[str, ...] | None = None, texts: bool = True, bare: bool = False) -> "Pipeline":
        """A pipeline over a stored copy of the resolved stage.

        For plans that read many output tables (reconciliation, FK checks,
        lineage) the parse/classify/guard stage would otherwise be recomputed
        once per table.  The copy is Parquet in the cluster's shared folder,
        partitioned by type, so each table reads its own folders and columns.
        The VARIANT column is dropped: every consumer reads the typed columns.
        Without ``texts`` raw texts are stored only where a table keeps them, else of every
        row.  ``columns`` names the ones that the plan reads; the others are
        neither extracted nor stored.  ``bare``: neither are waypoints and
        payload hashes, nor more texts than without ``texts``; for plans whose tables are read for other columns.
        """
        if bare:
            first, *children = self._bare()
            return _StoredPipeline(stored(first, "resolved", ["tipo"], "zstd", *children), self.landing)
        source = self.judged if columns is not None and not any(c.startswith("p_") for c in columns) else self.resolved
        resolved = source.drop("v") if texts else self.staged
        if columns is not None:
            resolved = resolved.select(*[c for c in resolved.columns if c in columns])
        return _StoredPipeline(stored(resolved, "resolved", ["tipo"], "zstd"), self.landing)

    # -- audit / status -----------------------------------------------------
    @property
    def landing_status(self) -> DataFrame:
        return P.landing_status(self.judged)

    @property
    def quarantine(self) -> DataFrame:
        return P.quarantine(self.judged)

    @property
    def source_event(self) -> DataFrame:
        return P.source_event(P.accepted(self.judged))

    # -- handlers ----------------------------------------------------------
    @property
    def insight_trip(self) -> DataFrame:
        return H.insight_trip(self.accepted_alone)

    def child(self, child_type: str) -> DataFrame:
        return H.child_events(self.accepted, child_type)

    @property
    def context_header(self) -> DataFrame:
        return H.context_header(self.accepted_alone)

    @property
    def context_criteria(self) -> DataFrame:
        return H.context_criteria(self.accepted_alone)

    @property
    def context_home(self) -> DataFrame:
        return H.context_place(self.accepted_alone, "home")

    @property
    def context_work(self) -> DataFrame:
        return H.context_place(self.accepted_alone, "work")

    @property
    def context_segment(self) -> DataFrame:
        return H.context_segment(self.accepted_alone)

    @property
    def context_segment_attribute(self) -> DataFrame:
        return H.context_segment_attribute(self.accepted_alone)

    @property
    def context_event(self) -> DataFrame:
        return H.context_event(self.accepted_alone)

    @property
    def timeline_event(self) -> DataFrame:
        return H.timeline_event(self.accepted_alone)

    @property
    def user_metadata(self) -> DataFrame:
        return H.user_metadata(self.accepted_alone)

    @property
    def crash_event(self) -> DataFrame:
        return H.crash_event(self.accepted_alone)

    @property
    def sdk_status(self) -> DataFrame:
        return H.sdk_status(self.accepted_alone)

    @property
    def user_activity(self) -> DataFrame:
        return H.user_activity(self.accepted_alone)

    @property
    def technical_event(self) -> DataFrame:
        return H.technical_event(self.accepted_alone)

    # -- trips -------------------------------------------------------------
    @property
    def trip_candidates(self) -> DataFrame:
        return T.trip_candidates(self.accepted_alone)

    def trips(self, policy: str = "reference", columns: tuple[str, ...] | None = None) -> DataFrame:
        """The consolidated trips; ``columns`` names the ones of a writer that the plan reads, the others are not stored."""
        cands = self.trip_candidates.select(*T.columns_of(self.trip_candidates, columns))
        # stored: the fold reads the narrow keys first and the winners' columns after
        return T.fold_trips(stored(cands, "trip_candidates", compression="zstd"), policy)

    def reporting(self) -> "Pipeline":
        """A pipeline over a stored copy of the accepted payloads that report transports, without waypoints and venues.

        For plans that read trips and insight rows: payloads are parsed once for both.
        """
        rows = P.accepted_alone(P.classify(P.typed(P.parse(self.landing.filter(F.col("tipo").isin(*T.TRIP_TYPES))), plain=True)))
        events = F.struct(F.struct(F.col("p_context.ctx.events").alias("events")).alias("ctx")).alias("p_context")
        rows = rows.select("id", "user_id", "tipo", "created_at", "p_insight", events, "p_timeline", "p_activity", F.lit(S.PROCESSED).alias("status"))
        return _StoredPipeline(stored(rows, "reporting", ["tipo"], "zstd"), self.landing)

    def tables(self, trips: bool = True, tipos: set[str] | None = None) -> dict[str, DataFrame]:
        """Output tables of the model, by engine name.

        ``trips`` stores the trip candidates; with ``tipos`` only the tables that
        payloads of these types feed are built.
        """
        builders = {
            "landing_status": (None, lambda: self.landing_status),
            "quarantine": (None, lambda: self.quarantine),
            "source_event": (None, lambda: self.source_event),
            "insight_trip": ((S.DRIVING_INSIGHTS,), lambda: self.insight_trip),
            "context_header": (S.CONTEXT_TYPES, lambda: self.context_header),
            "context_criteria": (S.CONTEXT_TYPES, lambda: self.context_criteria),
            "context_home": (S.CONTEXT_TYPES, lambda: self.context_home),
            "context_work": (S.CONTEXT_TYPES, lambda: self.context_work),
            "context_segment": (S.CONTEXT_TYPES, lambda: self.context_segment),
            "context_segment_attribute": (S.CONTEXT_TYPES, lambda: self.context_segment_attribute),
            "context_event": (S.CONTEXT_TYPES, lambda: self.context_event),
            "timeline_event": (S.TIMELINE_TYPES, lambda: self.timeline_event),
            "user_metadata": ((S.METADATA,), lambda: self.user_metadata),
            "crash_event": ((S.CRASH,), lambda: self.crash_event),
            "sdk_status": ((S.STATUS,), lambda: self.sdk_status),
            "user_activity": ((S.ACTIVITY,), lambda: self.user_activity),
            "technical_event": ((S.TECHNICAL,), lambda: self.technical_event),
            **{f"insight_{kind}": ((t,), lambda t=t: self.child(t)) for t, kind in S.CHILD_KIND.items()},
        }
        if trips:
            builders["trip"] = None, self.trips
        return {name: build() for name, (types, build) in builders.items()
                if tipos is None or types is None or tipos.intersection(types)}


def write_all(landing: DataFrame, out_dir: str) -> int:
    """Materialise the whole model under ``out_dir`` (Parquet, zstd) as one new version, which replaces the one before.

    The resolved landing is written first, partitioned by ``tipo``; all tables
    are then derived from that stored copy, each into a folder of its own.  The
    manifest is published last: until then readers (``read_all``) see the
    version before, whole.  Returns the version.
    """
    spark = landing.sparkSession
    before = published.newest(spark, out_dir)
    version = before[0].v + 1 if before else 0
    tune(spark)
    resolved = Pipeline(landing).staged
    # the typed columns are plain structs, so the stage is ordinary Parquet
    stage = f"{out_dir}/resolved/v={version}"
    resolved.write.mode("overwrite").option("compression", "zstd").partitionBy("tipo").parquet(stage)
    pipe = _StoredPipeline(spark.read.schema(resolved.schema).parquet(stage))
    tables = pipe.tables()
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_dir}/{name}/v={version}")
    published.publish(spark, out_dir, version, [(name, -1, [f"v={version}"]) for name in tables])
    for name in ("resolved", *tables):  # readers of the version before may still be at work; those before it are gone
        remove(spark, f"{out_dir}/{name}/v={version - 2}")
    return version


def read_all(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the newest version under ``out_dir``; none where nothing was published."""
    rows = published.newest(spark, out_dir)
    return {e.name: spark.read.parquet(*[f"{out_dir}/{e.name}/{run}" for run in e.runs]) for e in rows[0].entries} if rows else {}


def stored_pipeline(resolved: DataFrame) -> Pipeline:
    """A pipeline over a resolved stage that is already stored."""
    return _StoredPipeline(resolved)


class _StoredPipeline(Pipeline):
    """A pipeline whose stage-1 result was read back from storage."""

    def __init__(self, resolved: DataFrame, landing: DataFrame | None = None):
        super().__init__(landing if landing is not None else resolved)
        self.__dict__["resolved"] = self.__dict__["judged"] = resolved

    @cached_property
    def accepted_alone(self) -> DataFrame:
        return self.accepted

    def trips(self, policy: str = "reference", columns: tuple[str, ...] | None = None) -> DataFrame:
        if columns is not None:  # few columns: read thrice they cost less than events unnested thrice
            return super().trips(policy, columns)
        # the candidates lie in the stored stage already: no second copy of them
        return T.fold_trips(self.trip_candidates, policy)
