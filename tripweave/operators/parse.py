"""Parse once, normalise shapes, classify every landing row.

``parse``      P1 try_parse_json + P9 hash.
``typed``      P4-P6 shape normalisation; one typed struct column per payload
               family (extracted only for rows of that family).
``classify``   P3, P11, P20 row-local failure reasons.
``guard``      J1-J3 parent lookup for child payloads (one left join on
               (user, transport id) against one row per parent key, D19).
``status``     S10 landing_status: PROCESSED / FAILED / PENDING + reason.
``quarantine`` S9 failed rows with reason and raw text.
``source_event`` H0 audit row per processed payload (P9, P16, P17).

Everything is row-local except ``guard``; its join input on the parent side
is reduced to one row per key by a hash aggregate first, so the join never
fans out, and AQE may turn it into a broadcast when the reduced side is
measured small at run time.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import schemas as S
from tripweave.functions import (
    any_overflows,
    format_ts,
    nonblank,
    overflows,
    payload_hash,
    scalar_text,
)

# ---------------------------------------------------------------------------
# P1 / P9
# ---------------------------------------------------------------------------


def parse(landing: DataFrame) -> DataFrame:
    """Landing -> + ``v`` (VARIANT or NULL) + ``payload_hash`` + ``malformed``."""
    return landing.select(
        "*",
        F.expr("try_parse_json(json)").alias("v"),
        payload_hash("json").alias("payload_hash"),
    ).withColumn("malformed", F.col("v").isNull())


def _get(path: str, ddl: str) -> Column:
    return F.try_variant_get(F.col("v"), path, ddl)


# ---------------------------------------------------------------------------
# One typed column per payload family
# ---------------------------------------------------------------------------
_INSIGHT = f"struct<transportEvent:{S.EVENT},safetyScores:{S.SAFETY_SCORES}>"
_CHILD = f"struct<transportId:string,events:array<{S.CHILD_EVENT}>>"


def _context(ddl: str = S.CONTEXT) -> Column:
    manual = F.col("tipo") == S.CONTEXT_MANUAL
    root = _get("$", ddl)
    # listener payloads wrap the context; a wrapper-less listener payload with
    # context fields at the root is read from the root (divergence D38)
    listener = F.coalesce(_get("$.userContext", ddl), root)
    ctx = F.when(manual, root).otherwise(listener)
    criteria = F.when(manual, F.array(F.lit("MANUAL_REQUEST"))).otherwise(
        F.coalesce(_get("$.criteria", "array<string>"), F.array().cast("array<string>")))
    return F.struct(ctx.alias("ctx"), criteria.alias("criteria"),
                    F.when(manual, "MANUAL").otherwise("LISTENER").alias("source_type"))


def _timeline(event: str = S.EVENT) -> Column:
    arr = f"array<{event}>"
    return F.coalesce(_get("$", arr), _get("$.events", arr), F.array().cast(arr))


def _activity() -> Column:
    a = _get("$", S.ACTIVITY_PAYLOAD)
    # code keys first, design-document keys second (divergence D5)
    return F.struct(
        F.coalesce(a["activityType"], a["type"]).alias("activityType"),
        F.coalesce(a["tripType"], a["tripInfo"]["type"]).alias("tripType"),
        a["startTime"].alias("startTime"),
        F.coalesce(a["stationaryLocation"], a["stationaryInfo"]["location"]).alias("stationaryLocation"),
    )


def _metadata() -> Column:
    return F.struct(_get("$.label", "string").alias("label"), scalar_text("v", "json").alias("value"))


FAMILIES: dict[str, tuple[tuple[str, ...], callable]] = {
    "p_insight": ((S.DRIVING_INSIGHTS,), lambda: _get("$", _INSIGHT)),
    "p_child": (S.CHILD_TYPES, lambda: _get("$", _CHILD)),
    "p_context": (S.CONTEXT_TYPES, _context),
    "p_timeline": (S.TIMELINE_TYPES, _timeline),
    "p_crash": ((S.CRASH,), lambda: _get("$", S.CRASH_PAYLOAD)),
    "p_status": ((S.STATUS,), lambda: _get("$", S.STATUS_PAYLOAD)),
    "p_metadata": ((S.METADATA,), _metadata),
    "p_activity": ((S.ACTIVITY,), _activity),
    "p_technical": ((S.TECHNICAL,), lambda: _get("$", S.TECHNICAL_PAYLOAD)),
}

#: The same without waypoints, for plans of many tables that read none.
BARE: dict[str, tuple[tuple[str, ...], callable]] = {
    **FAMILIES,
    "p_insight": ((S.DRIVING_INSIGHTS,), lambda: _get("$", f"struct<transportEvent:{S.EVENT_BARE},safetyScores:{S.SAFETY_SCORES}>")),
    "p_child": (S.CHILD_TYPES, lambda: _get("$", f"struct<transportId:string,events:array<{S.CHILD_EVENT_BARE}>>")),
    "p_context": (S.CONTEXT_TYPES, lambda: _context(S.CONTEXT_BARE)),
    "p_timeline": (S.TIMELINE_TYPES, lambda: _timeline(S.EVENT_BARE)),
}


#: What the status of a row is read from: the parent guard's key and the fields whose kind or narrowing can fail the
#: row.  A member of a struct casts (or not) on its own, so both forms of a family give one reason.
_JUDGED_EVENT = f"struct<distance:double,durationInSeconds:double,location:{S.GEO}>"
_JUDGED_PLACE = f"struct<location:{S.GEO}>"
_JUDGED_CONTEXT = (
    f"struct<lastKnownLocation:{S.GEO},home:{_JUDGED_PLACE},work:{_JUDGED_PLACE},"
    f"activeSegments:array<struct<attributes:array<struct<value:double>>>>,events:array<{_JUDGED_EVENT}>>"
)
_JUDGED_CHILD = (
    "struct<transportId:string,events:array<struct<magnitude:double,confidence:double,minTraveledSpeedMps:double,"
    "minTraveledSpeedInMps:double,maxTraveledSpeedMps:double,maxTraveledSpeedInMps:double>>>"
)
_JUDGED_INSIGHT = (
    "struct<transportEvent:struct<id:string,distance:double,durationInSeconds:double>,"
    f"safetyScores:{S.SAFETY_SCORES}>"
)
_JUDGED_CRASH = f"struct<location:{S.CRASH_GEO},magnitude:double,speedAtImpact:double,deltaV:double,confidence:double>"

JUDGED: dict[str, tuple[tuple[str, ...], callable]] = {
    "p_insight": ((S.DRIVING_INSIGHTS,), lambda: _get("$", _JUDGED_INSIGHT)),
    "p_child": (S.CHILD_TYPES, lambda: _get("$", _JUDGED_CHILD)),
    "p_context": (S.CONTEXT_TYPES, lambda: _context(_JUDGED_CONTEXT)),
    "p_timeline": (S.TIMELINE_TYPES, lambda: _timeline(_JUDGED_EVENT)),
    "p_crash": ((S.CRASH,), lambda: _get("$", _JUDGED_CRASH)),
    "p_activity": ((S.ACTIVITY,), _activity),
}

#: What trips and insight rows are read from, and the fields that the status is: transports without waypoints and venues.
PLAIN: dict[str, tuple[tuple[str, ...], callable]] = {
    "p_insight": ((S.DRIVING_INSIGHTS,), lambda: _get("$", f"struct<transportEvent:{S.EVENT_PLAIN},safetyScores:{S.SAFETY_SCORES}>")),
    "p_context": (S.CONTEXT_TYPES, lambda: _context(_JUDGED_CONTEXT.replace(f"events:array<{_JUDGED_EVENT}>", f"events:array<{S.EVENT_PLAIN}>"))),
    "p_timeline": (S.TIMELINE_TYPES, lambda: _timeline(S.EVENT_PLAIN)),
    "p_activity": ((S.ACTIVITY,), _activity),
}


def _evaluate_once(df: DataFrame, cols: list[Column]) -> DataFrame:
    """Append ``cols`` computed by a one-row generator.

    Catalyst substitutes a projected alias into every filter pushed through
    the projection; for the variant extraction and classification this
    would copy (and re-run) the JSON parse once per reference.  Generator
    output cannot be pushed through, so every expression here runs exactly
    once per row, while filters on the input columns (``tipo``) still reach
    the scan.
    """
    return df.select("*", F.inline(F.array(F.struct(*cols))))


_AUDITED = "startTime:string,id:string"


def _with_audit_fields(df: DataFrame) -> DataFrame:
    """P16/P17 inputs of the audit row, read while the variant is at hand.

    source_time: first non-empty of transportEvent.startTime, [0].startTime,
    startTime; source_ref: transportEvent.id, [0].id, id.  An object is looked
    through once for all its fields, only an array along its first element: a
    path that leads nowhere costs more than one that does.
    """
    none = [F.lit(None).cast("string").alias(c) for c in ("startTime", "id")]
    found = F.coalesce(_get("$", f"struct<transportEvent:struct<{_AUDITED}>,{_AUDITED}>"),
                       F.struct(F.struct(*[_get(f"$[0].{c}", "string").alias(c) for c in ("startTime", "id")]).alias("transportEvent"), *none))

    def first(name: str) -> Column:
        return F.coalesce(nonblank(F.col(f"_audit.transportEvent.{name}")), nonblank(F.col(f"_audit.{name}")))

    # ordinary projections: left out of every plan that does not read them
    return df.select("*", found.alias("_audit")).select(
        *df.columns, format_ts(first("startTime")).alias("src_time"), first("id").alias("src_ref"))


def parent_source(parsed: DataFrame) -> DataFrame:
    """Driving-insights rows with the narrow struct the guard needs."""
    di = parsed.filter(F.col("tipo") == S.DRIVING_INSIGHTS)
    return classify(_evaluate_once(di, [F.when(~F.col("malformed"), _get("$", _JUDGED_INSIGHT)).alias("p_insight")]))


def typed(parsed: DataFrame, families: tuple[str, ...] | None = None, judged: bool = False,
          plain: bool = False, bare: bool = False) -> DataFrame:
    """Add the typed payload column of each requested family.

    A family column is NULL on rows of other types, so extraction work is
    only spent on matching rows.  ``judged``: only the fields that the status
    is read from (``JUDGED``), for plans that read no others; ``plain``: those of ``PLAIN``; ``bare``: those of ``BARE``.
    """
    cols = [
        F.when(F.col("tipo").isin(*types) & ~F.col("malformed"), build()).alias(name)
        for name, (types, build) in (JUDGED if judged else PLAIN if plain else BARE if bare else FAMILIES).items()
        if families is None or name in families
    ]
    # a generator a family: one method of all families is too long for the JVM to compile, which then interprets it row by row
    return _with_audit_fields(reduce(lambda df, c: _evaluate_once(df, [c]), cols, parsed))


# ---------------------------------------------------------------------------
# Row-local reasons
# ---------------------------------------------------------------------------


def _present(path: str) -> Column:
    """The payload has a value at ``path`` that is not JSON null (an explicit null is a missing field, divergence D3)."""
    at = F.try_variant_get(F.col("v"), path, "variant")
    return F.coalesce(at.isNotNull() & ~F.is_variant_null(at), F.lit(False))


def _bad_field(path: str, typed_value: Column) -> Column:
    """A present value that is no object (or array) of the declared kind."""
    # the typed value first: looking at the path copies all that lies below it
    return typed_value.isNull() & _present(path)


def _no_array(path: str) -> Column:
    """No array at ``path``; its elements are not read."""
    return F.try_variant_get(F.col("v"), path, "array<boolean>").isNull()


def _no_object(path: str) -> Column:
    """No object at ``path``; of its members at most one is read."""
    return F.try_variant_get(F.col("v"), path, "struct<semanticTime:string>").isNull()


def _bad_array(path: str, arr: Column) -> Column:
    """A present value that is no array, or an array with an element that is no object."""
    return _bad_field(path, arr) | F.coalesce(F.exists(arr, lambda e: e.isNull()), F.lit(False))


def _wrong_root() -> Column:
    """The payload's root is no object; a timeline may also be an array."""
    return F.when(F.col("tipo").isin(*S.TIMELINE_TYPES), ~F.col("json").rlike(r"^\s*[\[{]")).otherwise(
        ~F.col("json").rlike(r"^\s*\{"))


def _by_family(tests: dict[str, Column]) -> Column:
    """The test of a row's own family: the type of a row is looked up once, and other families' tests are not run."""
    out = F
    for name, test in tests.items():
        out = out.when(F.col("tipo").isin(*FAMILIES[name][0]), test)
    return F.lit(False) if out is F else F.coalesce(out, F.lit(False))


def _wrong_field(df: DataFrame) -> Column:
    """A nested value of the wrong kind, in the rows of its family."""
    cols = set(df.columns)
    tests: dict[str, Column] = {}

    if "p_insight" in cols:
        tests["p_insight"] = reduce(or_, [_bad_field(f"$.{f}", F.col(f"p_insight.{f}")) for f in ("transportEvent", "safetyScores")])
    if "p_child" in cols:
        tests["p_child"] = _bad_array("$.events", F.col("p_child.events"))
    if "p_timeline" in cols:
        in_field = _no_array("$.events") & _present("$.events")
        tests["p_timeline"] = in_field | F.exists(F.col("p_timeline"), lambda e: e.isNull())
    if "p_context" in cols:
        ctx = F.col("p_context.ctx")
        unwrapped = _no_object("$.userContext") & ~_present("$.userContext")
        wrapped = (F.col("tipo") == S.CONTEXT_LISTENER) & ~unwrapped
        bad = [(F.col("tipo") == S.CONTEXT_LISTENER) & _no_object("$.userContext") & _present("$.userContext")]
        for fields, test in ((("activeSegments", "events"), _bad_array), (("lastKnownLocation", "home", "work"), _bad_field)):
            bad += [F.when(wrapped, test(f"$.userContext.{f}", ctx[f])).otherwise(test(f"$.{f}", ctx[f])) for f in fields]
        tests["p_context"] = reduce(or_, bad)
    if "p_crash" in cols:
        tests["p_crash"] = _bad_field("$.location", F.col("p_crash.location"))
    return _by_family(tests)


def _geo_overflow(loc: Column, fields=S.GEO_FIELDS) -> Column:
    out = F.lit(False)
    for f, d in fields:
        out = out | overflows(loc[f], d)
    return out


def _event_overflow(arr: Column) -> Column:
    return F.coalesce(F.exists(arr, lambda e: overflows(e["distance"], S.DEC_METRES) | overflows(
        e["durationInSeconds"], S.DEC_SECONDS) | _geo_overflow(e["location"])), F.lit(False))


def _overflow(df: DataFrame) -> Column:
    """Numeric narrowing failure per family (declared column precisions)."""
    cols = set(df.columns)
    checks: dict[str, Column] = {}
    if "p_insight" in cols:
        te, sc = F.col("p_insight.transportEvent"), F.col("p_insight.safetyScores")
        c = overflows(te["distance"], S.DEC_METRES) | overflows(te["durationInSeconds"], S.DEC_SECONDS)
        for src, _ in S.SCORE_FIELDS:
            c = c | overflows(sc[src], S.DEC_SCORE)
        checks["p_insight"] = c
    if "p_child" in cols:
        checks["p_child"] = any_overflows("p_child.events", {
            "magnitude": S.DEC_MAGNITUDE, "confidence": S.DEC_CONFIDENCE,
            "minTraveledSpeedMps": S.DEC_SPEED, "minTraveledSpeedInMps": S.DEC_SPEED,
            "maxTraveledSpeedMps": S.DEC_SPEED, "maxTraveledSpeedInMps": S.DEC_SPEED})
    if "p_context" in cols:
        ctx = F.col("p_context.ctx")
        attrs_bad = F.coalesce(F.exists(ctx["activeSegments"],
                                        lambda s: any_overflows(s["attributes"], {"value": S.DEC_ATTRIBUTE})),
                               F.lit(False))
        places = [ctx["lastKnownLocation"], ctx["home"]["location"], ctx["work"]["location"]]
        checks["p_context"] = reduce(or_, [_event_overflow(ctx["events"]), attrs_bad, *[_geo_overflow(p) for p in places]])
    if "p_timeline" in cols:
        checks["p_timeline"] = _event_overflow(F.col("p_timeline"))
    if "p_crash" in cols:
        c = F.col("p_crash")
        checks["p_crash"] = (
            overflows(c["magnitude"], S.DEC_MAGNITUDE) | overflows(c["speedAtImpact"], S.DEC_SPEED)
            | overflows(c["deltaV"], S.DEC_SPEED) | overflows(c["confidence"], S.DEC_CONFIDENCE)
            | _geo_overflow(c["location"], S.CRASH_GEO_FIELDS))
    if "p_activity" in cols:
        checks["p_activity"] = _geo_overflow(F.col("p_activity.stationaryLocation"), S.GEO_FIELDS[:2])
    return _by_family(checks)


def classify(typed_df: DataFrame) -> DataFrame:
    """+ ``routed`` and ``reason`` (NULL when the row may be processed).

    Precedence follows the reference's control flow: unparseable text, a root
    of the wrong kind, a child without transport id, then nested values of the
    wrong kind, then narrowing failures.
    """
    routed = F.col("tipo").isin(*S.ROUTED_TYPES)
    child = F.col("tipo").isin(*S.CHILD_TYPES)
    tid = nonblank(F.col("p_child.transportId")) if "p_child" in typed_df.columns else F.lit(None)
    reason = (
        F.when(~routed, F.lit(None))
        .when(F.col("malformed"), "malformed_json")
        .when(_wrong_root(), "wrong_shape")
        .when(child & tid.isNull(), "missing_transport_id")
        .when(_wrong_field(typed_df), "wrong_field")
        .when(_overflow(typed_df), "numeric_overflow")
    )
    return _evaluate_once(typed_df, [routed.alias("routed"), reason.cast("string").alias("reason")])


# ---------------------------------------------------------------------------
# Parent guard
# ---------------------------------------------------------------------------


def parent_keys(classified: DataFrame) -> DataFrame:
    """One row per (user_id, canonical_id): lowest accepted insight id."""
    return (
        classified.filter((F.col("tipo") == S.DRIVING_INSIGHTS) & F.col("reason").isNull())
        .select("user_id", nonblank(F.col("p_insight.transportEvent.id")).alias("canonical_id"), "id")
        .filter(F.col("canonical_id").isNotNull())
        .groupBy("user_id", "canonical_id")
        .agg(F.min("id").alias("insight_trip_id"))
    )


def guard(classified: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Child rows + ``insight_trip_id`` of their parent (NULL = orphan).

    ``keys`` are the parents (``parent_keys``); by default those in ``classified``.
    """
    children = classified.filter(F.col("tipo").isin(*S.CHILD_TYPES)).withColumn(
        "canonical_id", nonblank(F.col("p_child.transportId")))
    keys = parent_keys(classified) if keys is None else keys
    return children.join(keys, ["user_id", "canonical_id"], "left")


def status_column(df: DataFrame) -> Column:
    is_child = F.col("tipo").isin(*S.CHILD_TYPES)
    orphan = is_child & F.col("insight_trip_id").isNull() if "insight_trip_id" in df.columns else F.lit(False)
    return (
        F.when(~F.col("routed"), S.PENDING)
        .when(F.col("reason").isin(*S.EARLY_REASONS), S.FAILED)
        .when(orphan, S.PENDING)
        .when(F.col("reason").isNotNull(), S.FAILED)
        .otherwise(S.PROCESSED)
    )


def resolve(classified: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Every landing row with its final ``status`` and ``insight_trip_id`` (``keys``: see ``guard``).

    Non-child rows never enter the guard join.
    """
    others = _unguarded(classified)
    return _decided(others.unionByName(guard(classified, keys).select(*others.columns)))


def resolve_children(classified: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``resolve`` that wait for a parent."""
    return _decided(guard(classified, keys).select(*_unguarded(classified).columns))


def resolve_alone(classified: DataFrame) -> DataFrame:
    """The rows of ``resolve`` that wait for no parent: no guard join in their plans."""
    return _decided(_unguarded(classified))


def _unguarded(classified: DataFrame) -> DataFrame:
    return classified.filter(~F.col("tipo").isin(*S.CHILD_TYPES) | F.col("tipo").isNull()).select(
        "*", F.lit(None).cast("string").alias("canonical_id"), F.lit(None).cast("bigint").alias("insight_trip_id"))


def _decided(both: DataFrame) -> DataFrame:
    status = status_column(both)
    detail = (
        F.when(~F.col("routed"), F.lit("unrouted_type"))
        .when(F.col("reason").isin(*S.EARLY_REASONS), F.col("reason"))
        .when(F.col("tipo").isin(*S.CHILD_TYPES) & F.col("insight_trip_id").isNull(), F.lit("awaiting_parent"))
        .otherwise(F.col("reason"))
    )
    return both.withColumn("status", status).withColumn("status_reason", detail)


def landing_status(resolved: DataFrame) -> DataFrame:
    """One row per landing row."""
    return resolved.select("id", "user_id", "tipo", "status", F.col("status_reason").alias("reason"))


def quarantine(resolved: DataFrame) -> DataFrame:
    """Failed rows with their raw text and reason code."""
    return resolved.filter(F.col("status") == S.FAILED).select(
        F.col("id").alias("original_id"), "user_id", "tipo", F.col("json").alias("raw_json"),
        F.col("status_reason").alias("reason"), "created_at")


def accepted(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("status") == S.PROCESSED)


def accepted_alone(classified: DataFrame) -> DataFrame:
    """The accepted rows of all types that wait for no parent: no guard join in their plans."""
    return classified.filter(F.col("routed") & F.col("reason").isNull() & ~F.col("tipo").isin(*S.CHILD_TYPES))


# ---------------------------------------------------------------------------
# Audit row
# ---------------------------------------------------------------------------


def source_event(acc: DataFrame) -> DataFrame:
    """One audit row per processed payload.

    source_time falls back to the landing created_at (divergence D18);
    source_event_ref falls back to the landing id.
    """
    return acc.select(
        F.col("id").alias("source_event_id"),
        F.col("id").alias("landing_id"),
        F.col("tipo").alias("record_type"),
        "user_id",
        F.coalesce(F.col("src_time"), F.col("created_at")).alias("source_time"),
        F.coalesce(F.col("src_ref"), F.col("id").cast("string")).alias("source_event_ref"),
        *["payload_hash"] * ("payload_hash" in acc.columns),
        "created_at",
    )
