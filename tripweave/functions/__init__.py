from tripweave.functions.geo import encoded_polyline, kmh, max_speed_mps
from tripweave.functions.scalars import (
    any_overflows,
    epoch_ms,
    format_ts,
    iso_ms,
    narrow,
    nonblank,
    nonempty,
    overflows,
    payload_hash,
    scalar_text,
    semver_ok,
    truthy,
)

__all__ = [
    "any_overflows", "encoded_polyline", "epoch_ms", "format_ts", "iso_ms", "kmh",
    "max_speed_mps", "narrow", "nonblank", "nonempty", "overflows", "payload_hash",
    "scalar_text", "semver_ok", "truthy",
]
