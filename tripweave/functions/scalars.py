"""Scalar column rules shared by every handler.

All of them are built-in Catalyst expressions (no Python UDF), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch origin as a wall-clock value; keeps epoch math independent of the
# session time zone.
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_ts(ts) -> Column:
    """ISO-8601 text -> wall-clock TIMESTAMP_NTZ at millisecond precision.

    Rule of the reference: drop 'Z', 'T' -> ' ', keep the first 23
    characters; empty/NULL -> NULL.  A trailing numeric offset is stripped
    first so that offset-bearing values without milliseconds still parse
    (divergence D17); the wall clock is kept, the offset is not applied.
    """
    s = _c(ts).cast("string")
    s = F.regexp_replace(s, r"([+-]\d\d:?\d\d)$", "")
    s = F.substring(F.replace(F.replace(s, F.lit("Z"), F.lit("")), F.lit("T"), F.lit(" ")), 1, 23)
    return F.when(F.length(s) > 0, s.try_cast("timestamp_ntz"))


def epoch_ms(ts_ntz) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ wall clock."""
    col = _c(ts_ntz)
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), col)


def iso_ms(ts_ntz) -> Column:
    """TIMESTAMP_NTZ -> ISO text with milliseconds and a 'Z' marker."""
    return F.date_format(_c(ts_ntz), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def payload_hash(text) -> Column:
    """SHA-256 lower-hex digest of the raw payload text."""
    return F.sha2(_c(text), 256)


def truthy(flag) -> Column:
    """Boolean flag; missing or not castable -> false."""
    return F.coalesce(_c(flag).try_cast("boolean"), F.lit(False))


def nonempty(arr) -> Column:
    """Empty array or map -> NULL (the reference stores falsy blobs as NULL)."""
    a = _c(arr)
    return F.when(F.size(a) > 0, a)


def nonblank(s) -> Column:
    """'' -> NULL, so that `x or y` chains become coalesce()."""
    c = _c(s)
    return F.when(F.length(c) > 0, c)


def narrow(x, decimal_type: str) -> Column:
    """Numeric narrowing to the declared precision; overflow -> NULL."""
    return _c(x).try_cast(decimal_type)


def overflows(x, decimal_type: str) -> Column:
    """True when a present value does not fit the declared precision.

    A value below the largest whole number of that precision fits however it is
    rounded: only the others are cast.
    """
    c = _c(x)
    precision, scale = map(int, re.fullmatch(r"decimal\((\d+),(\d+)\)", decimal_type).groups())
    return c.isNotNull() & ~(F.abs(c) < F.lit(float(10 ** (precision - scale) - 1))) & c.try_cast(decimal_type).isNull()


def any_overflows(arr, fields: dict[str, str]) -> Column:
    """True when a field of any element overflows its decimal type; the elements are passed over once."""
    return F.coalesce(
        F.exists(_c(arr), lambda e: reduce(or_, [overflows(e[f], d) for f, d in fields.items()])), F.lit(False)
    )


def scalar_text(v: str, text: str, path: str = "$.value") -> Column:
    """Python ``str()`` of a JSON scalar: 42 -> '42', 17.0 -> '17.0',
    true -> 'True'; JSON null -> NULL (divergence D27).

    The kind comes from the parsed variant ``v``; numbers and strings are read
    from the raw ``text`` because the variant normalises 17.0 to 17.
    """
    kind = F.expr(f"schema_of_variant(variant_get({v}, '{path}'))")
    return (
        F.when(kind == "BOOLEAN", F.initcap(F.try_variant_get(F.col(v), path, "string")))
        .when(kind == "VOID", F.lit(None).cast("string"))
        .otherwise(F.get_json_object(F.col(text), path))
    )


def semver_ok(version) -> Column:
    """app_version whitelist ``^\\d+\\.\\d+\\.\\d+$`` (rule P25)."""
    return F.coalesce(_c(version).rlike(r"^\d+\.\d+\.\d+$"), F.lit(False))
