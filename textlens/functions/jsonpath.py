"""Column helpers over semi-structured (VARIANT) documents: C12-C21.

Python's ``a or b`` treats None, '', 0, False, {} and [] as "missing"; the
helpers below reproduce that on VARIANT values, keeping everything a
built-in expression (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ssxxx"
ISO_FMT_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# X timestamps: 'Sat Jul 25 18:26:52 +0000 2026'; Spark cannot parse the day
# name, so it is checked by pattern and the rest parsed.
X_TIME_FMT = "MMM dd HH:mm:ss Z yyyy"
X_DAY_RE = r"^(?i)(mon|tue|wed|thu|fri|sat|sun) "


def node(v: Column, path: str) -> Column:
    """Sub-document at a JSON path (``$.a.b``) as VARIANT, null if absent."""
    return F.try_variant_get(v, path, "variant")


def as_str(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "string")


def json_text(v: Column, path: str = "$") -> Column:
    """Canonical JSON text of a value; JSON null -> 'null', absent -> NULL."""
    return F.to_json(node(v, path))


_ZERO_LIKE = r"^(-?0+(\.0*)?([eE][+-]?[0-9]+)?|false|\{\}|\[\])$"


def truthy(v: Column, path: str = "$") -> Column:
    """Python truthiness of the value at ``path`` (absent counts as falsy).

    The value is read as text (a JSON null or absent key gives NULL); only
    zero-like texts ('0', 'false', '{}', ...) need the JSON form, to tell the
    number 0 from the string "0" -- so sub-documents are not serialised on
    every check.
    """
    s = as_str(v, path)
    zero_like = s.rlike(_ZERO_LIKE)
    quoted = F.startswith(F.to_json(node(v, path)), F.lit('"'))
    return (F.when(s.isNull() | (s == ""), F.lit(False))
             .when(zero_like, quoted)
             .otherwise(F.lit(True)))


def present(v: Column, path: str) -> Column:
    """Key present with a non-null value."""
    n = node(v, path)
    return n.isNotNull() & ~F.is_variant_null(n)


def first_truthy(v: Column, *paths: str, default: Column | None = None,
                 as_type: str = "string") -> Column:
    """``a or b or default`` over paths of one document."""
    branches = None
    for p in paths:
        val = F.try_variant_get(v, p, as_type)
        branches = F.when(truthy(v, p), val) if branches is None else branches.when(truthy(v, p), val)
    fallback = default if default is not None else F.lit(None).cast(as_type)
    return branches.otherwise(fallback) if branches is not None else fallback


def first_truthy_node(v: Column, *paths: str) -> Column:
    """``(a or b or {})`` for sub-documents: the first truthy node, else null."""
    out = None
    for p in paths:
        out = F.when(truthy(v, p), node(v, p)) if out is None else out.when(truthy(v, p), node(v, p))
    return out.otherwise(F.lit(None).cast("variant")) if out is not None else F.lit(None)


def count_or_zero(v: Column, *paths: str) -> Column:
    """``a or 0`` for a counter, as bigint; a non-numeric value counts as 0."""
    val = first_truthy(v, *paths, as_type="string")
    # whole numbers exactly; others by way of a double
    return F.coalesce(val.try_cast("bigint"), val.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def unix_seconds(v: Column, path: str) -> Column:
    """C14: int seconds (number or numeric string) -> UTC timestamp; null if bad."""
    secs = python_int(v, path)
    # the instants a datetime can hold (years 1 to 9999), tested before any conversion
    return F.when(secs.between(-62135596800, 253402300799), F.timestamp_seconds(secs))


def iso_instant(s: Column) -> Column:
    """ISO-8601 (``Z`` or offset; naive = UTC) -> timestamp; null if bad."""
    return F.when(s.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"), s.try_cast("timestamp"))


def x_time(s: Column) -> Column:
    """C16: 'Sat Jul 25 18:26:52 +0000 2026' -> timestamp; null if bad."""
    return F.when(s.rlike(X_DAY_RE), F.try_to_timestamp(s.substr(F.lit(5), F.length(s)), F.lit(X_TIME_FMT)))


def iso_text(ts: Column) -> Column:
    """C17: timestamp -> ISO text with '+00:00'; fraction only when non-zero."""
    frac = F.date_format(ts, "SSSSSS") != "000000"
    return F.when(frac, F.date_format(ts, ISO_FMT_FRACTION)).otherwise(F.date_format(ts, ISO_FMT))


def python_int(v: Column, path: str) -> Column:
    """C20: ``int(value)`` as Python does it, null when that would raise:
    numbers truncate toward zero, strings must be integer literals."""
    j = json_text(v, path)
    is_str = j.startswith('"')
    from_str = F.trim(as_str(v, path)).try_cast("bigint")
    from_num = F.coalesce(j.try_cast("bigint"), F.try_variant_get(v, path, "double").try_cast("bigint"))
    return F.when(j.isNull() | (j == "null"), None).when(is_str, from_str).otherwise(from_num)
