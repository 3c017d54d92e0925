"""Small shared helpers for building Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def false_if_null(c: Column) -> Column:
    """Three-valued predicate -> two-valued (NULL counts as false)."""
    return F.coalesce(c, F.lit(False))


_MEMO: dict = {}


def memo(key, build):
    """Reuse a built Column within the active SparkContext.

    Column objects are immutable expression trees, so the same one can appear
    in many places; sharing them avoids rebuilding large trees through the
    Python-JVM bridge (one round trip per node).
    """
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    full = (id(sc), key)
    if full not in _MEMO:
        if len(_MEMO) > 4096:
            _MEMO.clear()
        _MEMO[full] = build()
    return _MEMO[full]


def literal_array(values: tuple) -> Column:
    """A cached array literal of strings (one build per session)."""
    return memo(("literal_array", values), lambda: F.array(*[F.lit(v) for v in values]))


def distinct_present(arr: Column) -> Column:
    """Distinct non-NULL elements of a string array (NULL array stays NULL).

    ``array_except`` with a one-NULL array is code-generated, unlike
    ``array_compact``/``filter``, which Spark evaluates as lambda functions
    outside whole-stage codegen.
    """
    return F.array_except(arr, memo("null_string_array", lambda: F.array(F.lit(None).cast("string"))))


def memoized(fn):
    """Decorator: build a function's Columns once per session and argument set.

    For builders whose result depends only on column names and constants.
    """
    import functools

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        key = (fn.__module__, fn.__qualname__, args, tuple(sorted(kwargs.items())))
        return memo(key, lambda: fn(*args, **kwargs))

    return wrapper
