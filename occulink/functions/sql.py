"""The scalar rules as SQL functions of a session.

Each is a SQL function with a body, so that the optimiser puts the body in place
of the call: a query in SQL gets the plan that the Column builders would give.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from occulink.functions.geo import EARTH_RADIUS_KM
from occulink.functions.identifiers import IDENTIFIER_STRIP_CHARS, JAVA_DOUBLE_PATTERN, OMITTED_IDENTIFIERS
from occulink.functions.sequences import IUPAC_NUCLEOTIDES


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


_NORMAL = f"translate(upper({{0}}), {_text(IDENTIFIER_STRIP_CHARS)}, '')"
_OMITTED = ", ".join(map(_text, OMITTED_IDENTIFIERS))
_HALF = "pow(sin(radians({1} - {0}) / 2), 2)"
_ARC = f"{_HALF.format('lat1', 'lat2')} + cos(radians(lat1)) * cos(radians(lat2)) * {_HALF.format('lng1', 'lng2')}"

#: Name -> (parameters, result type, body).
SQL_FUNCTIONS = {
    "normalize_identifier": ("id STRING", "STRING", f"nullif({_NORMAL.format('id')}, '')"),
    "is_eligible_identifier": (
        "id STRING",
        "BOOLEAN",
        f"coalesce(length(id) <> 0 AND {_NORMAL.format('id')} <> '' AND {_NORMAL.format('id')} NOT IN ({_OMITTED}), false)",
    ),
    "is_numeric_identifier": ("id STRING", "BOOLEAN", f"coalesce(id RLIKE {_text(JAVA_DOUBLE_PATTERN)}, false)"),
    "great_circle_km": (
        "lat1 DOUBLE, lng1 DOUBLE, lat2 DOUBLE, lng2 DOUBLE",
        "DOUBLE",
        f"double({EARTH_RADIUS_KM}) * (2 * atan2(sqrt({_ARC}), sqrt(1 - ({_ARC}))))",
    ),
    "normalize_sequence": (
        "seq STRING",
        "STRING",
        f"CASE WHEN length(seq) > 0 THEN regexp_replace(upper(seq), '[^{IUPAC_NUCLEOTIDES}]', '') END",
    ),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL in this session."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
