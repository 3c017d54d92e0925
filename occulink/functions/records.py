"""Record-level flags and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occulink.functions.common import as_col, false_if_null, memoized

# --- fixed values (must equal the reference's for identical results) --------
# Dataset keys of sequence repositories; their sparse records get one extra rule.
SEQUENCE_REPOSITORY_KEYS = (
    "d8cd16ba-bb74-4420-821e-083f2bac17c2",
    "393b8c26-e4e0-4dd0-a218-93fc074ebf4e",
    "583d91fe-bbc0-4b4a-afe1-801f88263016",
    "040c5662-da76-4782-a48e-cdea1892d14c",
)
# Basis-of-record values treated as specimens when deriving blocking keys.
HASHING_SPECIMEN_BASES = (
    "PRESERVED_SPECIMEN",
    "MATERIAL_SAMPLE",
    "LIVING_SPECIMEN",
    "FOSSIL_SPECIMEN",
    "MATERIAL_CITATION",
)
# Basis-of-record values treated as specimens by the catalog-number rule.
RULE_SPECIMEN_BASES = (
    "PRESERVED_SPECIMEN",
    "LIVING_SPECIMEN",
    "FOSSIL_SPECIMEN",
    "MATERIAL_CITATION",
)
# Columns of a record, in output order (also the order of the JSON keys here).
RECORD_COLUMNS = (
    "gbifId",
    "datasetKey",
    "basisOfRecord",
    "speciesKey",
    "taxonKey",
    "scientificName",
    "typeStatus",
    "decimalLatitude",
    "decimalLongitude",
    "countryCode",
    "year",
    "month",
    "day",
    "eventDate",
    "recordNumber",
    "fieldNumber",
    "occurrenceID",
    "otherCatalogNumbers",
    "institutionCode",
    "collectionCode",
    "catalogNumber",
    "recordedBy",
    "media",
)
# -----------------------------------------------------------------------------


def is_sequence_repository(dataset_key) -> Column:
    return false_if_null(F.lower(as_col(dataset_key)).isin(*SEQUENCE_REPOSITORY_KEYS))


def list_column(df: DataFrame, name: str) -> Column:
    """A list-valued field that may be stored as ``array<string>`` or as a
    vocabulary struct with a ``concepts`` array (S18)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.ArrayType):
        return F.col(name)
    if isinstance(dtype, T.StructType) and "concepts" in dtype.fieldNames():
        return F.col(name).getField("concepts")
    raise TypeError(f"column {name!r} must be array<string> or struct<concepts: array>, got {dtype}")


def is_json(text: Column) -> Column:
    """Whether a text is exactly one JSON value: only then is it both an array's
    sole element and an object's sole value.  False for NULL."""
    element = F.get_json_object(F.concat(F.lit("["), text, F.lit("]")), "$")
    value = F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$")
    return element.isNotNull() & value.isNotNull()


def _head(prefix: str, names: list[str]) -> Column:
    """JSON object of the columns ``names``, NULLs kept."""
    return F.to_json(F.struct(*[F.col(f"{prefix}{name}").alias(name) for name in names]), {"ignoreNullFields": "false"})


@memoized
def record_json(prefix: str = "", json_fields: tuple[str, ...] = ("media",)) -> Column:
    """JSON object of one record's columns, NULLs kept.

    Columns named in ``json_fields`` hold JSON text and follow the others, their
    text spliced in unchanged (repeated keys and the spelling of numbers stay).
    Text that is not one JSON value becomes ``null``.
    """
    head = _head(prefix, [name for name in RECORD_COLUMNS if name not in json_fields])
    parts = [head.substr(F.lit(1), F.length(head) - 1)]
    for name in (n for n in RECORD_COLUMNS if n in json_fields):
        text = F.col(f"{prefix}{name}")
        parts += [F.lit(f',"{name}":'), F.when(is_json(text), text).otherwise("null")]
    return F.concat(*parts, F.lit("}"))


# The JSON texts of a record's values without the names, for records that are shuffled:
# names are most of a record's JSON, and the same in every record.
_MEDIA = "media"
_VALUE_NAMES = [name for name in RECORD_COLUMNS if name != _MEDIA]
_BETWEEN = "\x1d"  # JSON made of columns holds no such character, it escapes it
_STARTS = [f'{"," if i else "{"}"{name}":' for i, name in enumerate(_VALUE_NAMES)]
_MEDIA_START = f',"{_MEDIA}":'


@memoized
def record_values() -> Column:
    """``struct(plain, media)`` of one record: of ``record_json``, the values before
    the media and the media (NULL for ``null``).  A name after a bare quote and
    before a colon is a key: quotes inside of values are escaped."""
    head = _head("", _VALUE_NAMES)
    first = len(_STARTS[0])
    bare = head.substr(F.lit(first + 1), F.length(head) - first - 1)
    names = "|".join(_VALUE_NAMES[1:])
    plain = F.regexp_replace(bare, f',"(?:{names})":', _BETWEEN)
    return F.struct(plain.alias("plain"), F.when(is_json(F.col(_MEDIA)), F.col(_MEDIA)).alias("media"))


def holds_values(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StructType)


def with_record_texts(df: DataFrame, names) -> DataFrame:
    """Columns of ``record_values`` among ``names`` become the ``record_json`` texts."""
    held = [n for n in names if holds_values(df, n)]
    if not held:
        return df
    # a projection of its own: a record's values are split once
    split = df.select("*", *[F.split(F.col(n)["plain"], _BETWEEN, -1).alias(f"_{n}_parts") for n in held])

    def text(n: str) -> Column:
        plain = [x for i, start in enumerate(_STARTS) for x in (F.lit(start), F.get(f"_{n}_parts", F.lit(i)))]
        whole = F.concat(*plain, F.lit(_MEDIA_START), F.coalesce(F.col(n)["media"], F.lit("null")), F.lit("}"))
        return whole.alias(n)

    return split.select(*[text(c) if c in held else F.col(c) for c in df.columns])


def record_bytes(df: DataFrame, name: str) -> Column:
    """Bytes of a record's JSON, given as text or as ``record_values``."""
    if not holds_values(df, name):
        return F.octet_length(name)
    names = sum(map(len, _STARTS)) - (len(_STARTS) - 1) + len(_MEDIA_START) + 1
    return F.octet_length(F.col(name)["plain"]) + F.coalesce(F.octet_length(F.col(name)["media"]), F.lit(4)) + names
