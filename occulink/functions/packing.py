"""Several columns as one text, for rows that are shuffled.

Every column of a shuffled row takes 8 bytes, and texts and lists have offsets and
padding besides, which compress badly.  One text of all values, with separators,
takes about half of that.  Rows whose values hold a separator or a mark, a missing
list element or bytes that are no UTF-8 travel as they are, in a second column that
is NULL otherwise, so that every row comes back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD, ITEM = "\x1f", "\x1e"  # between values, between elements of a list
NULL, EMPTY = "\x02", "\x03"  # a missing value, a list without elements
_PLAIN = (T.DoubleType, T.IntegerType, T.LongType, T.BooleanType)
TEXT = T.StringType()
LIST = T.ArrayType(TEXT)


def _is_list(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and t.elementType == TEXT


def packable(t: T.DataType) -> bool:
    return t == TEXT or _is_list(t) or isinstance(t, (*_PLAIN, T.DateType))


def pack(df: DataFrame, names, text: str = "_packed") -> DataFrame:
    """``df`` with the columns ``names`` as ``text`` (and ``<text>_odd``, for rows that
    no text can hold).  Columns of other types than ``packable`` ones stay."""
    fields = [df.schema[n] for n in names if packable(df.schema[n].dataType)]
    kept = [F.col(c) for c in df.columns if c not in {f.name for f in fields}]
    texts = [F.col(f.name) for f in fields if f.dataType == TEXT]
    lists = [F.array_join(f.name, "", NULL) for f in fields if _is_list(f.dataType)]
    marked = df.select("*", F.concat_ws("", *texts, *lists).alias(f"{text}_all"))
    is_odd = ~F.is_valid_utf8(f"{text}_all")
    for mark in (FIELD, ITEM, NULL, EMPTY):
        is_odd |= F.col(f"{text}_all").contains(mark)
    marked = marked.select(*df.columns, is_odd.alias(f"{text}_is_odd"))
    values = [x for f in fields for x in (F.lit(FIELD), _value(f))][1:]
    odd = F.col(f"{text}_is_odd")
    whole = F.struct(*[F.col(f.name) for f in fields])
    return marked.select(*kept, F.when(~odd, F.concat(*values)).alias(text), F.when(odd, whole).alias(f"{text}_odd"))


def unpack(df: DataFrame, schema: T.StructType, names, into: str, text: str = "_packed") -> DataFrame:
    """The columns ``names``, of the types they have in ``schema``, of ``pack`` rows as
    fields of the struct ``into``, after the other columns."""
    fields = [schema[n] for n in names if packable(schema[n].dataType)]
    other = [c for c in df.columns if c not in (text, f"{text}_odd")]
    # a projection of its own: a row's text is split once
    parts = df.select(*other, F.split(text, FIELD, -1).alias(text), f"{text}_odd")
    read = [_read(F.get(text, F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(fields)]
    odd = F.col(f"{text}_odd")
    return parts.select(*other, F.when(odd.isNotNull(), odd).otherwise(F.struct(*read)).alias(into))


def _value(f: T.StructField) -> Column:
    c = F.col(f.name)
    if _is_list(f.dataType):
        return F.when(c.isNull(), NULL).when(F.size(c) == 0, EMPTY).otherwise(F.array_join(c, ITEM))
    if isinstance(f.dataType, T.DateType):
        c = F.unix_date(c)
    return F.coalesce(c.cast("string"), F.lit(NULL))


def _read(part: Column, t: T.DataType) -> Column:
    if _is_list(t):
        return F.when(part == EMPTY, F.array().cast(LIST)).when(part != NULL, F.split(part, ITEM, -1))
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(F.when(part != NULL, part).cast("int"))
    return F.when(part != NULL, part).cast(t)
