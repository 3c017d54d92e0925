"""Identifier cleaning as Spark Column expressions.

Every helper returns a :class:`pyspark.sql.Column`; nothing here runs Python
per row.  The expressions stay inside whole-stage codegen except the array
higher-order functions, which Spark evaluates inside the same stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occulink.functions.common import as_col, distinct_present, literal_array, memo

# --- fixed values (must equal the reference's for identical results) --------
# Characters removed from identifiers before comparison (regex character class).
IDENTIFIER_STRIP_CLASS = r"[-.*,_ :|/\\#%&]"
# The same characters as a plain set, for ``translate`` (deletes each of them).
IDENTIFIER_STRIP_CHARS = "-.*,_ :|/\\#%&"
# Prefixes removed from other catalog numbers before the catalog-number rule.
CATALOG_PREFIXES = ("Cat.", "Cat#", "cat.", "cat#")

# Identifier values that never count as a match, as written in the source
# list, in its order.  They are compared after normalisation (see
# ``normalize_id_py``); NULL is also treated as omitted.
OMITTED_IDENTIFIERS_RAW = (
    "",
    "[]",
    "*",
    "--",
    "NO APLICA",
    "NA",
    "NO DISPONIBLE",
    "NO DISPONIBL",
    "NO NUMBER",
    "UNKNOWN",
    "SN",
    "ANONYMOUS",
    "NONE",
    "s.n.",
    "Unknown s.n.",
    "Unreadable s.n.",
    "se kommentar",
    "inget id",
    "x",
    "Anonymous s.n.",
    "Collector Number: s.n.",
    "No Number",
    "Anonymous",
    "None",
    "No Field Number",
    "not recorded",
    "s.l.",
    "s.c.",
    "present",
    "Undef/entomo",
    "s/nº",
    "undef",
    "no data",
)

# Grammar accepted by ``java.lang.Double.valueOf`` (from its API docs):
# optional blanks (chars <= 0x20), sign, NaN / Infinity, decimal or
# hexadecimal float, optional float/double suffix on numbers.
JAVA_DOUBLE_PATTERN = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity|"
    r"(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)"
    r"[\x00-\x20]*$"
)
# -----------------------------------------------------------------------------


def normalize_id_py(value: str | None) -> str | None:
    """Driver-side twin of :func:`normalize_id`, used for constants and tests."""
    import re

    if value is None:
        return None
    cleaned = re.sub(IDENTIFIER_STRIP_CLASS, "", value.upper())
    return cleaned or None


OMITTED_IDENTIFIERS = tuple(
    dict.fromkeys(v for v in map(normalize_id_py, OMITTED_IDENTIFIERS_RAW) if v is not None)
)


def normalize_id(c) -> Column:
    """Upper-case, drop separator characters, empty -> NULL."""

    def build():
        cleaned = F.translate(F.upper(as_col(c)), IDENTIFIER_STRIP_CHARS, "")
        return F.when(cleaned != "", cleaned)  # nullif would become shared sub-expressions

    return memo(("normalize_id", c), build) if isinstance(c, str) else build()


def is_omitted_normalized(n: Column) -> Column:
    """True when an already-normalised value is NULL or in the omit list."""
    return n.isNull() | F.array_contains(literal_array(OMITTED_IDENTIFIERS), n)


def is_eligible_normalized(n: Column) -> Column:
    """Eligibility of an already-normalised value (never NULL)."""
    return ~is_omitted_normalized(n)


def is_eligible(c) -> Column:
    """``isEligibleCode``: present, non-empty, and not omitted once normalised (S3)."""

    def build():
        col = as_col(c)
        return F.coalesce(
            col.isNotNull() & (F.length(col) != 0) & is_eligible_normalized(normalize_id(c)),
            F.lit(False),
        )

    return memo(("is_eligible", c), build) if isinstance(c, str) else build()


def is_numeric(c) -> Column:
    """True when Java's ``Double.parseDouble`` would accept the string."""

    def build():
        return F.coalesce(as_col(c).rlike(JAVA_DOUBLE_PATTERN), F.lit(False))

    return memo(("is_numeric", c), build) if isinstance(c, str) else build()


def hash_or_null(c, allow_numeric: bool) -> Column:
    """Normalised code when eligible (and, if strict, the raw code is not numeric)."""

    def build():
        cond = is_eligible(c)
        if not allow_numeric:
            cond = cond & ~is_numeric(c)
        return F.when(cond, normalize_id(c))

    return memo(("hash_or_null", c, allow_numeric), build) if isinstance(c, str) else build()


def concat_if_eligible(sep: str, *atoms) -> Column:
    """All atoms eligible -> normalised atoms joined by ``sep``, else NULL."""

    def build():
        cond = is_eligible(atoms[0])
        for a in atoms[1:]:
            cond = cond & is_eligible(a)
        return F.when(cond, F.concat_ws(sep, *[normalize_id(a) for a in atoms]))

    if all(isinstance(a, str) for a in atoms):
        return memo(("concat_if_eligible", sep, atoms), build)
    return build()


def triple_identifier(ic, cc, cn) -> Column:
    """``ic:cc:cn`` when none is NULL; empty strings allowed, not normalised."""
    return F.concat(as_col(ic), F.lit(":"), as_col(cc), F.lit(":"), as_col(cn))


def scoped_identifier(ic, cn) -> Column:
    """``ic:cn`` when neither is NULL."""
    return F.concat(as_col(ic), F.lit(":"), as_col(cn))


def list_identifiers(
    occurrence_id, field_number, record_number, catalog_number, ic, cc, other_catalog_numbers
) -> Column:
    """All raw identifiers of a record, NULLs dropped."""
    singles = F.array(
        as_col(occurrence_id),
        as_col(field_number),
        as_col(record_number),
        as_col(catalog_number),
        triple_identifier(ic, cc, catalog_number),
        scoped_identifier(ic, catalog_number),
    )
    others = F.coalesce(as_col(other_catalog_numbers), F.array().cast("array<string>"))
    return F.array_compact(F.concat(singles, others))


def strip_catalog_prefix(c) -> Column:
    """Remove a leading ``Cat.`` / ``Cat#`` (either case of the C)."""
    c = as_col(c)
    return F.when(F.substring(c, 1, 4).isin(*CATALOG_PREFIXES), c.substr(F.lit(5), F.length(c))).otherwise(c)


def normalized_identifier_set(ids: Column) -> Column:
    """Distinct normalised identifiers without NULL or omitted values (for F14)."""
    return distinct_present(F.transform(ids, _kept_normalized))


def _kept_normalized(c) -> Column:
    n = normalize_id(c)
    return F.when(is_eligible_normalized(n), n)


def identifier_set(occurrence_id, field_number, record_number, catalog_number, ic, cc, other) -> Column:
    """``normalized_identifier_set(list_identifiers(...))`` built from scalar
    expressions, with a lambda only over the other-catalog-number list."""
    singles = [
        _kept_normalized(as_col(c)) for c in (occurrence_id, field_number, record_number, catalog_number)
    ] + [
        _kept_normalized(triple_identifier(ic, cc, catalog_number)),
        _kept_normalized(scoped_identifier(ic, catalog_number)),
    ]
    others = F.transform(F.coalesce(as_col(other), F.array().cast("array<string>")), _kept_normalized)
    return distinct_present(F.concat(F.array(*singles), others))


# ---- the same forms for many consumers ----------------------------------------
# A column of a projection that several columns of the next one use is computed
# once a row; an expression used by several others is computed by each of them.

SINGLE_CODE_FIELDS = ("occurrenceID", "recordNumber", "fieldNumber", "catalogNumber")
CODE_FIELDS = SINGLE_CODE_FIELDS + ("institutionCode", "collectionCode")


def _kept(cleaned: Column) -> Column:
    """A cleaned value unless it is empty or omitted."""
    return F.when((cleaned != "") & ~cleaned.isin(*OMITTED_IDENTIFIERS), cleaned)


def _cleaned(c: Column) -> Column:
    return F.translate(F.upper(c), IDENTIFIER_STRIP_CHARS, "")


def with_codes(recs: DataFrame) -> DataFrame:
    """Add each code's forms, each computed once a record.

    ``_n_<field>`` is ``hash_or_null(field, True)``, ``_m_<field>`` its numeric
    test, ``_n_others`` and ``_s_others`` the other catalog numbers' codes with and
    without numeric ones, ``_c_triple`` and ``_c_scoped`` the cleaned joined
    identifiers, ``_bare_triple`` / ``_bare_scoped`` (and ``_j_...``, with
    separators) the joined codes, ``_catalog_others`` the other catalog numbers in
    comparable form.
    """
    others = F.coalesce(F.col("otherCatalogNumbers"), F.array().cast("array<string>"))
    cleaned = recs.select(
        "*",
        *[_cleaned(F.col(f)).alias(f"_c_{f}") for f in CODE_FIELDS],
        F.transform(others, _cleaned).alias("_c_others"),
        F.transform("otherCatalogNumbers", lambda x: _cleaned(strip_catalog_prefix(x))).alias("_c_stripped"),
    )
    kept = cleaned.select(
        "*",
        *[_kept(F.col(f"_c_{f}")).alias(f"_n_{f}") for f in CODE_FIELDS],
        *[is_numeric(f).alias(f"_m_{f}") for f in SINGLE_CODE_FIELDS],
        F.transform("_c_others", _kept).alias("_n_others"),
        F.transform(F.transform("_c_stripped", _kept), lambda n: F.when(~is_numeric(n), n)).alias("_catalog_others"),
        F.concat("_c_institutionCode", "_c_collectionCode", "_c_catalogNumber").alias("_c_triple"),
        F.concat("_c_institutionCode", "_c_catalogNumber").alias("_c_scoped"),
    )
    triple = ["_n_institutionCode", "_n_collectionCode", "_n_catalogNumber"]
    scoped = ["_n_institutionCode", "_n_catalogNumber"]
    joined = kept.select(
        "*",
        F.zip_with(others, "_n_others", lambda x, n: F.when(~is_numeric(x), n)).alias("_s_others"),
        F.concat(*triple).alias("_t"),
        F.concat(*scoped).alias("_u"),
    ).select("*", _kept(F.col("_t")).alias("_bare_triple"), _kept(F.col("_u")).alias("_bare_scoped"))
    return joined.select(
        "*",
        F.when(F.col("_bare_triple").isNotNull(), F.concat_ws(":", *triple)).alias("_j_triple"),
        F.when(F.col("_bare_scoped").isNotNull(), F.concat_ws(":", *scoped)).alias("_j_scoped"),
    ).drop("_t", "_u")


def single_codes(allow_numeric: bool) -> list[Column]:
    """``hash_or_null`` of the single codes of ``with_codes`` rows."""
    names = SINGLE_CODE_FIELDS
    return [F.col(f"_n_{f}") if allow_numeric else F.when(~F.col(f"_m_{f}"), F.col(f"_n_{f}")) for f in names]


def joined_codes(separators: bool) -> list[Column]:
    """The eligible ``ic:cc:cn`` and ``ic:cn`` codes of ``with_codes`` rows."""
    return [F.col(f"_{'j' if separators else 'bare'}_{kind}") for kind in ("triple", "scoped")]


def other_codes(allow_numeric: bool) -> Column:
    return F.col("_n_others" if allow_numeric else "_s_others")


def prepared_identifier_set() -> Column:
    """``identifier_set`` of ``with_codes`` rows."""
    singles = ["_n_occurrenceID", "_n_fieldNumber", "_n_recordNumber", "_n_catalogNumber"]
    joined = [_kept(F.col("_c_triple")), _kept(F.col("_c_scoped"))]
    return distinct_present(F.concat(F.array(*singles, *joined), F.col("_n_others")))


def prepared_catalog_code() -> Column:
    """``catalog_code`` of ``with_codes`` rows."""
    return F.when(~is_numeric(F.col("_bare_triple")), F.col("_bare_triple"))


def comparable_code(code: Column) -> Column:
    """Normalised code kept only when eligible and not numeric (F15 side rule)."""
    n = normalize_id(code)
    return F.when(is_eligible_normalized(n) & ~is_numeric(n), n)


def catalog_code(ic, cc, cn) -> Column:
    """The record's ``ic:cc:cn`` in comparable form for F15, or NULL."""
    return comparable_code(concat_if_eligible(":", ic, cc, cn))


def other_catalog_codes(other_catalog_numbers) -> Column:
    """Other catalog numbers, prefix-stripped and comparable, NULLs skipped."""
    arr = as_col(other_catalog_numbers)
    return distinct_present(F.transform(arr, lambda x: comparable_code(strip_catalog_prefix(x))))


def _code_parts(occurrence_id, record_number, field_number, catalog_number, ic, cc, other, allow_numeric):
    """Eligible codes of a record, each as (kept form, separator-free form)."""
    singles = [hash_or_null(c, allow_numeric) for c in (occurrence_id, record_number, field_number, catalog_number)]
    joined = []
    for atoms in ((ic, cc, catalog_number), (ic, catalog_number)):
        # atoms are normalised, so dropping the ``:`` separators normalises the joined form
        bare = concat_if_eligible("", *atoms)
        keep = is_eligible_normalized(bare)
        joined.append((F.when(keep, concat_if_eligible(":", *atoms)), F.when(keep, bare)))
    others = F.transform(
        F.coalesce(as_col(other), F.array().cast("array<string>")),
        lambda x: hash_or_null(x, allow_numeric),
    )
    return singles, joined, others


def codes_and_ids(
    occurrence_id,
    record_number,
    field_number,
    catalog_number,
    ic,
    cc,
    other_catalog_numbers,
    allow_numeric: bool,
    separators: bool = True,
) -> Column:
    """Every eligible form a record's codes are hashed under (``hashCodesAndIDs``).

    Single codes are normalised; the ``ic:cc:cn`` and ``ic:cn`` forms keep the
    ``:`` separators (``separators=False`` drops them, i.e. normalises them)
    and skip the numeric test.  The result is a distinct array without NULLs.
    """
    singles, joined, others = _code_parts(
        occurrence_id, record_number, field_number, catalog_number, ic, cc, other_catalog_numbers, allow_numeric
    )
    forms = [keep if separators else bare for keep, bare in joined]
    return distinct_present(F.concat(F.array(*singles, *forms), others))
