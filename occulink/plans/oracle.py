"""DuckDB SQL oracles for the registered queries.

Each query is re-stated in plain SQL over the driver's tables (views
``orders``, ``customer``, ``documents`` ...), with the rules written as SQL
expressions from the same fixed values, so the driver can compare both
engines' answers.  Record JSON is spelt out field by field, doubles as the JVM
prints them.
"""

from __future__ import annotations

from occulink.functions.identifiers import IDENTIFIER_STRIP_CLASS, JAVA_DOUBLE_PATTERN, OMITTED_IDENTIFIERS
from occulink.functions.records import (
    HASHING_SPECIMEN_BASES,
    RECORD_COLUMNS,
    RULE_SPECIMEN_BASES,
    SEQUENCE_REPOSITORY_KEYS,
)
from occulink.functions.sequences import IUPAC_NUCLEOTIDES
from occulink.operators.facts import CLOSE_KM, DAY_TOLERANCE, FACT_ORDER, NEAR_KM
from occulink.operators.rules import PASS_RULES
from occulink.sources.fixtures import REPOSITORY_DATASET

MAX_GROUP_SIZE = 100
BUCKETS = 100


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_lit(v) for v in values)


# ---- scalar rules as SQL ------------------------------------------------------


def norm(x: str) -> str:
    return f"NULLIF(regexp_replace(upper({x}), {_lit(IDENTIFIER_STRIP_CLASS)}, '', 'g'), '')"


def omitted(n: str) -> str:
    return f"(({n}) IS NULL OR ({n}) IN ({_in_list(OMITTED_IDENTIFIERS)}))"


def eligible(x: str) -> str:
    return f"COALESCE(({x}) IS NOT NULL AND length({x}) <> 0 AND NOT {omitted(norm(x))}, false)"


def numeric(x: str) -> str:
    return f"COALESCE(regexp_matches({x}, {_lit(JAVA_DOUBLE_PATTERN)}), false)"


def hash_or_null(x: str, allow_numeric: bool) -> str:
    cond = eligible(x) if allow_numeric else f"{eligible(x)} AND NOT {numeric(x)}"
    return f"CASE WHEN {cond} THEN {norm(x)} END"


def concat_if_eligible(*atoms: str) -> str:
    cond = " AND ".join(eligible(a) for a in atoms)
    joined = " || ':' || ".join(norm(a) for a in atoms)
    return f"CASE WHEN {cond} THEN {joined} END"


def comparable(x: str) -> str:
    n = norm(x)
    return f"CASE WHEN NOT {omitted(n)} AND NOT {numeric(n)} THEN {n} END"


def java_round(x: str) -> str:
    return (
        f"CASE WHEN isnan({x}) THEN CAST(0 AS BIGINT) "
        f"WHEN ({x}) - floor({x}) >= 0.5 THEN CAST(floor({x}) AS BIGINT) + 1 "
        f"ELSE CAST(floor({x}) AS BIGINT) END"
    )


def java_hash(s: str) -> str:
    unsigned = (
        f"list_reduce([CAST(0 AS BIGINT)] || list_transform(split({s}, ''), lambda ch: CAST(unicode(ch) AS BIGINT)), "
        f"lambda acc, v: (acc * 31 + v) % 4294967296)"
    )
    return f"(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END)"


def list_text(x: str, as_set: bool = False) -> str:
    inner = f"list_sort({x})" if as_set else x
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE array_to_string({inner}, '|') END"


EMPTY = "CAST([] AS VARCHAR[])"

# ---- the record view ----------------------------------------------------------

_EVENT = (
    "CASE WHEN k % 14 = 0 THEN '2000-01-02' WHEN k % 7 = 0 OR k % 6 = 1 THEN NULL "
    "ELSE '2000-0' || CAST(1 + dd % 2 AS VARCHAR) || '-0' || CAST(1 + dd % 5 AS VARCHAR) END"
)

RECORDS_CTE = f"""
src AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS c, cu.c_nationkey AS n, dayofmonth(o.o_orderdate) AS dd,
         o.o_orderstatus AS st, o.o_orderpriority AS pr, cu.c_name AS cname
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
  WHERE o.o_orderkey % 19 <> 0 AND o.o_orderkey % 23 <> 0 AND o.o_orderkey % 29 <> 0
),
rec AS (
  SELECT
    CAST(k AS VARCHAR) AS gbifId,
    CASE WHEN k % 4 = 3 THEN {_lit(REPOSITORY_DATASET)} ELSE 'ds-' || CAST(k % 4 AS VARCHAR) END AS datasetKey,
    CASE st WHEN 'P' THEN 'PRESERVED_SPECIMEN' WHEN 'F' THEN 'MATERIAL_SAMPLE' WHEN 'O' THEN 'HUMAN_OBSERVATION' END
      AS basisOfRecord,
    CAST(c AS VARCHAR) AS speciesKey,
    CAST(c AS VARCHAR) AS taxonKey,
    cname AS scientificName,
    CASE k % 20 WHEN 0 THEN ['Holotype'] WHEN 1 THEN ['ISOTYPE', 'holotype'] WHEN 2 THEN ['Paratype']
      WHEN 3 THEN {EMPTY} END AS typeStatus,
    CASE WHEN k % 11 = 0 THEN NULL
      ELSE CAST(n AS DOUBLE) * CAST(3.0 AS DOUBLE) + CAST(k % 5 AS DOUBLE) * CAST(0.0007 AS DOUBLE) END
      AS decimalLatitude,
    CASE WHEN k % 11 = 0 THEN NULL
      ELSE CAST(n AS DOUBLE) * CAST(5.0 AS DOUBLE) + CAST(k % 3 AS DOUBLE) * CAST(0.006 AS DOUBLE) END
      AS decimalLongitude,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 'ZZ' ELSE 'N' || CAST(n AS VARCHAR) END AS countryCode,
    CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(2000 AS INTEGER) END AS year,
    CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(1 + dd % 2 AS INTEGER) END AS month,
    CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(1 + dd % 5 AS INTEGER) END AS day,
    strftime(make_timestamp(CAST(epoch(CAST({_EVENT} AS DATE)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')
      AS eventDate,
    CASE WHEN k % 9 = 0 THEN 's.n.' ELSE 'RN ' || CAST(k % 6 AS VARCHAR) || '/' || st END AS recordNumber,
    CASE WHEN k % 8 = 0 THEN CAST(k % 16 AS VARCHAR) END AS fieldNumber,
    'urn:x:' || CAST(k AS VARCHAR) AS occurrenceID,
    CASE WHEN k % 3 = 0 THEN ['Cat. ' || CAST(k % 50 AS VARCHAR),
      'I' || CAST(c % 5 AS VARCHAR) || '/HERB/C-' || CAST(c % 40 AS VARCHAR)] END AS otherCatalogNumbers,
    'I' || CAST(c % 5 AS VARCHAR) AS institutionCode,
    CASE WHEN k % 2 = 0 THEN 'HERB' ELSE 'unknown' END AS collectionCode,
    'C ' || CAST(c % 40 AS VARCHAR) || CASE WHEN k % 4 = 0 THEN '' ELSE '-' || CAST(k % 9 AS VARCHAR) END
      AS catalogNumber,
    CASE WHEN k % 5 <> 0 THEN [cname, pr] END AS recordedBy,
    '[{{"id":' || CAST(k AS VARCHAR) || '}}]' AS media
  FROM src
)"""


def _codes(allow_numeric: bool) -> str:
    singles = ", ".join(
        [hash_or_null(c, allow_numeric) for c in ("occurrenceID", "recordNumber", "fieldNumber", "catalogNumber")]
        + [
            concat_if_eligible("institutionCode", "collectionCode", "catalogNumber"),
            concat_if_eligible("institutionCode", "catalogNumber"),
        ]
    )
    others = f"COALESCE(list_transform(otherCatalogNumbers, lambda x: {hash_or_null('x', allow_numeric)}), {EMPTY})"
    return f"list_distinct(list_filter(list_concat([{singles}], {others}), lambda x: {eligible('x')}))"


def _present(x: str) -> str:
    return f"(({x}) IS NOT NULL AND ({x}) <> '')"


_FAMILIES = {
    "place_date": (
        f"CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND year IS NOT NULL "
        f"AND month IS NOT NULL AND day IS NOT NULL AND {_present('speciesKey')} THEN "
        f"[speciesKey || '|' || CAST({java_round('decimalLatitude * CAST(1000 AS DOUBLE)')} AS VARCHAR) || '|' || "
        f"CAST({java_round('decimalLongitude * CAST(1000 AS DOUBLE)')} AS VARCHAR) || '|' || CAST(year AS VARCHAR) "
        f"|| '|' || CAST(month AS VARCHAR) || '|' || CAST(day AS VARCHAR)] ELSE {EMPTY} END"
    ),
    "species_identifier": (
        f"CASE WHEN {_present('speciesKey')} THEN list_transform(codes_any, lambda x: speciesKey || '|' || x) "
        f"ELSE {EMPTY} END"
    ),
    "type": (
        f"CASE WHEN {_present('taxonKey')} AND typeStatus IS NOT NULL AND len(typeStatus) > 0 "
        f"THEN [taxonKey || '|TYPE'] ELSE {EMPTY} END"
    ),
    "recorder": (
        f"CASE WHEN {_present('taxonKey')} AND year IS NOT NULL AND recordedBy IS NOT NULL THEN "
        f"list_transform(recordedBy, lambda r: CAST(year AS VARCHAR) || '|' || COALESCE(r, 'null')) ELSE {EMPTY} END"
    ),
    "specimen": (
        f"CASE WHEN COALESCE(basisOfRecord IN ({_in_list(HASHING_SPECIMEN_BASES)}), false) THEN list_concat("
        f"list_transform(codes_any, lambda x: COALESCE(speciesKey, 'null') || '|' || {norm('x')}), "
        f"list_transform(codes_strict, lambda x: {norm('x')})) ELSE {EMPTY} END"
    ),
}


def _hashes_cte(families) -> str:
    keys = _FAMILIES[families[0]]
    for f in families[1:]:
        keys = f"list_concat({keys}, {_FAMILIES[f]})"
    return f"""
coded AS (SELECT *, {_codes(True)} AS codes_any, {_codes(False)} AS codes_strict FROM rec),
keyed AS (SELECT gbifId, datasetKey, {keys} AS keys FROM coded),
hashes AS (
  SELECT DISTINCT gbifId, datasetKey, upper(h) AS hash
  FROM (SELECT gbifId, datasetKey, unnest(keys) AS h FROM keyed)
)"""


ALL_FAMILIES = tuple(_FAMILIES)

PAIRS_CTE = f"""
filtered AS (
  SELECT gbifId, datasetKey, hash FROM (
    SELECT *, count(*) OVER (PARTITION BY hash) AS cnt FROM hashes) s
  WHERE cnt > 1 AND cnt <= {MAX_GROUP_SIZE}
),
pairs AS (
  SELECT t1.gbifId AS id1, t1.datasetKey AS ds1, t2.gbifId AS id2, t2.datasetKey AS ds2
  FROM filtered t1 JOIN filtered t2 ON t1.hash = t2.hash
  WHERE t1.gbifId < t2.gbifId AND t1.datasetKey <> t2.datasetKey
  GROUP BY 1, 2, 3, 4
)"""

_IDLIST = (
    "list_filter(list_concat([occurrenceID, fieldNumber, recordNumber, catalogNumber, "
    "institutionCode || ':' || collectionCode || ':' || catalogNumber, institutionCode || ':' || catalogNumber], "
    f"COALESCE(otherCatalogNumbers, {EMPTY})), lambda x: x IS NOT NULL)"
)
_STRIP_PREFIX = "regexp_replace(x, '^[Cc]at[.#]', '')"
_CATCODE = comparable(concat_if_eligible("institutionCode", "collectionCode", "catalogNumber"))
_OTHERCODES = (
    "list_distinct(list_filter(list_transform(list_filter(otherCatalogNumbers, lambda x: x IS NOT NULL), "
    f"lambda x: {comparable(_STRIP_PREFIX)}), "
    "lambda x: x IS NOT NULL))"
)

FEATURES_CTE = f"""
feat AS (
  SELECT gbifId, datasetKey, speciesKey, taxonKey, scientificName,
    decimalLatitude AS lat, decimalLongitude AS lng, countryCode, year, month, day, eventDate,
    try_cast(printf('%04d-%02d-%02d', year, month, day) AS DATE) AS ymd,
    list_distinct(list_filter(list_transform({_IDLIST}, lambda x: {norm('x')}), lambda x: NOT {omitted('x')})) AS ids,
    {_CATCODE} AS catcode,
    {_OTHERCODES} AS othercodes,
    list_distinct(list_transform(list_filter(recordedBy, lambda x: x IS NOT NULL), lambda x: lower(x))) AS recorders,
    COALESCE(list_contains(list_transform(typeStatus, lambda x: lower(x)), 'holotype'), false) AS holotype,
    COALESCE(len(typeStatus) > 0, false) AS hastype,
    COALESCE(lower(datasetKey) IN ({_in_list(SEQUENCE_REPOSITORY_KEYS)}), false) AS seqrepo,
    COALESCE(basisOfRecord IN ({_in_list(RULE_SPECIMEN_BASES)}), false) AS rulespecimen
  FROM rec
)"""


def _eq(x: str) -> str:
    return f"COALESCE(a.{x} IS NOT NULL AND a.{x} = b.{x}, false)"


def _pane(x: str) -> str:
    return f"COALESCE(a.{x} IS NOT NULL AND b.{x} IS NOT NULL AND a.{x} <> b.{x}, false)"


def _one(x: str) -> str:
    return f"((a.{x} IS NULL) <> (b.{x} IS NULL))"


def _overlap(x: str) -> str:
    return f"COALESCE(len(list_intersect(a.{x}, b.{x})) > 0, false)"


_PERIOD = (
    "CASE WHEN tm > 0 AND ddiff < 0 THEN date_diff('day', ymd1 + to_months(CAST(tm - 1 AS INTEGER)), ymd2) "
    "WHEN tm < 0 AND ddiff > 0 THEN ddiff - day(last_day(ymd2)) ELSE ddiff END"
)
_HAVERSINE = (
    "6371.0 * (2 * atan2(sqrt(hv), sqrt(1 - hv)))"
)

FACTS_CTE = f"""
pf AS (
  SELECT p.id1, p.id2, p.ds1, p.ds2, a.ymd AS ymd1, b.ymd AS ymd2,
    (year(b.ymd) * 12 + month(b.ymd)) - (year(a.ymd) * 12 + month(a.ymd)) AS tm,
    day(b.ymd) - day(a.ymd) AS ddiff,
    pow(sin(radians(b.lat - a.lat) / 2), 2)
      + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2) AS hv,
    {_eq('speciesKey')} AS SAME_ACCEPTED_SPECIES,
    ({_eq('year')} AND {_eq('month')} AND {_eq('day')}) OR {_eq('eventDate')} AS d_same,
    {_pane('eventDate')} AS ed_differ,
    (a.eventDate IS NULL AND a.day IS NULL AND a.month IS NULL AND a.year IS NULL AND
     b.eventDate IS NULL AND b.day IS NULL AND b.month IS NULL AND b.year IS NULL) OR {_one('eventDate')} AS no_date,
    {_eq('lat')} AND {_eq('lng')} AS c_same,
    (a.lat IS NULL AND a.lng IS NULL AND b.lat IS NULL AND b.lng IS NULL) OR ({_one('lat')} AND {_one('lng')})
      AS coords_free,
    a.lat IS NOT NULL AND b.lat IS NOT NULL AND a.lng IS NOT NULL AND b.lng IS NOT NULL AS coords_both,
    {_eq('countryCode')} AS SAME_COUNTRY,
    {_one('countryCode')} AS NON_CONFLICTING_COUNTRY,
    {_pane('countryCode')} AS DIFFERENT_COUNTRY,
    {_overlap('ids')} AS IDENTIFIERS_OVERLAP,
    COALESCE(list_contains(b.othercodes, a.catcode), false) OR COALESCE(list_contains(a.othercodes, b.catcode), false)
      AS OTHER_CATALOG_NUMBERS_OVERLAP,
    {_overlap('recorders')} AS SAME_RECORDER_NAME,
    {_eq('taxonKey')} AND a.holotype AND b.holotype AS SAME_SPECIMEN,
    {_eq('scientificName')} AND a.hastype AND b.hastype AS TYPIFICATION_RELATION,
    a.seqrepo OR b.seqrepo AS either_repo,
    a.rulespecimen AND b.rulespecimen AS both_specimens
  FROM pairs p JOIN feat a ON p.id1 = a.gbifId JOIN feat b ON p.id2 = b.gbifId
),
pf2 AS (
  SELECT *,
    d_same AS SAME_DATE,
    NOT d_same AND COALESCE(abs({_PERIOD}) <= {DAY_TOLERANCE}, false) AS APPROXIMATE_DATE,
    c_same AS SAME_COORDINATES,
    NOT c_same AND coords_free AS NON_CONFLICTING_COORDINATES,
    NOT c_same AND NOT coords_free AND coords_both AND COALESCE({_HAVERSINE} <= {NEAR_KM}, false) AS WITHIN_200m,
    NOT c_same AND NOT coords_free AND coords_both AND COALESCE({_HAVERSINE} <= {CLOSE_KM}, false) AS WITHIN_2Km
  FROM pf
),
facts AS (
  SELECT *,
    NOT SAME_DATE AND NOT APPROXIMATE_DATE AND ed_differ AS DIFFERENT_DATE,
    NOT SAME_DATE AND NOT APPROXIMATE_DATE AND NOT ed_differ AND no_date AS NON_CONFLICTING_DATE
  FROM pf2
)"""


def _rule_sql(needed, kind) -> str:
    cond = " AND ".join(needed)
    if kind == "sequence_repository":
        cond += " AND either_repo"
    elif kind == "specimens":
        cond += " AND both_specimens"
    return f"({cond})"


RULES_SQL = {name: _rule_sql(needed, kind) for name, needed, kind in PASS_RULES}
R0_SQL = "(SAME_SPECIMEN OR TYPIFICATION_RELATION)"
VETO_SQL = "(DIFFERENT_DATE OR DIFFERENT_COUNTRY)"
RELATED_SQL = f"({R0_SQL} OR (NOT {VETO_SQL} AND ({' OR '.join(RULES_SQL.values())})))"
REASONS_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN {f} THEN '{f}' END" for f in FACT_ORDER) + ")"

REL_CTE = f"""
rel1 AS (
  SELECT id1, id2, {REASONS_SQL} AS reasons, ds1 AS dataset1, ds2 AS dataset2 FROM facts WHERE {RELATED_SQL}
),
rel AS MATERIALIZED (
  SELECT id1, id2, reasons, dataset1, dataset2 FROM rel1
  UNION ALL
  SELECT id2 AS id1, id1 AS id2, reasons, dataset2 AS dataset1, dataset1 AS dataset2 FROM rel1
),
cells AS MATERIALIZED (
  SELECT salt, CAST(salt AS VARCHAR) || ':' || id1 || ':' || id2 AS row_key, q.qualifier, q.value
  FROM (SELECT *, CAST(abs({java_hash('id1')}) % {BUCKETS} AS INTEGER) AS salt FROM rel) r,
  LATERAL (VALUES ('id1', r.id1), ('id2', r.id2), ('reasons', r.reasons),
                  ('dataset1', r.dataset1), ('dataset2', r.dataset2)) q(qualifier, value)
)"""


def _json_field(c: str) -> str:
    if c in ("decimalLatitude", "decimalLongitude"):  # the JVM writes 0.0007 as 7.0E-4
        text = f"CAST({c} AS VARCHAR)"
        small = f"regexp_extract({text}, '^0[.]000([1-9])', 1) || '.' || COALESCE(NULLIF(substr({text}, 7), ''), '0') || 'E-4'"
        return f"CASE WHEN regexp_matches({text}, '^0[.]000[1-9]') THEN {small} ELSE COALESCE({text}, 'null') END"
    if c == "media":  # JSON text itself
        return "CASE WHEN json_valid(media) THEN media ELSE 'null' END"
    return f"COALESCE(CAST(to_json({c}) AS VARCHAR), 'null')"


RECORD_CELLS_CTE = f"""
docs AS MATERIALIZED (
  SELECT gbifId, '{{' || {" || ',' || ".join(f"{_lit(chr(34) + c + chr(34) + ':')} || {_json_field(c)}" for c in RECORD_COLUMNS)} || '}}' AS doc FROM rec
),
all_cells AS (
  SELECT salt, row_key, qualifier, value FROM cells
  UNION ALL
  SELECT c.salt, c.row_key, 'occurrence' || right(c.qualifier, 1), docs.doc
  FROM cells c JOIN docs ON docs.gbifId = c.value WHERE c.qualifier IN ('id1', 'id2')
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _list_cols(prefix: str = "") -> str:
    out = []
    for c in RECORD_COLUMNS:
        src = f"{prefix}{c}" if prefix else c
        if c in ("typeStatus", "otherCatalogNumbers", "recordedBy"):
            out.append(f"{list_text(src)} AS {prefix.replace('.', '_')}{c}")
        else:
            out.append(f"{src} AS {prefix.replace('.', '_')}{c}")
    return ", ".join(out)


_NORMALIZE_ROWS = (
    "SELECT gbifId, f.field, f.raw FROM rec, LATERAL (VALUES ('occurrenceID', occurrenceID), "
    "('recordNumber', recordNumber), ('fieldNumber', fieldNumber), ('catalogNumber', catalogNumber), "
    "('institutionCode', institutionCode), ('collectionCode', collectionCode)) f(field, raw) "
    "UNION ALL "
    "SELECT gbifId, 'otherCatalogNumbers[' || CAST(generate_subscripts(otherCatalogNumbers, 1) AS VARCHAR) || ']', "
    "unnest(otherCatalogNumbers) FROM rec WHERE otherCatalogNumbers IS NOT NULL"
)


def _family_sql(name: str) -> str:
    return _with(RECORDS_CTE, _hashes_cte((name,))) + "SELECT gbifId, datasetKey, hash FROM hashes"


def _facts_sql(cols) -> str:
    return _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE, FEATURES_CTE, FACTS_CTE) + (
        "SELECT id1, id2, " + ", ".join(cols) + " FROM facts"
    )


_SEQ = f"regexp_replace(upper(replace(text, 'ß', 'SS')), '[^{IUPAC_NUCLEOTIDES}]', '', 'g')"

_REL_CTES = (RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE, FEATURES_CTE, FACTS_CTE, REL_CTE)
_RETURNED_CTE = """
wanted AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS value FROM lineitem WHERE l_returnflag = 'R'),
hits AS (SELECT c.row_key FROM cells c SEMI JOIN wanted USING (value) WHERE c.qualifier = 'id1')"""
_BUSIEST_CTE = """
busiest AS (SELECT value FROM cells WHERE qualifier = 'id1' GROUP BY value ORDER BY count(*) DESC, value LIMIT 1),
hits AS (SELECT c.row_key FROM cells c SEMI JOIN busiest USING (value) WHERE c.qualifier = 'id1')"""

ORACLE_SQL: dict[str, str] = {
    "fasta_distinct": (
        f"WITH s AS (SELECT {_SEQ} AS seq FROM documents WHERE text IS NOT NULL AND length(text) > 0 GROUP BY 1) "
        "SELECT '>' || md5(seq) || chr(10) || seq AS f FROM s"
    ),
    "input_projection": _with(RECORDS_CTE) + f"SELECT {_list_cols()} FROM rec",
    "normalize_identifiers": _with(RECORDS_CTE)
    + f"SELECT gbifId, field, raw, {norm('raw')} AS normalized, {eligible('raw')} AS eligible, "
    f"{numeric('raw')} AS numeric, {hash_or_null('raw', True)} AS code_any, "
    f"{hash_or_null('raw', False)} AS code_strict FROM ({_NORMALIZE_ROWS}) t",
    "identifier_list": _with(RECORDS_CTE)
    + "SELECT gbifId, "
    "institutionCode || ':' || collectionCode || ':' || catalogNumber AS triple, "
    "institutionCode || ':' || catalogNumber AS scoped, "
    f"{list_text(_IDLIST)} AS identifiers, "
    f"{concat_if_eligible('institutionCode', 'collectionCode', 'catalogNumber')} AS triple_code, "
    f"{concat_if_eligible('institutionCode', 'catalogNumber')} AS scoped_code, "
    f"{list_text('list_distinct(list_filter(list_transform(' + _IDLIST + ', lambda x: ' + norm('x') + '), lambda x: NOT ' + omitted('x') + '))', True)} AS id_set, "
    f"{_CATCODE} AS catalog_code, "
    f"{list_text(_OTHERCODES, True)} AS other_codes, "
    f"{list_text(_codes(True), True)} AS codes_any, "
    f"{list_text(_codes(False), True)} AS codes_strict "
    "FROM rec",
    "hash_place_date": _family_sql("place_date"),
    "hash_species_id": _family_sql("species_identifier"),
    "hash_type": _family_sql("type"),
    "hash_recorder": _family_sql("recorder"),
    "hash_specimen": _family_sql("specimen"),
    "record_hashes": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES)) + "SELECT gbifId, datasetKey, hash FROM hashes",
    "hashes_filtered": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE)
    + "SELECT gbifId, datasetKey, hash FROM filtered",
    "candidate_pairs": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE) + "SELECT * FROM pairs",
    "candidate_records": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE)
    + f"SELECT {_list_cols('t1.')}, {_list_cols('t2.')} "
    "FROM pairs p JOIN rec t1 ON p.id1 = t1.gbifId JOIN rec t2 ON p.id2 = t2.gbifId",
    "facts_date": _facts_sql(["SAME_DATE", "APPROXIMATE_DATE", "DIFFERENT_DATE", "NON_CONFLICTING_DATE"]),
    "facts_coordinates": _facts_sql(
        ["SAME_COORDINATES", "WITHIN_200m", "WITHIN_2Km", "NON_CONFLICTING_COORDINATES"]
    ),
    "facts_country": _facts_sql(["SAME_COUNTRY", "NON_CONFLICTING_COUNTRY", "DIFFERENT_COUNTRY"]),
    "facts_identifiers": _facts_sql(["IDENTIFIERS_OVERLAP"]),
    "facts_catalog": _facts_sql(["OTHER_CATALOG_NUMBERS_OVERLAP"]),
    "facts_recorder": _facts_sql(["SAME_RECORDER_NAME"]),
    "facts_type": _facts_sql(["SAME_ACCEPTED_SPECIES", "SAME_SPECIMEN", "TYPIFICATION_RELATION"]),
    "decision": _facts_sql(
        [f"{R0_SQL} AS R0", f"{VETO_SQL} AS vetoed"]
        + [f"{sql} AS {name}" for name, sql in RULES_SQL.items()]
        + [f"{RELATED_SQL} AS related", f"{REASONS_SQL} AS reasons"]
    ),
    "relationships": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE, FEATURES_CTE, FACTS_CTE, REL_CTE)
    + "SELECT * FROM rel",
    "export_cells": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE, FEATURES_CTE, FACTS_CTE, REL_CTE)
    + "SELECT salt, row_key, qualifier, value FROM cells",
    "lookup_related": _with(*_REL_CTES, _RETURNED_CTE)
    + "SELECT c.salt, c.row_key, c.qualifier, c.value FROM cells c SEMI JOIN hits USING (row_key)",
    "export_cells_records": _with(RECORDS_CTE, _hashes_cte(ALL_FAMILIES), PAIRS_CTE, FEATURES_CTE, FACTS_CTE, REL_CTE, RECORD_CELLS_CTE)
    + "SELECT salt, row_key, qualifier, value FROM all_cells",
    "lookup_related_records": _with(*_REL_CTES, RECORD_CELLS_CTE, _RETURNED_CTE)
    + "SELECT c.salt, c.row_key, c.qualifier, c.value FROM all_cells c SEMI JOIN hits USING (row_key)",
    "lookup_record": _with(*_REL_CTES, RECORD_CELLS_CTE, _BUSIEST_CTE)
    + "SELECT c.salt, c.row_key, c.qualifier, c.value FROM all_cells c SEMI JOIN hits USING (row_key)",
    "sql_functions": _with(RECORDS_CTE)
    + f""", r AS (
      SELECT gbifId, countryCode, decimalLatitude AS lat, decimalLongitude AS lng, {norm("catalogNumber")} AS code,
             {eligible("catalogNumber")} AS eligible, {numeric("fieldNumber")} AS numeric_field,
             CASE WHEN length(scientificName) > 0 THEN regexp_replace(upper(scientificName), '[^{IUPAC_NUCLEOTIDES}]', '', 'g') END AS letters
      FROM rec),
    f AS (SELECT countryCode, arg_min(lat, gbifId) AS lat0, arg_min(lng, gbifId) AS lng0 FROM r
          WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY countryCode),
    d AS (
      SELECT r.*, pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lng - lng0) / 2), 2) AS hv
      FROM r JOIN f ON f.countryCode IS NOT DISTINCT FROM r.countryCode)
    SELECT countryCode, code, eligible, numeric_field, letters, count(*) AS records,
           round(max(6371.0 * (2 * atan2(sqrt(hv), sqrt(1 - hv)))), 6) AS farthest_km
    FROM d GROUP BY ALL""",
    "relationship_json": _with(*_REL_CTES, RECORD_CELLS_CTE)
    + "SELECT rel.id1, rel.id2, a.doc AS o1, b.doc AS o2 FROM rel JOIN docs a ON a.gbifId = rel.id1 JOIN docs b ON b.gbifId = rel.id2",
}
