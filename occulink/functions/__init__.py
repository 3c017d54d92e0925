"""Column-expression builders: every scalar rule of the linkage and FASTA jobs."""

from occulink.functions.common import as_col, false_if_null
from occulink.functions.dates import period_days, safe_date, within_days
from occulink.functions.geo import haversine_km, round_half_up
from occulink.functions.hashing import java_string_hash, row_key, salt
from occulink.functions.identifiers import (
    OMITTED_IDENTIFIERS,
    catalog_code,
    codes_and_ids,
    concat_if_eligible,
    hash_or_null,
    is_eligible,
    is_numeric,
    list_identifiers,
    normalize_id,
    normalized_identifier_set,
    other_catalog_codes,
    scoped_identifier,
    strip_catalog_prefix,
    triple_identifier,
)
from occulink.functions.lists import contains_ignore_case, intersect_ignore_case
from occulink.functions.nulls import (
    all_null,
    equals_and_not_null,
    not_empty,
    present_and_not_equals,
    present_on_both,
    present_on_one_only,
)
from occulink.functions.records import is_sequence_repository, list_column, record_json
from occulink.functions.sequences import fasta_record, normalize_sequence

__all__ = [name for name in dir() if not name.startswith("_")]
