"""Table-to-table operators of the linkage and FASTA jobs."""

from occulink.operators.blocking import (
    candidate_pairs,
    filter_hashes,
    key_counts,
    record_hashes,
)
from occulink.operators.export import export_cells, lookup, related_records, write_cells
from occulink.operators.fasta import distinct_sequences, fasta, write_fasta
from occulink.operators.features import comparison_features, input_projection
from occulink.operators.relate import (
    attach_records,
    both_directions,
    judge,
    related_pairs,
    relationships,
)

__all__ = [name for name in dir() if not name.startswith("_")]
