"""occulink: record linkage and sequence export as Spark DataFrame jobs."""

from occulink.operators import (
    attach_records,
    candidate_pairs,
    comparison_features,
    export_cells,
    fasta,
    filter_hashes,
    input_projection,
    judge,
    lookup,
    record_hashes,
    related_pairs,
    related_records,
    relationships,
    write_cells,
    write_fasta,
)
from occulink.plans.fasta_job import run_fasta
from occulink.plans.linkage import LinkageConfig, run_linkage

__all__ = [name for name in dir() if not name.startswith("_")]
