"""The record-linkage job end to end, as one lazy DataFrame plan per stage.

    source --input_projection--> records --record_hashes--> hashes
      --filter_hashes--> kept hashes --candidate_pairs--> pairs
      --relationships--> relationships (both directions) --export_cells--> cells

Stages can be materialised (``lineage="checkpoint"``, ``"parquet"`` or
``"table"``) so a lost executor only recomputes the current stage, and a run that
ended early can go on from its stage tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from occulink.operators import blocking, cellstore, export, features, relate
from occulink.operators.export import RECORD_COLUMNS
from occulink.session import apply_job_conf, cut_lineage
from occulink.sources import sinks
from occulink.sources.tables import source_fingerprint

# Changes whenever a stage's content does for the same source and settings.
FORMAT = 3
FINGERPRINT = "occulink.fingerprint"
# The settings that each stage depends on besides those of the stages before it.
STAGE_SETTINGS = {
    "input": ("checklist_key", "partitions"),
    "hashes": (),
    "hashes_filtered": ("max_group_size",),
    "candidates": (),
    "relationships": ("strict_days", "with_json"),
}


@dataclass(frozen=True)
class LinkageConfig:
    checklist_key: str | None = None  # None: the source is already projected
    max_group_size: int = 100  # records per key, above which a key is dropped
    buckets: int = 100  # salt buckets of the exported cells
    stop_list_size: int = blocking.DEFAULT_STOP_LIST_SIZE
    filter_method: str = "group"
    strict_days: bool = False
    with_json: bool = True
    lineage: str | None = None  # None, "checkpoint", "parquet" or "table"
    prefix: str = "occulink"  # stage table names when lineage == "table"
    resume: bool = False  # with lineage == "table": keep finished stages
    source_id: str | None = None  # names the source's content (default: its files)
    partitions: int | None = None  # record partitions (default: spark.sql.shuffle.partitions)


@dataclass
class LinkageResult:
    records: DataFrame
    hashes: DataFrame
    filtered: DataFrame
    pairs: DataFrame
    relationships: DataFrame
    cells: DataFrame


def _run(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


class _Stages:
    """Materialises the stages of a run, each once.

    Stage tables carry a fingerprint as a table property, set after the table is
    whole: of the source, of the settings that the stage depends on, and of the
    stages before it.  With ``resume`` a table whose fingerprint is the wanted
    one is read instead of being computed; all others are dropped first.
    """

    def __init__(self, spark: SparkSession, cfg: LinkageConfig, source: DataFrame) -> None:
        self.spark, self.cfg = spark, cfg
        self.print = None
        if cfg.lineage == "table":
            mark = cfg.source_id or source_fingerprint(source)
            self.print = _run(f"{FORMAT} {mark}") if mark else None
            finished = finished_stages(spark, cfg.prefix) if cfg.resume and self.print else {}
            wanted = self.print
            for name in sinks.STAGE_SUFFIXES:
                wanted = wanted and self._after(wanted, name)
                if not wanted or finished.get(name) != wanted:
                    sinks.drop_stage_tables(spark, cfg.prefix, sinks.STAGE_SUFFIXES[sinks.STAGE_SUFFIXES.index(name) :])
                    break

    def _after(self, mark: str, name: str) -> str:
        settings = {s: getattr(self.cfg, s) for s in STAGE_SETTINGS[name]}
        return _run(f"{mark} {name} {settings}")

    def __call__(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        cfg = self.cfg
        if cfg.lineage != "table":
            return cut_lineage(build(), cfg.lineage)
        self.print = self.print and self._after(self.print, name)
        table = sinks.stage_table(cfg.prefix, name)
        if self.print and sinks.table_property(self.spark, table, FINGERPRINT) == self.print:
            return self.spark.table(table)
        if name == "input":  # one file a bucket: the rows are dealt by the same hash
            n = cfg.partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            recs = features.partition_by_record(build(), n)
            sinks.write_bucketed_table(recs, table, n, "gbifId")
        else:
            sinks.write_table(build(), table)
        if self.print:
            sinks.set_table_property(self.spark, table, FINGERPRINT, self.print)
        return self.spark.table(table)


def finished_stages(spark: SparkSession, prefix: str) -> dict[str, str]:
    """The manifest of a run: the fingerprints of its finished stages."""
    marks = {name: sinks.table_property(spark, sinks.stage_table(prefix, name), FINGERPRINT) for name in sinks.STAGE_SUFFIXES}
    return {name: mark for name, mark in marks.items() if mark}


def run_linkage(source: DataFrame, cfg: LinkageConfig = LinkageConfig()) -> LinkageResult:
    """Build (and optionally materialise) every stage of the job.

    With ``lineage="table"`` records are stored in buckets by their id, so the
    joins of pairs with both records move the pairs only.  ``resume`` goes on
    after the last finished stage table of an earlier run on the same source
    with the same settings; a source that is no set of files needs a
    ``source_id`` for that.
    """
    spark = source.sparkSession
    apply_job_conf(spark)
    stage = _Stages(spark, cfg, source)
    recs = source if cfg.checklist_key is None else features.input_projection(source, cfg.checklist_key)
    recs = stage("input", lambda: recs if cfg.lineage == "table" else features.partition_by_record(recs, cfg.partitions))
    hashes = stage("hashes", lambda: blocking.record_hashes(recs))

    def kept() -> DataFrame:
        bits = blocking.prefilter_bits(hashes.count()) if cfg.lineage and cfg.filter_method == "group" else None
        return blocking.filter_hashes(hashes, cfg.max_group_size, method=cfg.filter_method, stop_list_size=cfg.stop_list_size, bits=bits)

    filtered = stage("hashes_filtered", kept)
    pairs = stage("candidates", lambda: blocking.candidate_pairs(filtered, "distinct"))
    rel = stage("relationships", lambda: relate.relationships(recs, pairs, strict_days=cfg.strict_days, with_json=cfg.with_json))
    return LinkageResult(recs, hashes, filtered, pairs, rel, export.export_cells(rel, cfg.buckets, cfg.with_json))


def publish(
    result: LinkageResult,
    cells_path: str | None = None,
    table: str | None = None,
    store: cellstore.CellStore | None = None,
) -> None:
    """Serve the relationships: as a new version of a cell ``store`` (readers go
    on during the switch), as plain files of cells partitioned by salt and / or
    as a relationships table that is replaced as a whole."""
    if store:
        with_json = set(RECORD_COLUMNS) <= set(result.relationships.columns)
        store.refresh(result.relationships, with_json)
    if cells_path:
        export.write_cells(result.cells, cells_path)
    if table:
        sinks.replace_table(result.relationships, table)
