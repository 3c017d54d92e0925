"""Every stage table of a linkage run is written."""

from occulink.plans.linkage import LinkageConfig, run_linkage
from occulink.sources import sinks
from occulink.sources.fixtures import CHECKLIST_KEY, occurrence_source
from tests.conftest import SF_SMALL


def test_all_stage_tables_are_written(spark):
    cfg = LinkageConfig(checklist_key=CHECKLIST_KEY, with_json=False, lineage="table", prefix="t_all")
    res = run_linkage(occurrence_source(spark, SF_SMALL), cfg)
    assert all(spark.catalog.tableExists(f"t_all_{suffix}") for suffix in sinks.STAGE_SUFFIXES)
    assert spark.table("t_all_hashes_filtered").count() == res.filtered.count() > 0
    sinks.drop_stage_tables(spark, "t_all")


def test_tables_and_cells_are_snappy_compressed(spark):
    import glob
    import tempfile

    import pyarrow.parquet as pq

    from occulink.operators.cellstore import CellStore

    sinks.write_table(spark.range(100), "t_codec")
    rel = spark.createDataFrame([("1", "2", "X", "d1", "d2", "{}", "{}")], "id1 string, id2 string, reasons string, dataset1 string, dataset2 string, o1 string, o2 string")
    path = CellStore(spark, tempfile.mkdtemp(prefix="occulink-codec-") + "/cells").refresh(rel)
    files = [f.removeprefix("file:") for f in spark.table("t_codec").inputFiles()] + glob.glob(f"{path}/salt=*/*.parquet")
    codecs = {pq.ParquetFile(f.replace("//", "")).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f.replace("//", "")).metadata.num_row_groups}
    assert codecs == {"SNAPPY"}
    spark.sql("DROP TABLE t_codec")
