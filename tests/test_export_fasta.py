"""Both directions, salted cells, lookup, FASTA."""

import glob
import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from occulink.operators import export, relate
from occulink.operators.fasta import fasta as fasta_of, write_fasta


def _rel(spark):
    rel = spark.createDataFrame(
        [("1", "2", "SAME_DATE", "d1", "d2", '{"a":1}', '{"b":2}'), ("5", "polygenelubricants", "X", "d1", "d3", "{}", "{}")],
        "id1 string, id2 string, reasons string, dataset1 string, dataset2 string, o1 string, o2 string",
    )
    return relate.both_directions(rel)


def test_both_directions(spark):
    rows = {(r.id1, r.id2): r for r in _rel(spark).collect()}
    assert set(rows) == {("1", "2"), ("2", "1"), ("5", "polygenelubricants"), ("polygenelubricants", "5")}
    assert rows[("2", "1")].dataset1 == "d2" and rows[("2", "1")].o1 == '{"b":2}'
    assert rows[("2", "1")].reasons == "SAME_DATE"


def test_cells_layout_and_lookup(spark):
    cells = export.export_cells(_rel(spark), 7)
    parts = cells.select("salt", "row_key", "qualifier", F.spark_partition_id().alias("p")).collect()
    assert len(parts) == 4 * 7
    assert all(r.p == r.salt for r in parts)
    assert {r.qualifier for r in parts} == {q for q, _ in export.CELL_QUALIFIERS}
    by_part = {}
    for r in parts:
        by_part.setdefault(r.p, []).append((r.row_key, r.qualifier))
    assert all(v == sorted(v) for v in by_part.values())
    s = export.salt_py("polygenelubricants", 7)
    assert s == abs(-2147483648) % 7
    out = tempfile.mkdtemp(prefix="occulink-cells-")
    export.write_cells(cells, os.path.join(out, "cells"))
    back = spark.read.parquet(os.path.join(out, "cells"))
    hit = export.lookup(back, "polygenelubricants", 7).collect()
    assert {r.qualifier: r.value for r in hit}["id2"] == "5" and len(hit) == 7
    ids = spark.createDataFrame([("2",), ("nope",)], "id string")
    got = export.related_records(back, ids, 7).collect()
    assert len(got) == 7 and {r.value for r in got if r.qualifier == "id2"} == {"1"}


def test_fasta(spark):
    df = spark.createDataFrame([("acgtx",), ("ACGT",), ("",), (None,), ("zzz",), ("straße",)], "dnasequence string")
    got = sorted(r.f for r in fasta_of(df).collect())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    # "straße" upper-cases to STRASSE; E is not an IUPAC letter
    assert got == sorted([f">{md5('ACGT')}\nACGT", f">{md5('')}\n", f">{md5('STRASS')}\nSTRASS"])
    out = os.path.join(tempfile.mkdtemp(prefix="occulink-fasta-"), "fa")
    write_fasta(fasta_of(df), out)
    files = glob.glob(os.path.join(out, "part-*"))
    assert files and all(f.endswith(".txt") for f in files)
    text = "".join(open(f).read() for f in files)
    assert text.count(">") == 3 and ">" + md5("ACGT") + "\nACGT" in text
