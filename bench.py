"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once on the sf0.001 tables to warm the JVM, then once timed
on ``BENCH_SF_DIR``.  Results are written to Spark's ``noop`` sink, so the
whole plan executes without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from occulink.operators import blocking, export, relate  # noqa: E402
from occulink.plans import queries as Q  # noqa: E402
from occulink.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = "/root/testdata/sf0.001"


def linkage(spark, d):
    """Whole linkage job: records -> keys -> pairs -> rules -> both directions with JSON."""
    recs = Q.records(spark, d)
    pairs = blocking.candidate_pairs(Q.kept_hashes(blocking.record_hashes(recs)))
    return relate.relationships(recs, pairs)


def linkage_cells(spark, d):
    """Whole job including the salted, sorted cell layout for lookup."""
    return export.export_cells(linkage(spark, d), Q.BUCKETS)


def linkage_job(spark, d):
    """The job as run in production: stages checkpointed, then the cells."""
    from occulink.plans.linkage import LinkageConfig, run_linkage
    from occulink.sources.fixtures import CHECKLIST_KEY, occurrence_source

    cfg = LinkageConfig(checklist_key=CHECKLIST_KEY, max_group_size=Q.MAX_GROUP_SIZE, buckets=Q.BUCKETS,
                        lineage="checkpoint")
    return run_linkage(occurrence_source(spark, d), cfg).cells


BENCH = {
    "record_hashes": lambda s, d: Q.QUERIES["record_hashes"](s, d),
    "hashes_filtered": lambda s, d: Q.QUERIES["hashes_filtered"](s, d),
    "candidate_pairs": lambda s, d: Q.QUERIES["candidate_pairs"](s, d),
    "relationships": lambda s, d: Q.QUERIES["relationships"](s, d),
    "linkage_json": linkage,
    "linkage_cells": linkage_cells,
    "linkage_job": linkage_job,
    "fasta_distinct": lambda s, d: Q.QUERIES["fasta_distinct"](s, d),
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    parts = max(8, int(CPUS) * 2)
    spark = local_session(CPUS, shuffle_partitions=parts, app="occulink-bench")
    for name, fn in BENCH.items():
        run(fn(spark, WARM_DIR))
    times = {}
    for name, fn in BENCH.items():
        t = time.perf_counter()
        run(fn(spark, SF_DIR))
        times[name] = round(time.perf_counter() - t, 3)
    n_records = Q.records(spark, SF_DIR).count()
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    best = min(times["linkage_cells"], times["linkage_job"])
    out = {
        "metric": "linkage_end_to_end",
        "value": best,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "records": n_records,
        "records_per_sec": round(n_records / best, 1),
        "cpus": int(CPUS),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
