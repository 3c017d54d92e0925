import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from occulink.session import ensure_checkpoint_dir, local_session

    warehouse = tempfile.mkdtemp(prefix="occulink-test-wh-")
    s = local_session("*", shuffle_partitions=8, app="occulink-tests", extra_conf={"spark.sql.warehouse.dir": warehouse})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="occulink-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def one(df, col="x"):
    """Value of ``col`` in a one-row DataFrame."""
    return df.collect()[0][col]
