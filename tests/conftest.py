import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewell.session import build_session
    s = build_session("local[4]", 8, app_name="tidewell-tests")
    # tests run without a cluster-provided checkpoint folder: use a fresh local one
    if not s.conf.get("spark.checkpoint.dir", None):
        root = str(tmp_path_factory.mktemp("checkpoints"))
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(root)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples for comparison."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
