import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from driftwood.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8,
                  conf={"spark.driver.memory": "4g"})
    # tests own their checkpoint folder only because none is configured here
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="driftwood-test-ckpt-"))
    yield s
    s.stop()


def rows(df, order=None):
    cols = order or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)
