import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from seriesflow.session import get_spark
    scratch = tempfile.mkdtemp(prefix="seriesflow-test-")
    s = get_spark(master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                         "spark.local.dir": os.path.join(scratch, "local")})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
