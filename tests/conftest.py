import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import build_session

    s = build_session(
        "local[*]",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sluice-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sluice-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
