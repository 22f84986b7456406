import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from odflow.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="odflow-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)          # uses spark.checkpoint.dir, or a private folder in local mode
    yield s


@pytest.fixture()
def scratch(spark, tmp_path):
    """A fresh folder per test (local mode only)."""
    return str(tmp_path)
