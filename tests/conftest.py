import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkmarts.session import clear_scratch, local_session, work_dir

    s = local_session("*", shuffle_partitions=8, app="sparkmarts-tests")
    work_dir(s)  # uses spark.checkpoint.dir; sets a temporary one only when unset
    yield s
    clear_scratch(s)
    s.stop()


@pytest.fixture()
def scratch(spark):
    from sparkmarts.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
