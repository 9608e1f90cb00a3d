import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    # default databases (the CLI test) live in a fresh folder, never in the working directory
    warehouse_dir = tempfile.mkdtemp(prefix="tillstar-test-warehouse-", dir="/tmp")
    s = build_session("local[4]", shuffle_partitions=4, app="tillstar-tests",
                      extra={"spark.sql.warehouse.dir": warehouse_dir})
    yield s


@pytest.fixture()
def scratch(spark):
    from tillstar.session import new_scratch_dir
    return new_scratch_dir(spark, "test")
