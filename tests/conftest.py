import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from veritab.session import get_session

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="veritab-warehouse-")
    s = get_session(app="veritab-tests", master="local[4]", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMOKE
