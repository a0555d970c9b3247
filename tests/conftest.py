import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendgrid.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="sg-warehouse-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
