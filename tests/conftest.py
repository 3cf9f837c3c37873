import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from staffline.session import get_session

    warehouse = tempfile.mkdtemp(prefix="staffline-warehouse-")
    s = get_session("local[4]", shuffle_partitions=4, app_name="staffline-tests",
                    extra_conf={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "8g"})
    # tests run without a cluster checkpoint folder: use a private one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="staffline-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison helper)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
