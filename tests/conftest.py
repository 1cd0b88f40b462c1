import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tastegraph.session import build_session
    s = build_session("local[4]", 4, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture
def ratings(spark):
    """Build a ratings DataFrame from (user, product, rating[, ts]) tuples."""
    def make(rows, partitions=None):
        rows = [tuple(r) + (0,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame([(int(u), int(p), float(r), int(t)) for u, p, r, t in rows],
                                   "user_id long, product_id long, rating double, ts long")
        return df.repartition(partitions) if partitions else df
    return make
