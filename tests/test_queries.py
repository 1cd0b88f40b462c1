"""Every registered query against its DuckDB oracle on the smallest fixture
scale, plus the ALS certificates and the driver contract."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck

from tastegraph.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con)
    if name in entry.oracle_sql():
        assert res["status"] in ("ok", "ok~"), res
    else:
        assert res["status"] == "no-oracle" and res["spark_rows"] > 0, res


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "product_id", "score", "rank"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_als_certificate_is_sharp(spark):
    from tastegraph.operators import als as A
    from tastegraph.plans.catalog import splits
    tr, _, te = splits(spark, "/root/testdata/sf0.01")
    model = A.als_train(tr, rank=4, max_iter=5, reg_param=0.1, seed=1)
    ok = A.als_normal_equation_check(model, tr, 0.1).first()
    assert ok.n_violations == 0 and ok.max_residual < 1e-3
    wrong = A.als_normal_equation_check(model, tr, 0.2).first()
    assert wrong.n_violations > 0
    pc = A.als_prediction_check(model, te).first()
    assert pc.n_rows > 0 and pc.n_mismatch == 0
