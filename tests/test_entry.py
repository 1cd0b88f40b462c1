"""The entry's queries on a cluster whose shared folder is a mounted one."""

from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from tastegraph.session import MOUNTED, scratch_path


class Conf(dict):
    set = dict.__setitem__


def on_cluster(spark, folder, **conf):
    """The session as a cluster's, with the given checkpoint folder."""
    conf = Conf(conf)
    context = SimpleNamespace(master="spark://head:7077", getCheckpointDir=lambda: folder, setCheckpointDir=lambda f: None, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context, conf=conf, _jvm=spark._jvm, _jsc=spark._jsc)


def test_queries_run_with_a_mounted_checkpoint_folder(spark, tmp_path):
    query = entry._wrap(lambda s, d: scratch_path(s, d))
    assert query(on_cluster(spark, f"file://{tmp_path}"), "t").startswith(f"file://{tmp_path}/tables/t-")


def test_a_setting_that_denies_it_and_a_missing_folder_still_refuse(spark, tmp_path):
    query = entry._wrap(lambda s, d: scratch_path(s, d))
    with pytest.raises(RuntimeError, match="each machine"):
        query(on_cluster(spark, f"file://{tmp_path}", **{MOUNTED: "false"}), "t")
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        query(on_cluster(spark, None), "t")


@pytest.mark.parametrize("name", ["filter_user_id_cap", "distinct_ids", "drop_constant_users", "cap_raters", "encode_users", "encode_products", "encode_metadata_products",
                                  "encode_joint", "encode_append", "decode_ids", "frequent_products", "co_rater_pairs", "join_predictions_actuals"])
def test_a_registered_query_gives_rows_there(spark, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")  # the folder of the tests is a file: one
    try:
        assert entry.queries()[name](spark, entry.SMOKE_DIR).limit(1).count() == 1
    finally:
        spark.conf.unset(MOUNTED)


@pytest.mark.parametrize("name", ["corated_cosine", "item_cosine", "improvement_pct"])
def test_a_query_of_pairs_gives_rows_there(spark, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")  # the folder of the tests is a file: one
    try:
        assert entry.queries()[name](spark, entry.SMOKE_DIR).limit(1).count() == 1
    finally:
        spark.conf.unset(MOUNTED)


@pytest.mark.parametrize("name", ["als_fold_in", "als_grid_search", "als_predict", "als_train", "als_recs_for_user", "als_recs_for_all"])
def test_a_query_of_fitted_models_gives_its_row_there(spark, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")  # the folder of the tests is a file: one
    try:
        assert len(entry.queries()[name](spark, entry.SMOKE_DIR).collect()) == 1
    finally:
        spark.conf.unset(MOUNTED)
