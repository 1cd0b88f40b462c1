"""The shared folder on a cluster must be shared."""

from types import SimpleNamespace

import pytest

from tastegraph import session as S


def on_cluster(spark, folder, **conf):
    """The session as a cluster's: a master that is not local, and the given checkpoint folder."""
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: folder, setCheckpointDir=lambda f: None, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context, conf=conf, _jvm=spark._jvm, _jsc=spark._jsc)


def test_file_folders_are_refused_on_a_cluster(spark, tmp_path):
    for folder in (f"file://{tmp_path}", str(tmp_path)):
        with pytest.raises(RuntimeError, match="each machine"):
            S.shared_dir(on_cluster(spark, folder))
        assert S.shared_dir(on_cluster(spark, folder, **{S.MOUNTED: "true"})) == folder
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        S.shared_dir(on_cluster(spark, None))
