"""Session helpers: the shared folder is required off a local master."""

import types

import pytest

from tickrisk import session


def _fake(master, root=None):
    conf = types.SimpleNamespace(get=lambda k, d=None: root)
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf,
                               setCheckpointDir=lambda p: None)
    return types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k: root))


def test_cluster_without_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(_fake(master))


def test_setting_is_used_and_local_master_has_a_fallback():
    assert session.checkpoint_root(_fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert session.checkpoint_root(_fake("local[2]"))


def test_files_of_follows_content(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    first = session.files_of(spark, path)
    spark.range(4).write.mode("overwrite").parquet(path)
    assert first != session.files_of(spark, path)


def test_ensure_folder(spark, tmp_path):
    session.ensure_folder(spark, str(tmp_path / "a" / "b"))
    assert (tmp_path / "a" / "b").is_dir()
