"""Checkpoint folder rules: the session's setting wins; a scratch folder only
in local mode; a cluster session without a shared folder fails early."""

import pytest

from attrition.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self._values = values

    def get(self, key, default=None):
        return self._values.get(key, default)


class _Context:
    def __init__(self, master, conf=None, current=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._dir = current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, context):
        self.sparkContext = context


def test_configured_folder_is_used_as_is():
    sc = _Context("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert ensure_checkpoint_dir(_Session(sc)) == "hdfs://nn/shared/ckpt"


def test_folder_already_set_on_the_context_wins():
    sc = _Context("k8s://api", current="s3a://bucket/ckpt")
    assert ensure_checkpoint_dir(_Session(sc)) == "s3a://bucket/ckpt"


def test_cluster_without_shared_folder_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("spark://master:7077")))


def test_local_mode_without_a_folder_fails_too():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("local[4]")))


def test_real_session_has_one(spark):
    assert ensure_checkpoint_dir(spark)
