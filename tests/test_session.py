"""Checkpoint folder resolution: never a machine-local folder on a cluster."""

import pytest

from termcluster.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = "file:" + path if path.startswith("/") else path


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, current)


def test_existing_context_folder_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///b"}, current="hdfs:///a")
    assert checkpoint_dir(s) == "hdfs:///a"


def test_configured_folder_is_used():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_local_master_without_setting_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("local[4]"))


def test_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))
