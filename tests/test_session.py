"""The shared scratch folder comes from the session; none is invented on a cluster."""

import pytest

from tallyho.session import fresh_dir, scratch_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _ClusterSession:
    """Stands in for a session without a local SparkContext handle."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no local context")


def test_cluster_without_checkpoint_dir_refuses():
    with pytest.raises(RuntimeError):
        scratch_root(_ClusterSession({"spark.master": "spark://cluster:7077"}))


def test_cluster_checkpoint_dir_is_used():
    s = _ClusterSession({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert scratch_root(s) == "hdfs:///shared/ckpt"
    a, b = fresh_dir(s, "x"), fresh_dir(s, "x")
    assert a.startswith("hdfs:///shared/ckpt/tallyho/x-") and a != b


def test_local_session_has_a_root(spark):
    assert scratch_root(spark)
