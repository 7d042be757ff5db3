"""Scratch folders: shared or nothing."""

from types import SimpleNamespace

import pytest

from stayledger import session as S


class FakeContext(SimpleNamespace):
    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


def fake(master, checkpoint=None, conf=None):
    get = lambda key, default=None: (conf or {}).get(key, default)
    return SimpleNamespace(sparkContext=FakeContext(master=master, checkpoint=checkpoint), conf=SimpleNamespace(get=get))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_raises(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_root(fake(master))


def test_the_named_folder_is_used():
    assert S.shared_root(fake("yarn", "hdfs://x/ck/app")) == "hdfs://x/ck/app"
    assert S.shared_root(fake("yarn", None, {"spark.checkpoint.dir": "hdfs://x/ck/"})) == "hdfs://x/ck"


def test_a_local_session_gets_a_folder_of_its_own():
    s = fake("local[2]")
    assert S.shared_root(s) == s.sparkContext.checkpoint


def test_errors_of_the_file_system_are_not_swallowed(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        S.path_exists(spark, "nosuchscheme://x/y")
