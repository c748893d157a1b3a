from types import SimpleNamespace

import pytest

from quire.session import shared_folder


def fake(master, settings, checkpoint=None):
    conf = SimpleNamespace(get=lambda k, d=None: settings.get(k, d), set=settings.__setitem__)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_folder(fake("yarn", {"spark.checkpoint.dir": "hdfs:/x"})) == "hdfs:/x"
    assert shared_folder(fake("yarn", {}, "hdfs:/y")) == "hdfs:/y"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_folder(fake("yarn", {}))


def test_a_local_session_makes_its_own_once():
    local = fake("local[2]", {})
    assert shared_folder(local) == shared_folder(local)
