from types import SimpleNamespace

import pytest

from panelloom.session import shared_checkpoints


def session(master, conf=None, set_already=False):
    made = []
    jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: set_already)))
    context = SimpleNamespace(master=master, _jsc=jsc, setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: conf or default)), made


def test_the_clusters_folder_is_taken():
    s, made = session("spark://host:7077", "hdfs:///shared")
    shared_checkpoints(s)
    assert made == ["hdfs:///shared"]


def test_a_cluster_without_a_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        s, made = session(master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_checkpoints(s)
        assert made == []


def test_a_local_session_gets_a_folder_once():
    s, made = session("local[4]")
    shared_checkpoints(s)
    assert len(made) == 1
    s, made = session("local[4]", set_already=True)
    shared_checkpoints(s)
    assert made == []
