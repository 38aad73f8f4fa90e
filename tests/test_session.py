from types import SimpleNamespace

import pytest

from reviewloom.session import ready_checkpoints, scratch_path, shared_folder


def session_with(conf, master="local[4]", folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)), sparkContext=context)


def test_shared_folder_follows_the_session():
    assert shared_folder(session_with({"spark.checkpoint.dir": "hdfs://shared/cp"})) == "hdfs://shared/cp"
    own = shared_folder(session_with({}))
    assert own == shared_folder(session_with({}))
    assert shared_folder(session_with({}, "spark://host:7077", "hdfs://set/cp")) == "hdfs://set/cp"


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[3,2,1024]", "yarn"])
def test_executors_elsewhere_need_a_shared_folder(master):
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session_with({}, master))


def test_scratch_paths_differ(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def test_checkpoints_are_ready(spark):
    ready_checkpoints(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
