"""Where intermediate tables go."""

import pytest

from stagelight.plans import shared


def test_written_tables_live_in_the_named_folder(spark):
    table = shared.written(spark.range(5), "five")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in path for path in table.inputFiles())
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]
    assert shared.shared_path(spark, "x") != shared.shared_path(spark, "x")


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    """A session without spark.checkpoint.dir."""

    def __init__(self, context):
        self.sparkContext, self.conf = context, {}


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError):
        shared.shared_folder(Session(Context("spark://host:7077")))


def test_a_folder_set_at_run_time_is_used():
    assert shared.shared_folder(Session(Context("yarn", "hdfs:///shared/"))) == "hdfs:///shared"


def test_local_sessions_fall_back_to_one_temporary_folder():
    session = Session(Context("local[2]"))
    assert shared.shared_folder(session) == shared.shared_folder(session)
