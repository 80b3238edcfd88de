from __future__ import annotations

import pytest

from weftline import storage


class _Context:
    """Stands for a SparkContext with or without a checkpoint folder."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, context, **conf):
        self.sparkContext = context
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: conf.get(key.replace(".", "_"), default))})


def test_cluster_setting_is_used():
    session = _Session(_Context("yarn"), spark_checkpoint_dir="hdfs:///shared")
    assert storage.shared_dir(session) == "hdfs:///shared" == session.sparkContext.folder


def test_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError):
        storage.shared_dir(_Session(_Context("spark://host:7077")))


def test_local_session_keeps_one_folder():
    session = _Session(_Context("local[2]"))
    assert storage.shared_dir(session) == storage.shared_dir(session)


def test_cut_drops_the_lineage(spark, rows):
    df = storage.cut(spark.range(5).selectExpr("id * 2 AS x"))
    assert "Range" not in df._jdf.queryExecution().toString() and rows(df) == [(0,), (2,), (4,), (6,), (8,)]
    assert storage.scratch_path(spark, "a") != storage.scratch_path(spark, "a")
