"""Staging: where intermediate tables go and when they are deleted."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tillflow.sources import writers


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = _Context(master), conf


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        writers.ensure_checkpoint_dir(_Session(master))
    named = _Session(master, **{"spark.checkpoint.dir": "hdfs:///stages"})
    writers.ensure_checkpoint_dir(named)
    assert named.sparkContext.folder == "hdfs:///stages"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_session_may_do_without(master):
    session = _Session(master)
    writers.ensure_checkpoint_dir(session)
    assert os.path.isdir(session.sparkContext.folder)


def _folders(spark):
    writers.ensure_checkpoint_dir(spark)
    return set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))


def test_stages_go_with_their_block(spark):
    before = _folders(spark)
    with writers.Stages(spark) as stages:
        table = stages.materialise(spark.range(100))
        result = writers.materialise(table.agg(F.sum("id").alias("total")))
        assert len(_folders(spark) - before) == 2
    assert len(_folders(spark) - before) == 1
    assert result.first().total == 4950
    before = _folders(spark)
    with pytest.raises(ValueError), writers.Stages(spark) as stages:
        stages.materialise(spark.range(10))
        raise ValueError
    assert _folders(spark) == before


def test_threads_leave_the_session_as_it_was(spark):
    before = spark.conf.get(writers._CLEANUP)
    threads = [threading.Thread(target=writers.stage, args=(spark.range(1000).repartition(4),)) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert spark.conf.get(writers._CLEANUP) == before and not writers._writing
