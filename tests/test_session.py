"""Scratch space comes from the cluster's checkpoint folder."""

import pytest

from vaultline.session import ensure_checkpoint_dir, scratch_path


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/vaultline/x-")
    # a configured folder is kept, never replaced
    assert ensure_checkpoint_dir(spark) == base


class _Spark:
    """A session of a cluster that names no shared folder."""
    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark)


def test_the_launcher_decides_the_master(monkeypatch):
    """Without a master argument the builder is told neither master nor memory."""
    from vaultline import session
    told = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, m):
            told["spark.master"] = m
            return self

        def config(self, k, v):
            told[k] = v
            return self

        def getOrCreate(self):
            raise StopIteration
    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    with pytest.raises(StopIteration):
        session.get_session()
    assert "spark.master" not in told and "spark.driver.memory" not in told
    with pytest.raises(StopIteration):
        session.get_session(master="local[2]")
    assert told["spark.master"] == "local[2]"
