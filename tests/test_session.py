from __future__ import annotations

import pytest

from ledgermill import session


class _Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" and self.folder else default


class _Session:
    """Stands for a session of a cluster, which a test cannot have."""

    def __init__(self, master, folder=None):
        self.conf = _Conf(folder)
        self.sparkContext = type("Context", (), {"master": master})()


def test_the_folder_of_the_cluster_is_used():
    assert session.shared_dir(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_dir(_Session("local[8]", "/shared")) == "/shared"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session("spark://host:7077"))


def test_stored_frames_read_back(spark):
    frames = session.all_stored({"a": spark.range(3).toDF("id"), "b": spark.range(5).toDF("id")})
    assert (frames["a"].count(), frames["b"].count()) == (3, 5)
