import pytest

from biblioflow import session


class Conf:
    def get(self, *_):
        return None


class Cluster:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return Conf()


class Session:
    sparkContext, conf = Cluster(), Conf()


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
