"""Checkpoint folder and package shipping."""

import pytest

from ratewise import session


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return _Conf()

    class _jsc:
        @staticmethod
        def sc():
            class S:
                @staticmethod
                def getCheckpointDir():
                    class O:
                        @staticmethod
                        def isDefined():
                            return False
                    return O
            return S


class _Session:
    sparkContext, conf = _Context(), _Conf()


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Session())


def test_single_machine_masters():
    assert all(map(session.is_single_machine, ["local", "local[4]", "local[*]", "local[2,3]"]))
    assert not any(map(session.is_single_machine, ["local-cluster[3,2,1000]", "yarn", "spark://h:7077"]))


def test_workers_import_the_shipped_package(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    names = spark.sparkContext.parallelize([0], 1).map(lambda _: __import__("ratewise.session").__name__).collect()
    assert names == ["ratewise"]
