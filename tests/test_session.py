import pytest

from textloom import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class _Session:
    def __init__(self, value):
        self.conf = _Conf(value)
        self.sparkContext = type("C", (), {"applicationId": "app-1", "master": "local[2]"})()


def test_named_folder_is_used():
    assert session.shared_dir(_Session("hdfs:///shared/")) == "hdfs:///shared"


def test_own_folder_only_without_a_name():
    first = session.shared_dir(_Session(None))
    assert first == session.shared_dir(_Session(None)) and "textloom-" in first
    assert session.new_table_path(_Session(None), "t") != session.new_table_path(_Session(None), "t")


def test_a_cluster_has_to_name_its_folder():
    spark = _Session(None)
    spark.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError):
        session.shared_dir(spark)


def test_spread_follows_the_setting(spark):
    few = spark.range(0, 10, 1, 1)
    assert session.spread(few).rdd.getNumPartitions() == 8
    spark.conf.unset("spark.textloom.inputPartitions")
    assert session.spread(few) is few
    spark.conf.set("spark.textloom.inputPartitions", "8")
