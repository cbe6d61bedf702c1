"""Session settings and the shared folder."""

from __future__ import annotations

import os

from shelfmark import session


def test_shuffles_are_sized_by_the_input_and_only_raised(spark):
    folder = "/root/testdata/sf0.001"
    size = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder))
    assert session.stored_bytes(spark, folder) == size
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.size_shuffles(spark, size)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        with session.sized_shuffles(spark, 2**32):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        session.size_shuffles(spark, 100 * 2**40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(session.MOST_PARTITIONS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


class Cluster:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, folder=None):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master})()


def test_the_folder_is_the_one_the_cluster_names():
    assert session.shared_folder(Cluster("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert session.shared_folder(Cluster("local[2]", "/named")) == "/named"


def test_a_cluster_without_a_folder_gets_none():
    assert session.shared_folder(Cluster("spark://host:7077")) is None
    assert session.shared_folder(Cluster("yarn")) is None


def test_skew_handling_is_on(spark):
    for name, value in session.SETTINGS.items():
        assert spark.conf.get(name) == value


def test_tasks_get_a_small_share_of_large_tables(spark):
    for name, most in (("spark.sql.files.maxPartitionBytes", 32), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 16)):
        assert spark.conf.get(name) == f"{most}m"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.size_shuffles(spark, 2**32, 16 * 2**20)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "256"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_of_one_file_are_spread_over_the_cores(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    spread = session.spread(spark.read.parquet(f"{tmp_path}/t"))
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in spread.collect()) == list(range(1000))
    assert session.spread(spread) is spread
