"""Registered queries over tables that are folders of part files, and over ones that grow."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from verification.cases import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The given tables as folders of several files."""
    home = str(tmp_path_factory.mktemp("parts"))
    for name in TABLES:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(3).write.parquet(
            f"{home}/{name}.parquet"
        )
    return home


@pytest.mark.parametrize(
    ("streamed", "batch"),
    [("stream_raw_reviews", "raw_reviews"), ("stream_fact_orders", "fact_orders"),
     ("stream_fact_reviews", "fact_reviews")],
)
def test_streams_read_files_and_folders_whole(spark, parts, streamed, batch):
    wanted = QUERIES[batch](spark, FOLDER).count()
    assert wanted > 0
    for folder in (FOLDER, parts):
        assert QUERIES[streamed](spark, folder).count() == wanted


def test_stream_of_keys_reads_folders_whole(spark, parts):
    wanted = {r[0] for r in QUERIES["stream_customer_keys"](spark, FOLDER).collect()}
    assert wanted and {r[0] for r in QUERIES["stream_customer_keys"](spark, parts).collect()} == wanted


def test_a_folder_that_grew_is_read_anew(spark, parts):
    before = QUERIES["raw_orders"](spark, parts).count()
    silver = QUERIES["fact_orders"](spark, parts).count()
    more = spark.read.parquet(f"{FOLDER}/orders.parquet")
    more.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000).write.mode("append").parquet(
        f"{parts}/orders.parquet"
    )
    assert QUERIES["raw_orders"](spark, parts).count() == 2 * before
    assert QUERIES["fact_orders"](spark, parts).count() > silver
