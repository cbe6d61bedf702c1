"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import gold
from shelfmark.plans.silver import Silver
from shelfmark.sources.commerce import AS_OF, bronze_from
from verification.cases import QUERIES

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Plan after adaptive execution has run it."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    from shelfmark.sources.layers import PathLayers

    root = str(tmp_path_factory.mktemp("layers"))
    return Silver(bronze_from(spark, FOLDER), AS_OF, PathLayers(spark, root))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_no_pair_products(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert "CartesianProduct" not in plan
    # Only a one-row or per-bucket side may be joined without a key.
    assert "BroadcastNestedLoopJoin" not in plan


def test_customers_are_limited_to_one_row_each_before_the_shuffle(spark):
    raw = bronze_from(spark, FOLDER)
    from shelfmark.operators.dedup import keep_first

    plan = physical(keep_first(raw.customers, "customer_id", ["created_at"]))
    above, below = plan.split("Exchange hashpartitioning(customer_id", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_filters_and_columns_reach_the_scan(silver):
    plan = physical(gold.payment_analysis(silver.orders))
    scans = re.findall(r"FileScan parquet \[(.*?)\].*?PushedFilters: \[(.*?)\]", plan)
    assert scans
    for columns, filters in scans:
        assert "net_amount" not in columns and "shipping_cost" not in columns
        assert "EqualTo(is_valid_order,true)" in filters


def test_items_cross_the_network_once_for_book_sales(spark, silver):
    """Grouping by (order, book) reuses the partitioning of the order join."""
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false",
        },
    ):
        plan = physical(gold._items_per_book(silver.items, gold.completed_sales(silver.orders)))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert sorted(keys) == ["book_id", "order_id", "order_id"]


def test_category_sales_count_orders_on_the_order_join(spark, silver):
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false",
        },
    ):
        plan = physical(gold.sales_by_category(silver.items, silver.orders, silver.books))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert sorted(re.sub(r"#\d+", "", k) for k in keys) == [
        "book_id", "book_id", "category", "order_id", "order_id",
    ]


def test_facts_are_grouped_before_they_are_joined(spark, silver):
    """No join of the customer output sees item rows next to review rows."""
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false",
        },
    ):
        df = gold.customer_analytics(silver.customers, silver.orders, silver.items, silver.reviews, AS_OF)
        plan = physical(df)
    # Every exchange on customer_id other than the dimension's carries partial sums.
    for part in plan.split("Exchange hashpartitioning(customer_id")[1:]:
        following = part.splitlines()[1]
        assert "HashAggregate" in following or "Filter isnotnull(customer_id" in following


SPLIT_SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30000",
}


def test_hot_parent_key_is_split_in_reference_checks(spark):
    """A third of the children name one parent, another third a missing one."""
    from shelfmark.operators.referential import keep_referenced, orphans

    n = 60_000
    pick = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("lost"))
    children = (
        spark.range(n)
        .select(
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
            pick.otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"),
        )
        .repartition(16)
    )
    parents = spark.range(900).select(F.concat(F.lit("k"), "id").alias("k"))
    parents = parents.unionByName(spark.createDataFrame([("hot",)], "k string")).repartition(4)
    with conf(spark, **SPLIT_SMALL):
        kept, lost = keep_referenced(children, parents, "k"), orphans(children, parents, "k")
        assert "skew=true" in final_plan(kept) and "skew=true" in final_plan(lost)
        assert kept.count() == 2 * n // 3 and lost.count() == n // 3


def test_hot_join_key_is_split_and_the_result_stays_whole(spark):
    """A third of all items share one order."""
    n = 60_000
    items = spark.range(n).select(
        F.concat(F.lit("I"), "id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, F.lit("O0"))
        .otherwise(F.concat(F.lit("O"), F.col("id") % 5000))
        .alias("order_id"),
        F.concat(F.lit("B"), F.col("id") % 97).alias("book_id"),
        F.lit(2).alias("quantity"),
        F.lit("1.50").cast("decimal(10,2)").alias("calculated_subtotal"),
    )
    orders = spark.range(5000).select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        (F.col("id") % 2 == 0).alias("is_valid_order"),
        F.lit("Entregue").alias("order_status"),
    )
    with conf(spark, **SPLIT_SMALL):
        sales = gold._items_per_book(items.repartition(16), gold.completed_sales(orders))
        plan = final_plan(sales)
        assert "skew=true" in plan
        totals = sales.agg(F.sum("item_rows"), F.sum("copies"), F.sum("revenue")).first()
    assert (totals[0], totals[1], float(totals[2])) == (n, 2 * n, 1.5 * n)
