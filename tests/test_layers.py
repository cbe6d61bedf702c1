"""Landing, writing and reading tables."""

from __future__ import annotations

import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.surrogate import with_position_key
from shelfmark.plans import gold, monthly
from shelfmark.plans.rebuild import rebuild
from shelfmark.plans.silver import Silver, keyed
from shelfmark.schemas import KEYS, RAW, SILVER
from shelfmark.sources import bronze
from shelfmark.sources.layers import CatalogLayers, PathLayers, conform, publish_views, stamped
from shelfmark.sources.quarantine import Quarantine

from . import fixture_rows as rows

LOADED = dt.datetime(2025, 6, 1, 12)
ITEM = ("X1", "O1", "B1", "two", "-1", "n/a")


def test_files_land_as_text_whatever_they_hold(spark, tmp_path):
    lines = ["order_item_id,order_id,book_id,quantity,unit_price,subtotal", "X1,O1,B1,two,-1,n/a"]
    (tmp_path / "items.csv").write_text("\n".join(lines))
    (tmp_path / "items.json").write_text('{"order_item_id":"X1","quantity":2,"unit_price":1.50}\n')
    csv = bronze.read_raw(
        spark, "raw_order_items", str(tmp_path / "items.csv"), LOADED, "csv", header="true"
    )
    assert csv.dtypes == [(f.name, f.dataType.simpleString()) for f in RAW["raw_order_items"]]
    assert tuple(csv.first()) == (*ITEM, LOADED)
    js = bronze.read_raw(spark, "raw_order_items", str(tmp_path / "items.json"), LOADED, "json")
    assert tuple(js.first()) == ("X1", None, None, "2", "1.50", None, LOADED)


def test_typed_files_land_as_text_and_missing_columns_are_null(spark, tmp_path):
    spark.createDataFrame([("X1", 3, 1.5)], "order_item_id string, quantity int, extra double").write.parquet(
        str(tmp_path / "p")
    )
    df = bronze.read_raw(spark, "raw_order_items", str(tmp_path / "p"), LOADED, "parquet")
    assert df.columns == RAW["raw_order_items"].names
    assert tuple(df.first())[:4] == ("X1", None, None, "3")


def test_deliveries_append(spark, tmp_path):
    df = bronze.rows_as_raw(spark, "raw_order_items", [ITEM], LOADED)
    for _ in range(2):
        bronze.append_raw(df, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def small_bronze(spark):
    def raw(name, data):
        return bronze.rows_as_raw(spark, name, data, rows.LOADED)

    return bronze.Bronze(
        raw("raw_customers", rows.CUSTOMERS),
        raw("raw_books", rows.BOOKS),
        raw("raw_orders", rows.ORDERS),
        raw("raw_order_items", rows.ITEMS),
        raw("raw_reviews", rows.REVIEWS),
    )


def test_stored_silver_equals_the_views_and_can_be_rebuilt(spark, tmp_path):
    raw = small_bronze(spark)
    layers = PathLayers(spark, str(tmp_path))
    views = Silver(raw, rows.AS_OF).tables()
    for _ in range(2):
        stored = Silver(raw, rows.AS_OF, layers).tables()
        for name, df in stored.items():
            assert df.exceptAll(views[name]).isEmpty() and views[name].exceptAll(df).isEmpty()
    declared = {name: dict(df.dtypes) for name, df in stored.items()}
    assert declared["orders"] == SILVER["fact_orders"]
    assert layers.read("silver", "fact_orders").count() == 12


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_whole_run_can_be_repeated(spark, tmp_path, kind):
    run_time = dt.datetime(2025, 6, 30, 2)
    raw = small_bronze(spark)
    for _ in range(2):
        where = PathLayers(spark, str(tmp_path)) if kind == "path" else CatalogLayers(spark)
        stored = rebuild(raw, rows.AS_OF, run_time, where)
    assert where.read("silver", "dim_customers").count() == 10
    authors = where.read("gold", "agg_author_performance")
    assert authors.where("author_id = 1").first().author_name == "J.R.R. Tolkien"
    assert authors.columns[-2:] == ["created_at", "updated_at"]
    assert stored["agg_daily_metrics"].count() == 10
    assert spark.table("vw_customer_analytics").count() == 8
    assert spark.sql("SELECT sum(total_revenue) FROM vw_sales_by_category").first()[0] == Decimal("1293.00")
    if kind == "catalog":
        invalid = spark.sql("SELECT order_id FROM silver_layer.fact_orders WHERE is_valid_order = FALSE")
        assert {r.order_id for r in invalid.collect()} == {"ORD005", "ORD007"}
        top = spark.sql("SELECT * FROM gold_layer.agg_author_performance ORDER BY author_id LIMIT 5")
        assert [r.author_id for r in top.collect()] == [1, 2, 3, 4, 5]


def test_a_lost_stored_table_is_noticed(spark, tmp_path):
    silver = Silver(small_bronze(spark), rows.AS_OF, PathLayers(spark, str(tmp_path / "a")))
    assert silver.is_intact()
    assert silver.orders.count() == 12 and silver.is_intact()
    silver.layers = PathLayers(spark, str(tmp_path / "elsewhere"))
    assert not silver.is_intact()


def test_keyed_table_has_dense_keys_and_audit_columns(spark):
    run_time = dt.datetime(2025, 6, 30, 1)
    silver = Silver(small_bronze(spark), rows.AS_OF)
    for table, df in {"dim_customers": silver.customers, "fact_orders": silver.orders}.items():
        done = keyed(table, df, run_time)
        surrogate, _ = KEYS[table]
        assert done.columns == [surrogate, *SILVER[table], "created_at", "updated_at"]
        got = done.agg(F.min(surrogate), F.max(surrogate), F.countDistinct(surrogate), F.count("*")).first()
        assert got[0] == 1 and got[1] == got[2] == got[3]
        assert done.select("created_at", "updated_at").distinct().collect() == [(run_time, run_time)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_follow_file_positions_without_moving_rows(spark, tmp_path):
    ids = [(f"O{k:03d}", k) for k in (5, 3, 9, 1, 7, 2, 8, 4, 6, 0) for _ in range(1 + (k == 4))]
    df = spark.createDataFrame(ids, "order_id string, n int").repartition(4)
    stored = PathLayers(spark, str(tmp_path)).write("silver", "t", df, order_by=["order_id"])
    numbered = with_position_key(stored, "order_key")
    assert numbered.columns == ["order_key", "order_id", "n"]
    got = sorted(numbered.collect())
    assert [r.order_key for r in got] == list(range(1, 12))
    assert [r.order_id for r in got] == sorted(k for k, _ in ids)
    scan, _, _ = plan_of(numbered).partition("BroadcastExchange")
    assert "Exchange" not in scan and "Sort" not in scan
    assert with_position_key(stored.limit(0), "k").count() == 0


def test_another_session_reads_keyed_tables(spark):
    raw = small_bronze(spark)
    rebuild(raw, rows.AS_OF, dt.datetime(2025, 6, 30, 2), CatalogLayers(spark, "keyed_{layer}"))
    other = spark.newSession()
    got = other.table("keyed_silver.dim_customers_keyed").orderBy("customer_key").collect()
    assert [r.customer_key for r in got] == list(range(1, 11))
    assert [r.customer_id for r in got] == sorted(r.customer_id for r in got)
    assert other.table("keyed_silver.fact_orders_keyed").columns[0] == "order_key"
    assert "keyed_staging.fact_orders" not in {f"keyed_staging.{t.name}" for t in spark.catalog.listTables("keyed_staging")}


def test_another_session_reads_the_views(spark):
    layers = CatalogLayers(spark, "views_{layer}")
    stored = rebuild(small_bronze(spark), rows.AS_OF, dt.datetime(2025, 6, 30, 2), layers)
    other = spark.newSession()
    names = [name for name in stored if name.startswith("vw_")]
    assert len(names) == 7
    for name in names:
        kept, built = other.table(f"views_gold.{name}"), stored[name]
        assert kept.dtypes == built.dtypes, name
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, built.collect())), name
    assert "CREATE" in other.sql("SHOW CREATE TABLE views_gold.vw_payment_analysis").first()[0]


def files_by_month(root: str) -> dict[str, set[str]]:
    found: dict[str, set[str]] = {}
    for path in glob.glob(f"{root}/order_month=*/*.parquet"):
        found.setdefault(path.split("order_month=")[1].split("/")[0], set()).add(path)
    return found


def test_a_month_is_run_again_alone(spark, tmp_path):
    silver = Silver(small_bronze(spark), rows.AS_OF)
    layers = PathLayers(spark, str(tmp_path))
    orders, daily = monthly.run_months(silver.orders, silver.items, layers)
    before = {t: files_by_month(layers.location(*t)) for t in (("silver", monthly.ORDERS), ("gold", monthly.DAILY))}
    months = set(before["silver", monthly.ORDERS])
    assert "2024-06" in months and monthly.UNDATED in months
    assert all(len(files) == 1 for files in before["silver", monthly.ORDERS].values())
    again, daily_again = monthly.run_months(silver.orders, silver.items, layers, ["2024-06"])
    for table, old in before.items():
        new = files_by_month(layers.location(*table))
        assert set(new) == set(old)
        assert {m for m in old if old[m] != new[m]} == {"2024-06"}
    assert again.drop(monthly.MONTH).exceptAll(silver.orders).isEmpty() and again.count() == silver.orders.count()
    whole = gold.daily_metrics(silver.orders, silver.items)
    assert daily_again.drop(monthly.MONTH).exceptAll(whole).isEmpty() and daily_again.count() == whole.count()
    found = monthly.delivered_orders(again, "2024-06")
    assert found.exceptAll(gold.delivered_orders(silver.orders, "2024-06")).isEmpty()
    assert "PartitionFilters: [isnotnull(order_month" in plan_of(found)


def test_months_of_a_catalog_table(spark):
    silver = Silver(small_bronze(spark), rows.AS_OF)
    layers = CatalogLayers(spark, "monthly_{layer}")
    monthly.run_months(silver.orders, silver.items, layers)
    by_month, _ = monthly.run_months(silver.orders, silver.items, layers, ["2024-06"])
    assert by_month.count() == silver.orders.count()


def test_quarantined_rows_are_admitted_once_their_parents_arrive(spark, tmp_path):
    schema = "order_id string, customer_id string, book_id string"
    orders = spark.createDataFrame([("O1", "C1", "B1"), ("O2", "C2", "B1"), ("O3", "C1", "B9"), ("O4", None, "B1")], schema)
    place = Quarantine(spark, str(tmp_path / "q"), orders.schema)
    assert place.kept().count() == place.rejected().count() == 0
    books = spark.createDataFrame([("B1",), ("B1",), (None,)], "book_id string")

    def deliver(df, customers, number):
        known = spark.createDataFrame([(c,) for c in customers], "customer_id string")
        place.deliver(df, [(known, "customer_id"), (books, "book_id")], number)
        return (
            sorted(r.order_id for r in place.kept().collect()),
            sorted((r.order_id, *r.missing) for r in place.rejected().collect()),
        )

    first = (["O1"], [("O2", "customer_id"), ("O3", "book_id"), ("O4", "customer_id")])
    assert deliver(orders, ["C1"], 0) == first
    assert deliver(orders, ["C1"], 0) == first  # the same delivery again
    more = spark.createDataFrame([("O5", "C7", "B9")], schema)
    for _ in range(2):
        kept, rejected = deliver(more, ["C1", "C2"], 1)
        assert kept == ["O1", "O2"]
        assert rejected == [("O3", "book_id"), ("O4", "customer_id"), ("O5", "customer_id", "book_id")]


def test_catalog_tables_partitioned_and_bucketed(spark):
    silver = Silver(small_bronze(spark), rows.AS_OF)
    catalog = CatalogLayers(spark, "test_{layer}")
    month = F.date_format("order_date", "yyyy-MM").alias("order_month")
    by_month = catalog.write(
        "silver", "orders_by_month", silver.orders.select("*", month), partition_by=["order_month"]
    )
    june = by_month.where("order_month = '2024-06'")
    assert june.count() == 2
    assert "PartitionFilters: [isnotnull(order_month" in june._jdf.queryExecution().toString()

    orders = catalog.write("silver", "fact_orders", silver.orders, bucket_by=(4, "order_id"))
    items = catalog.write("silver", "fact_order_items", silver.items, bucket_by=(4, "order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = items.join(orders, "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 22
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Replacing a table leaves only the new rows.
    assert catalog.write("silver", "fact_orders", silver.orders.limit(3)).count() == 3


def test_views_can_be_published_and_replaced(spark):
    silver = Silver(small_bronze(spark), rows.AS_OF)
    outputs = {"vw_payments": gold.payment_analysis(silver.orders)}
    publish_views(outputs)
    publish_views(outputs)
    assert spark.sql("SELECT count(*) FROM vw_payments").first()[0] == 5


def test_conform_and_stamp(spark):
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    done = stamped(conform(df, {"a": "int", "b": "decimal(3,1)"}), LOADED)
    assert [t for _, t in done.dtypes] == ["int", "decimal(3,1)", "timestamp", "timestamp"]
    assert done.columns == ["a", "b", "created_at", "updated_at"]


def test_lines_that_do_not_fit_are_kept_whole(spark, tmp_path):
    lines = ["O1,I1,2", "O2,I2,3,beyond,more", "O3", 'O4,"I4, quoted",5', ""]
    (tmp_path / "a.csv").write_text("order_id,order_item_id,quantity\n" + "\n".join(lines))
    landed = bronze.read_raw(
        spark, "raw_order_items", str(tmp_path / "a.csv"), LOADED, "csv", raw_line="line", header="true"
    )
    assert landed.columns == [*RAW["raw_order_items"].names, "line"]
    got = {r.order_id: (r.order_item_id, r.quantity, r.line) for r in landed.collect()}
    assert got == {
        "O1": ("I1", "2", None),
        "O2": ("I2", "3", lines[1]),
        "O3": (None, None, "O3"),
        "O4": ("I4, quoted", "5", None),
    }
    (tmp_path / "b.json").write_text('{"order_id": "O1", "quantity": 2}\n{"order_id": broken\n')
    landed = bronze.read_raw(spark, "raw_order_items", str(tmp_path / "b.json"), LOADED, "json", raw_line="line")
    got = [(r.order_id, r.quantity, r.line) for r in landed.collect()]
    assert got == [("O1", "2", None), (None, None, '{"order_id": broken')]


def test_delimited_files_land_by_column_name(spark, tmp_path):
    """Another column order, a missing and an unknown column, short and over-long rows."""
    (tmp_path / "items.csv").write_text(
        "order_id,quantity,surprise,book_id,order_item_id\n"
        "O1,2,s,B1,I1\n"
        "O2,3\n"
        "O3,4,s,B3,I3,beyond,more\n"
    )
    landed = bronze.read_raw(spark, "raw_order_items", str(tmp_path), LOADED, "csv", header="true")
    assert landed.columns == [*bronze.text_schema("raw_order_items").names, "created_at"]
    got = landed.select("order_item_id", "order_id", "book_id", "quantity").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [
        ("I1", "O1", "B1", "2"),
        (None, "O2", None, "3"),
        ("I3", "O3", "B3", "4"),
    ]
    assert all(r[0] is None for r in landed.select("unit_price").collect())
