"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_RUNS (default 3).  Each figure is the median of the warm runs.  Silver
builds start from the given tables; Gold and quality queries start from the
stored Silver tables.

``--chains`` also times the literal join chains that the pre-aggregated outputs
replace.  ``--skew`` also times the outputs on tables in which one book, one
order and one customer own a third of each fact.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

QUERIES = [
    "sales_by_category",
    "top_selling_books",
    "customer_analytics",
    "sales_over_time",
    "payment_analysis",
    "geographic_analysis",
    "review_analytics",
    "daily_metrics",
    "author_performance",
    "author_performance_table",
    "top_selling_books_grain_safe",
    "customer_analytics_grain_safe",
    "sales_over_time_grain_safe",
    "geographic_analysis_grain_safe",
    "daily_metrics_grain_safe",
    "author_performance_grain_safe",
    "top_n_books",
    "popular_book",
    "modal_category",
    "rfm_segment",
    "surrogate_keys",
    "dq_score_audit",
    "dq_issue_profile",
    "dq_orphans",
    "dq_duplicate_keys",
    "dq_kpis",
]

# The join chains as written by hand, for comparison only.
CHAINS = {
    "chain_top_selling_books": """
        SELECT b.book_id, count(DISTINCT o.order_id) n, sum(i.quantity) q,
               sum(i.calculated_subtotal) s, avg(r.rating) a, count(DISTINCT r.review_id) c
        FROM books b LEFT JOIN items i ON i.book_id = b.book_id
        LEFT JOIN (SELECT order_id FROM orders
                   WHERE is_valid_order AND order_status <> 'Cancelado') o ON o.order_id = i.order_id
        LEFT JOIN reviews r ON r.book_id = b.book_id GROUP BY b.book_id""",
    "chain_customer_analytics": """
        SELECT c.customer_id, count(DISTINCT o.order_id) n, sum(o.total_amount) s,
               count(DISTINCT i.book_id) d, sum(i.quantity) q, count(DISTINCT r.review_id) v,
               avg(r.rating) a, max(o.order_date) m
        FROM customers c
        LEFT JOIN (SELECT * FROM orders WHERE is_valid_order) o ON o.customer_id = c.customer_id
        LEFT JOIN items i ON i.order_id = o.order_id
        LEFT JOIN reviews r ON r.customer_id = c.customer_id GROUP BY c.customer_id""",
}


def skewed(tables):
    """The Silver tables with a third of each fact moved to one key."""
    from pyspark.sql import functions as F

    def moved(df, column, salt):
        third = F.pmod(F.xxhash64(df.columns[0], F.lit(salt)), F.lit(3)) == 0
        hot = df.agg(F.min(column)).scalar()
        return df.withColumn(column, F.when(third, hot).otherwise(F.col(column)))

    items, reviews = tables["items"], tables["reviews"]
    return {
        **tables,
        "items": moved(moved(items, "book_id", 1), "order_id", 2),
        "reviews": moved(moved(reviews, "book_id", 1), "customer_id", 2),
        "orders": moved(tables["orders"], "customer_id", 1),
    }


def main() -> None:
    from pyspark.sql import SparkSession

    from shelfmark.plans import gold
    from shelfmark.sources.layers import PathLayers

    from shelfmark.plans.silver import Silver
    from shelfmark.session import configure
    from shelfmark.sources.commerce import AS_OF, bronze_from
    from verification.cases import QUERIES as REGISTERED
    from verification.cases import Context

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def timed(build) -> float:
        consume(build())
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            consume(build())
            runs.append(time.perf_counter() - start)
        return round(statistics.median(runs), 3)

    took: dict[str, float] = {}
    bronze = bronze_from(spark, FOLDER)
    for name in ("customers", "books", "orders", "items", "reviews"):
        took[f"silver_{name}"] = timed(lambda n=name: getattr(Silver(bronze, AS_OF), n))
    stored = Context(spark, FOLDER).silver.tables()  # written once, then read
    for name in QUERIES:
        took[name] = timed(lambda n=name: REGISTERED[n](spark, FOLDER))
    total = round(sum(took.values()), 3)
    if "--chains" in sys.argv:
        for name, df in stored.items():
            df.createOrReplaceTempView(name)
        for name, sql in CHAINS.items():
            took[name] = timed(lambda s=sql: spark.sql(s))
    if "--skew" in sys.argv:
        layers = PathLayers(spark, f"{spark.conf.get('spark.checkpoint.dir')}/bench-skew")
        t = {n: layers.write("silver", n, df) for n, df in skewed(stored).items()}
        customers, books, orders, items, reviews = t.values()
        took |= {
            "skew_sales_by_category": timed(lambda: gold.sales_by_category(items, orders, books)),
            "skew_top_selling_books": timed(
                lambda: gold.top_selling_books(books, items, orders, reviews)
            ),
            "skew_customer_analytics": timed(
                lambda: gold.customer_analytics(customers, orders, items, reviews, AS_OF)
            ),
            "skew_author_performance": timed(
                lambda: gold.author_performance(books, items, reviews)
            ),
            "skew_geographic_analysis": timed(
                lambda: gold.geographic_analysis(customers, orders, items)
            ),
        }
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": total,
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
