"""The whole run: Bronze in, stored Silver and Gold out.

Every step replaces what it writes and reads only what is already stored, so a
run that broke off is simply started again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions.dates import AsOf
from ..operators.surrogate import with_position_key
from ..schemas import KEYS
from ..session import sized_shuffles
from ..sources.bronze import Bronze
from ..sources.layers import CatalogLayers, PathLayers, publish_views, stamped
from . import gold, view_sql
from .silver import STORED_AS, Silver


def gold_views(silver: dict[str, DataFrame], as_of: AsOf) -> dict[str, DataFrame]:
    """The seven outputs that are computed when asked for."""
    customers, books = silver["dim_customers"], silver["dim_books"]
    orders, items = silver["fact_orders"], silver["fact_order_items"]
    reviews = silver["fact_reviews"]
    return {
        "vw_sales_by_category": gold.sales_by_category(items, orders, books),
        "vw_top_selling_books": gold.top_selling_books(books, items, orders, reviews),
        "vw_customer_analytics": gold.customer_analytics(
            customers, orders, items, reviews, as_of
        ),
        "vw_sales_over_time": gold.sales_over_time(orders, items),
        "vw_payment_analysis": gold.payment_analysis(orders),
        "vw_geographic_analysis": gold.geographic_analysis(customers, orders, items),
        "vw_review_analytics": gold.review_analytics(books, reviews),
    }


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The two outputs that are stored."""
    orders, items = silver["fact_orders"], silver["fact_order_items"]
    authors = gold.author_performance(silver["dim_books"], items, silver["fact_reviews"])
    return {
        "agg_daily_metrics": gold.daily_metrics(orders, items),
        "agg_author_performance": gold.author_performance_table(authors),
    }


def rebuild(
    bronze: Bronze,
    as_of: dt.date,
    run_time: dt.datetime,
    layers: PathLayers | CatalogLayers,
    lenient: bool = False,
    input_bytes: int = 0,
) -> dict[str, DataFrame]:
    """Write Silver (stamped, in the order of its keys) and the Gold tables, publish the views.

    Each table is written once.  Its rows are numbered by their places in the stored files
    whenever it is read with its key, in a catalog by the view ``<table>_keyed``.  A catalog
    keeps the views as well.
    ``input_bytes``, the stored size of the raw tables, sizes the shuffles.
    """
    with sized_shuffles(layers.spark, input_bytes):
        stored = _written(bronze, as_of, run_time, layers, lenient)
    views = gold_views({name: stored[name] for name in STORED_AS.values()}, as_of)
    publish_views(views)
    if isinstance(layers, CatalogLayers):
        layers.store_views("gold", view_sql.statements(layers.database("silver"), as_of))
    return stored | views


def _written(
    bronze: Bronze,
    as_of: dt.date,
    run_time: dt.datetime,
    layers: PathLayers | CatalogLayers,
    lenient: bool,
) -> dict[str, DataFrame]:
    silver = Silver(bronze, as_of, layers, lenient=lenient, run_time=run_time)
    stored = {}
    for short, name in STORED_AS.items():
        stored[name] = with_position_key(getattr(silver, short), KEYS[name][0])
        if isinstance(layers, CatalogLayers):
            layers.publish_keyed("silver", name, KEYS[name][0])
    for name, df in gold_tables(stored).items():
        stored[name] = layers.write("gold", name, stamped(df, run_time))
    return stored
