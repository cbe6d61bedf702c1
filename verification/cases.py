"""Registered queries: one per operator, over the whole of the given tables.

The Silver tables are written once per session and folder, to the folder the
cluster shares (``spark.checkpoint.dir``), and Gold queries start from them.
Where the cluster names no such folder they are views over the raw feeds.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import canonical, dates, numbers, rules, scores, segments, text
from shelfmark.operators import aggregates, bitmaps, dedup, mapping, ranking, surrogate
from shelfmark.plans import gold, gold_by_grain, monthly, originals, quality, view_sql
from shelfmark.plans.silver import Silver
from shelfmark.session import configure, listing, shared_folder, size_shuffles
from shelfmark.sources import bronze, commerce
from shelfmark.sources.bronze import Bronze
from shelfmark.sources.commerce import AS_OF, bronze_from, read_table
from shelfmark.sources.layers import CatalogLayers, PathLayers
from shelfmark.sources.quarantine import Quarantine
from shelfmark.streaming import ingest, merge

c = F.col
_LAYERS: dict[tuple, Silver] = {}


@dataclass
class Context:
    """What a query may start from."""

    spark: SparkSession
    folder: str

    @property
    def silver(self) -> Silver:
        shared = shared_folder(self.spark)
        # A folder whose files have changed since is another input.
        files = listing(self.spark, self.folder)
        key = (self.spark.sparkContext.applicationId, shared, self.folder, files)
        if key not in _LAYERS or not _LAYERS[key].is_intact():
            name = f"{key[0]}/{self.folder.strip('/').replace('/', '_')}-{uuid.uuid4().hex}"
            layers = PathLayers(self.spark, f"{shared}/{name}") if shared else None
            size_shuffles(self.spark, files[1] or 0, 16 * 1024 * 1024)
            _LAYERS[key] = Silver(bronze_from(self.spark, self.folder), AS_OF, layers)
        return _LAYERS[key]

    @property
    def bronze(self) -> Bronze:
        return self.silver.bronze


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, so that the value a client
    sees does not depend on the engine's own client types."""

    def shown(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return c(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c(field.name).cast("string").alias(field.name)
        return c(field.name)

    return df.select([shown(f) for f in df.schema])


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[Context], DataFrame]) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(build(Context(configure(spark), folder)))

    run.__name__ = name
    QUERIES[name] = run


def cleaned(name: str, table: str, key: str, build: Callable[[], Column]) -> None:
    """A column rule over every row of a raw table."""
    register(name, lambda x: x.bronze.tables()[table].select(key, build().alias(name)))


# --- raw feeds -----------------------------------------------------------------
for _table in ("customers", "books", "orders", "items", "reviews"):
    register(f"raw_{_table}", lambda x, t=_table: x.bronze.tables()[t].drop("created_at"))



def _landed_lines(x: Context) -> DataFrame:
    """Orders delivered as lines, some with fields too many or too few, and landed again."""
    orders, path = x.bronze.orders, f"{_stream_folder(x)}/delivered"
    fields = [F.coalesce(c(f), F.lit("")) for f in bronze.text_schema("raw_orders").names]
    number = F.substring("order_id", 2, 18).cast("bigint")
    line = (
        F.when(F.pmod(number, F.lit(7)) == 0, F.concat_ws(",", *fields, F.lit("beyond")))
        .when(F.pmod(number, F.lit(11)) == 0, F.concat_ws(",", *fields[:3]))
        .otherwise(F.concat_ws(",", *fields))
    )
    orders.select(line).write.text(path)
    landed = bronze.read_raw(x.spark, "raw_orders", path, dt.datetime(2001, 1, 1), "csv", raw_line="raw_line")
    return landed.select("order_id", "total_amount", "payment_method", "raw_line")


register("raw_lines_kept", lambda x: _landed_lines(x))

# --- column rules ----------------------------------------------------------------
for _name, _table, _key, _build in [
    ("clean_name", "customers", "customer_id", lambda: text.clean_name(c("full_name"))),
    ("clean_email", "customers", "customer_id", lambda: text.clean_email(c("email"))),
    ("valid_email", "customers", "customer_id", lambda: text.is_valid_email(c("email"))),
    ("clean_phone", "customers", "customer_id", lambda: text.clean_phone(c("phone"))),
    ("parse_registration_date", "customers", "customer_id",
     lambda: dates.registration_date(c("registration_date"))),
    ("parse_birth_date", "customers", "customer_id", lambda: dates.birth_date(c("birth_date"))),
    ("age_years", "customers", "customer_id",
     lambda: dates.age_in_years(dates.birth_date(c("birth_date")), AS_OF)),
    ("city_case", "customers", "customer_id", lambda: text.sentence_case(c("city"))),
    ("state_code", "customers", "customer_id", lambda: text.state_code(c("state"))),
    ("canonical_country", "customers", "customer_id", lambda: canonical.country(c("country"))),
    ("score_customers", "customers", "customer_id", lambda: scores.customer_score(c)),
    ("canonical_category", "books", "book_id", lambda: canonical.category(c("category"))),
    ("canonical_language", "books", "book_id", lambda: canonical.language(c("language_code"))),
    ("valid_year", "books", "book_id", lambda: numbers.valid_year(c("publication_year"), AS_OF)),
    ("money_or_null", "books", "book_id", lambda: numbers.non_negative_money(c("price"))),
    ("count_or_zero", "books", "book_id", lambda: numbers.count_or_zero(c("stock_quantity"))),
    ("positive_pages", "books", "book_id", lambda: numbers.positive_count_or(c("pages"), None)),
    ("catalogue_rating", "books", "book_id", lambda: numbers.catalogue_rating(c("rating"))),
    ("availability", "books", "book_id",
     lambda: rules.is_available(c("stock_quantity"), c("price"))),
    ("score_books", "books", "book_id", lambda: scores.book_score(c, AS_OF)),
    ("parse_order_date", "orders", "order_id", lambda: dates.order_date(c("order_date"), AS_OF)),
    ("canonical_status", "orders", "order_id", lambda: canonical.order_status(c("order_status"))),
    ("canonical_payment", "orders", "order_id",
     lambda: canonical.payment_method(c("payment_method"))),
    ("money_or_zero", "orders", "order_id", lambda: numbers.money_or_zero(c("shipping_cost"))),
    ("net_amount", "orders", "order_id",
     lambda: rules.net_amount(c("total_amount"), c("shipping_cost"), c("discount_applied"))),
    ("order_validity", "orders", "order_id",
     lambda: rules.is_valid_order(c("total_amount"), c("order_date"), AS_OF)),
    ("score_orders", "orders", "order_id", lambda: scores.order_score(c)),
    ("quantity_or_one", "items", "order_item_id",
     lambda: numbers.positive_count_or(c("quantity"), 1)),
    ("calculated_subtotal", "items", "order_item_id",
     lambda: rules.calculated_subtotal(c("quantity"), c("unit_price"))),
    ("subtotal_check", "items", "order_item_id",
     lambda: rules.subtotal_matches(c("subtotal"), c("quantity"), c("unit_price"))),
    ("review_rating", "reviews", "review_id", lambda: numbers.review_rating(c("rating"))),
    ("parse_review_date", "reviews", "review_id",
     lambda: dates.review_date(c("review_date"), AS_OF)),
    ("review_length", "reviews", "review_id", lambda: text.text_length(c("review_text"))),
    ("review_validity", "reviews", "review_id",
     lambda: rules.is_valid_review(c("rating"), c("review_text"), c("review_date"))),
    ("review_validity_strict", "reviews", "review_id",
     lambda: rules.is_valid_review(c("rating"), c("review_text"), c("review_date"), AS_OF)),
]:
    cleaned(_name, _table, _key, _build)

for _name, _table, _key, _field in [
    ("canonical_country", "customers", "customer_id", "country"),
    ("canonical_category", "books", "book_id", "category"),
    ("canonical_status", "orders", "order_id", "order_status"),
    ("canonical_language", "books", "book_id", "language_code"),
    ("canonical_payment", "orders", "order_id", "payment_method"),
]:
    register(
        f"mapped_{_name}",
        lambda x, n=_name, t=_table, k=_key, f=_field: mapping.with_canonical(
            x.bronze.tables()[t].select(k, f), mapping.known_spellings(x.spark), f, n
        ).select(k, n),
    )

# --- Silver ------------------------------------------------------------------------
register(
    "dedup_customers",
    lambda x: dedup.keep_first(x.bronze.customers, "customer_id", ["created_at"]).drop(
        "created_at"
    ),
)
register("dim_customers", lambda x: x.silver.customers)
register("dim_books", lambda x: x.silver.books)
register("fact_orders", lambda x: x.silver.orders)
register("fact_order_items", lambda x: x.silver.items)
register("fact_reviews", lambda x: x.silver.reviews)


def _own_layers(x: Context) -> PathLayers:
    """A new place for the tables of one call."""
    return PathLayers(x.spark, f"{_stream_folder(x)}/layers")


def _keys_by_position(x: Context) -> DataFrame:
    """Every order's key, by its place in files written in the order of the ids."""
    stored = _own_layers(x).write("silver", "fact_orders", x.silver.orders, order_by=["order_id"])
    return surrogate.with_position_key(stored, "order_key").select("order_id", "order_key")


def _hashed_keys(x: Context) -> DataFrame:
    """Keys by buckets of the id are dense as well: 1..N, each once."""
    keyed = surrogate.with_surrogate_key(x.silver.orders.select("order_id"), "order_key", "order_id")
    return keyed.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct("order_key").alias("distinct_keys"),
        F.min("order_key").alias("lowest_key"),
        F.max("order_key").alias("highest_key"),
    )


register("surrogate_keys", _keys_by_position)


def _monthly_customers(x: Context) -> DataFrame:
    """Different customers of each month's completed sales, from sets kept by day."""
    layers = _own_layers(x)
    customers = surrogate.with_position_key(
        layers.write("silver", "dim_customers", x.silver.customers, order_by=["customer_id"]), "customer_key"
    )
    sales = gold.completed_sales(x.silver.orders).join(customers.select("customer_id", "customer_key"), "customer_id")
    daily = layers.write("gold", "customers_by_day", bitmaps.key_sets(sales, "customer_key", "order_date"))
    return bitmaps.distinct_keys(daily, "unique_customers", dates.year_month(c("order_date")).alias("yearmonth"))


register("monthly_customers", _monthly_customers)
register("hashed_surrogate_keys", _hashed_keys)


def _monthly(x: Context) -> tuple[DataFrame, DataFrame]:
    """All months at first, and two of them once more."""
    layers = _own_layers(x)
    monthly.run_months(x.silver.orders, x.silver.items, layers)
    return monthly.run_months(x.silver.orders, x.silver.items, layers, ["1999-03", "2001-05"])


register("delivered_orders_by_month", lambda x: monthly.delivered_orders(_monthly(x)[0], "2001-05"))
register("daily_metrics_by_month", lambda x: _monthly(x)[1].drop(monthly.MONTH))


def _quarantine(x: Context) -> DataFrame:
    """Orders delivered before some of their customers; the second delivery brings these."""
    orders, customers = x.bronze.orders, x.silver.customers.select("customer_id")
    early = customers.where(F.pmod(F.xxhash64("customer_id"), F.lit(3)) > 0)
    place = Quarantine(x.spark, f"{_stream_folder(x)}/orders", orders.schema)
    place.deliver(orders, [(early, "customer_id")], 0)
    place.deliver(orders.limit(0), [(customers, "customer_id")], 1)
    columns = ("order_id", "customer_id")
    kept = place.kept().select(*columns, F.lit("kept").alias("status"), F.lit("").alias("missing"))
    rejected = place.rejected().select(*columns, F.lit("rejected").alias("status"), F.array_join("missing", ",").alias("missing"))
    return kept.unionByName(rejected)


register("order_quarantine", _quarantine)

# --- Gold ----------------------------------------------------------------------------


def _customer_analytics(x: Context) -> DataFrame:
    s = x.silver
    return gold.customer_analytics(s.customers, s.orders, s.items, s.reviews, AS_OF)


def _top_books(x: Context) -> DataFrame:
    return gold.top_selling_books(x.silver.books, x.silver.items, x.silver.orders, x.silver.reviews)


def _authors(x: Context) -> DataFrame:
    return gold.author_performance(x.silver.books, x.silver.items, x.silver.reviews)


def _reviewed(x: Context) -> DataFrame:
    return gold.review_analytics(x.silver.books, x.silver.reviews)


def _geography(x: Context) -> DataFrame:
    return gold.geographic_analysis(x.silver.customers, x.silver.orders, x.silver.items)


register(
    "sales_by_category",
    lambda x: gold.sales_by_category(x.silver.items, x.silver.orders, x.silver.books),
)
register("top_selling_books", _top_books)
register("customer_analytics", _customer_analytics)
register("sales_over_time", lambda x: gold.sales_over_time(x.silver.orders, x.silver.items))
register("payment_analysis", lambda x: gold.payment_analysis(x.silver.orders))
register("geographic_analysis", _geography)
register("review_analytics", _reviewed)
register("daily_metrics", lambda x: gold.daily_metrics(x.silver.orders, x.silver.items))
register("author_performance", _authors)
register("author_performance_table", lambda x: gold.author_performance_table(_authors(x)))
register("popular_book", lambda x: gold.popular_book(x.silver.books, x.silver.items))
register(
    "modal_category",
    lambda x: ranking.most_frequent(x.silver.books, "author", "category").withColumnRenamed(
        "category", "most_popular_category"
    ),
)
register(
    "top_n_books",
    lambda x: ranking.top_n(_top_books(x), gold.presentation_order("top_selling_books"), 10),
)
register(
    "top_books_per_category",
    lambda x: ranking.top_per_group(
        _top_books(x), ["category"], gold.presentation_order("top_selling_books"), 3
    ),
)
register(
    "rfm_segment",
    lambda x: gold.valid_orders(x.silver.orders)
    .groupBy("customer_id")
    .agg(F.max("order_date").alias("last_date"), aggregates.total("total_amount").alias("spent"))
    .select(
        "customer_id",
        segments.recency_status(dates.days_since(c("last_date"), AS_OF)).alias("customer_status"),
        segments.spend_tier(c("spent"), tiers=((1_500_000, "VIP"), (750_000, "Regular"))).alias(
            "customer_tier"
        ),
    ),
)
register("at_risk_customers", lambda x: gold.at_risk_customers(_customer_analytics(x)))
register("premium_catalogue", lambda x: gold.premium_catalogue(_reviewed(x), 2))
register("delivered_orders", lambda x: gold.delivered_orders(x.silver.orders, "2001-05"))



def _through_catalog(view: str) -> Callable[[Context], DataFrame]:
    """A stored view, read by another session than the one that stored it."""

    def build(x: Context) -> DataFrame:
        layers = CatalogLayers(x.spark, f"case_{uuid.uuid4().hex[:12]}_{{layer}}", _stream_folder(x))
        tables = (("dim_customers", "customers"), ("dim_books", "books"), ("fact_orders", "orders"),
                  ("fact_order_items", "items"), ("fact_reviews", "reviews"))
        statement = view_sql.statements(layers.database("silver"), AS_OF)[view]
        for table, short in tables:
            if table in statement:
                layers.write("silver", table, getattr(x.silver, short))
        layers.store_views("gold", {view: statement})
        found = x.spark.newSession().table(layers.name("gold", view))
        return x.spark.table(layers.name("gold", view)).select(found.columns)

    return build


for _name in (
    "sales_by_category", "top_selling_books", "customer_analytics", "sales_over_time",
    "payment_analysis", "geographic_analysis", "review_analytics",
):
    register(f"stored_view_{_name}", _through_catalog(f"vw_{_name}"))

# --- Gold without multiplied sums ----------------------------------------------------
register(
    "top_selling_books_grain_safe",
    lambda x: gold_by_grain.top_selling_books(
        x.silver.books, x.silver.items, x.silver.orders, x.silver.reviews
    ),
)
register(
    "customer_analytics_grain_safe",
    lambda x: gold_by_grain.customer_analytics(
        x.silver.customers, x.silver.orders, x.silver.items, x.silver.reviews, AS_OF
    ),
)
register(
    "sales_over_time_grain_safe",
    lambda x: gold_by_grain.sales_over_time(x.silver.orders, x.silver.items),
)
register(
    "geographic_analysis_grain_safe",
    lambda x: gold_by_grain.geographic_analysis(x.silver.customers, x.silver.orders, x.silver.items),
)
register(
    "daily_metrics_grain_safe",
    lambda x: gold_by_grain.daily_metrics(x.silver.orders, x.silver.items),
)
register(
    "author_performance_grain_safe",
    lambda x: gold_by_grain.author_performance(
        x.silver.books, x.silver.items, x.silver.orders, x.silver.reviews
    ),
)

# --- first generation --------------------------------------------------------------
register(
    "dim_customers_original", lambda x: originals.customers(x.bronze.customers, AS_OF)
)
register("dim_books_original", lambda x: originals.books(x.bronze.books, AS_OF))
register(
    "fact_orders_original",
    lambda x: originals.orders(x.bronze.orders, x.silver.customers, AS_OF),
)
register(
    "fact_order_items_original",
    lambda x: originals.order_items(x.bronze.items, x.silver.orders, x.silver.books),
)
register(
    "fact_reviews_original",
    lambda x: originals.reviews(x.bronze.reviews, x.silver.books, x.silver.customers, AS_OF),
)
register(
    "top_selling_books_original",
    lambda x: originals.top_selling_books(
        x.silver.books, x.silver.items, x.silver.orders, x.silver.reviews
    ),
)
register(
    "customer_analytics_original",
    lambda x: originals.customer_analytics(
        x.silver.customers, x.silver.orders, x.silver.items, x.silver.reviews, AS_OF
    ),
)
register(
    "geographic_analysis_original",
    lambda x: originals.geographic_analysis(x.silver.customers, x.silver.orders, x.silver.items),
)
register(
    "author_performance_original",
    lambda x: originals.author_performance(
        x.silver.books, x.silver.items, x.silver.orders, x.silver.reviews
    ),
)

# --- quality -----------------------------------------------------------------------------


def _gold_outputs(x: Context) -> dict[str, DataFrame]:
    s = x.silver
    return {
        "sales_by_category": gold.sales_by_category(s.items, s.orders, s.books),
        "top_selling_books": _top_books(x),
        "customer_analytics": _customer_analytics(x),
        "sales_over_time": gold.sales_over_time(s.orders, s.items),
        "payment_analysis": gold.payment_analysis(s.orders),
        "geographic_analysis": _geography(x),
        "review_analytics": _reviewed(x),
    }


def _gold_tables(x: Context) -> dict[str, DataFrame]:
    return {
        **_gold_outputs(x),
        "daily_metrics": gold.daily_metrics(x.silver.orders, x.silver.items),
        "author_performance": _authors(x),
    }


register("dq_bronze_counts", lambda x: quality.bronze_counts(x.bronze))
register("dq_silver_summary", lambda x: quality.silver_summary(x.silver))
register("dq_score_report", lambda x: quality.score_report(x.silver))
register("dq_score_audit", lambda x: quality.score_audit(x.silver))
register("dq_invalid_reasons", lambda x: quality.invalid_order_reasons(x.silver.orders))
register("dq_score_bands", lambda x: quality.score_bands(x.silver.customers))
register("dq_gold_counts", lambda x: quality.row_counts(_gold_tables(x), "output"))
register("dq_kpis", lambda x: quality.kpis(x.silver, _gold_outputs(x)))
register("dq_duplicate_keys", lambda x: quality.repeated_keys(x.bronze.tables()))
register("dq_silver_duplicate_keys", lambda x: quality.repeated_keys(x.silver.tables()))
register("dq_orphans", lambda x: quality.bronze_orphans(x.silver))
register("dq_issue_profile", lambda x: quality.issue_profile(x.bronze, AS_OF))
register("dq_issue_combinations", lambda x: quality.issue_combinations(x.bronze, AS_OF))
register("dq_issue_summary", lambda x: quality.issue_summary(x.bronze, AS_OF))
register(
    "dq_value_variants",
    lambda x: quality.value_variants(
        x.bronze.books, "category", canonical.category(c("category"))
    ),
)
register(
    "dq_spellings",
    lambda x: quality.spellings(
        x.bronze.orders, "payment_method", canonical.payment_method(c("payment_method"))
    ),
)
register("dq_rating_distribution", lambda x: quality.rating_distribution(x.silver.reviews))
register("dq_row_reconciliation", lambda x: quality.row_reconciliation(x.silver))

# --- streams ------------------------------------------------------------------------------


def _arriving(x: Context, table: str, path: str | None = None) -> DataFrame:
    schema = read_table(x.spark, x.folder, table).schema
    # As a pattern the path may be one file or a folder of part files.
    return ingest.read_stream(x.spark, schema, path or f"{x.folder}/{table}.parque[t]", "parquet")


def _stream_folder(x: Context) -> str:
    shared = shared_folder(x.spark)
    if shared is None:
        raise RuntimeError("streams need spark.checkpoint.dir")
    return f"{shared}/streams/{uuid.uuid4()}"


def _streamed(x: Context, table: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream over one given table to its end and read what it wrote."""
    run = _stream_folder(x)
    stream = build(_arriving(x, table))
    ingest.append_available(stream, f"{run}/table", f"{run}/progress")
    return x.spark.read.schema(stream.schema).parquet(f"{run}/table")


def _merged_customers(x: Context) -> DataFrame:
    """Customers arriving in two deliveries, the later copies of a customer first."""
    run = _stream_folder(x)
    raw = commerce.raw_customers(*(read_table(x.spark, x.folder, t) for t in ("customer", "nation", "region")))
    later = F.col("created_at") >= F.date_add(F.lit(commerce.LOADED), 1)
    for delivery in (later, ~later):
        raw.where(delivery).write.mode("append").parquet(f"{run}/inbox")
        stream = ingest.arriving_customers(ingest.read_stream(x.spark, raw.schema, f"{run}/inbox"), AS_OF)
        merge.merge_available(stream, f"{run}/dim_customers", f"{run}/progress", "customer_id", ["arrival"], 16)
    return merge.read_merged(x.spark, f"{run}/dim_customers", stream.schema).drop("arrival")


def _daily_events(x: Context) -> DataFrame:
    """Events in two deliveries, with a restart in between; some events of the first one's
    last day arrive with the second, within the allowed lateness."""
    run = _stream_folder(x)
    events = read_table(x.spark, x.folder, "events")
    cut = F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    at = F.col("ts").cast("timestamp_ntz")
    second = (at >= cut) | ((F.col("event_id") % 7 == 0) & (at >= cut - F.expr("INTERVAL 1 DAY")))
    table = f"{run}/daily"
    for delivery in (~F.coalesce(second, F.lit(False)), second):
        events.where(delivery).write.mode("append").parquet(f"{run}/inbox")
        arriving = _arriving(x, "events", f"{run}/inbox").withColumn("ts", F.col("ts").cast("timestamp"))
        ingest.keep_daily_totals(arriving, "2 days", table, f"{run}/progress")
    return merge.read_merged(x.spark, table, ingest.DAILY_SCHEMA).drop("order", "last_event")


register("stream_dim_customers", _merged_customers)
register("stream_daily_metrics", _daily_events)
register(
    "stream_raw_reviews",
    lambda x: _streamed(x, "events", commerce.raw_reviews).drop("created_at"),
)
register(
    "stream_fact_orders",
    lambda x: _streamed(
        x,
        "orders",
        lambda s: ingest.cleaned_orders(commerce.raw_orders(s), x.silver.customers, AS_OF),
    ),
)
register(
    "stream_fact_reviews",
    lambda x: _streamed(
        x,
        "events",
        lambda s: ingest.cleaned_reviews(
            commerce.raw_reviews(s), x.silver.books, x.silver.customers, AS_OF
        ),
    ),
)
register(
    "stream_customer_keys",
    lambda x: _streamed(
        x,
        "customer",
        lambda s: ingest.first_arrivals(
            commerce.raw_customers(
                s,
                read_table(x.spark, x.folder, "nation"),
                read_table(x.spark, x.folder, "region"),
            ),
            "customer_id",
            "3 days",
        ).select("customer_id"),
    ),
)
