"""Data-quality reports and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical, dates, numbers, rules, segments, text
from ..functions import fixed_values as fixed
from ..functions.dates import AsOf
from ..operators.aggregates import count_where, mean, ratio
from ..operators.combine import labelled_union
from ..operators.dedup import duplicate_keys
from ..operators.referential import orphans
from ..sources.bronze import Bronze
from .silver import Silver

ID = {
    "customers": "customer_id",
    "books": "book_id",
    "orders": "order_id",
    "items": "order_item_id",
    "reviews": "review_id",
}


def _named(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {fixed.ENTITY_LABELS[k]: df for k, df in tables.items()}


def row_counts(tables: Mapping[str, DataFrame], label: str = "entidade") -> DataFrame:
    """Rows of each table."""
    counted = {name: df.agg(F.count("*").alias("total")) for name, df in tables.items()}
    return labelled_union(counted, label)


def bronze_counts(bronze: Bronze) -> DataFrame:
    return row_counts(_named(bronze.tables()))


def silver_summary(silver: Silver) -> DataFrame:
    """Rows of each Silver table, its mean score and how many rows are sound."""

    def summary(df: DataFrame, score: str | None, sound: str | None) -> DataFrame:
        unknown = F.lit(None)
        return df.agg(
            F.count("*").alias("total"),
            (mean(F.col(score), 2) if score else unknown)
            .cast("decimal(3,2)")
            .alias("qualidade_media"),
            (count_where(F.col(sound)) if sound else unknown).cast("bigint").alias("validos"),
        )

    score = "data_quality_score"
    parts = {
        "customers": summary(silver.customers, score, None),
        "books": summary(silver.books, score, None),
        "orders": summary(silver.orders, score, "is_valid_order"),
        "items": summary(silver.items, None, "subtotal_matches"),
        "reviews": summary(silver.reviews, None, "is_valid_review"),
    }
    return labelled_union(_named(parts), "entidade")


def _scored(silver: Silver) -> dict[str, DataFrame]:
    return _named(
        {
            "customers": silver.customers,
            "books": silver.books,
            "orders": silver.orders,
        }
    )


def score_report(silver: Silver) -> DataFrame:
    """Rows and mean, lowest and highest score of each scored table."""
    score = F.col("data_quality_score")
    measures = [
        F.count("*").alias("total"),
        mean(score, 2).alias("score_medio"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
    ]
    return labelled_union({k: df.agg(*measures) for k, df in _scored(silver).items()}, "entidade")


def score_audit(silver: Silver) -> DataFrame:
    """Rows, mean score, perfect rows and critical rows of each scored table."""
    score = F.col("data_quality_score")
    measures = [
        F.count("*").alias("total"),
        mean(score, 3).alias("score_medio"),
        count_where(score == F.lit(fixed.PERFECT_SCORE)).alias("perfeitos"),
        count_where(score < F.lit(fixed.CRITICAL_BELOW)).alias("criticos"),
    ]
    return labelled_union({k: df.agg(*measures) for k, df in _scored(silver).items()}, "entidade")


def invalid_order_reasons(orders: DataFrame) -> DataFrame:
    """Invalid orders with what is wrong with each."""
    return orders.where(~F.col("is_valid_order")).select(
        "order_id",
        F.when(F.col("total_amount").isNull(), F.lit(fixed.NO_AMOUNT)).alias("motivo_valor"),
        F.when(F.col("order_date").isNull(), F.lit(fixed.NO_DATE)).alias("motivo_data"),
        F.when(F.col("order_status") == fixed.CANCELLED, F.lit(fixed.CANCELLED)).alias(
            "motivo_status"
        ),
    )


def score_bands(df: DataFrame) -> DataFrame:
    """Rows per score band, best band first."""
    return (
        df.groupBy(segments.score_band(F.col("data_quality_score")).alias("faixa_score"))
        .agg(F.count("*").alias("quantidade"), F.min("data_quality_score").alias("_lowest"))
        .orderBy(F.desc("_lowest"))
        .drop("_lowest")
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per rating; the null rating holds the out-of-range ones."""
    return reviews.groupBy("rating").agg(F.count("*").alias("total_reviews"))


def row_reconciliation(silver: Silver) -> DataFrame:
    """Rows in, rows out and rows dropped per table."""
    before = row_counts(_named(silver.bronze.tables())).withColumnRenamed("total", "bronze_rows")
    after = row_counts(_named(silver.tables())).withColumnRenamed("total", "silver_rows")
    return before.join(after, "entidade").withColumn(
        "dropped_rows", F.col("bronze_rows") - F.col("silver_rows")
    )


def repeated_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Business keys that occur more than once in their table."""
    found = {name: duplicate_keys(df, ID[name]) for name, df in tables.items()}
    return labelled_union(_named(found), "entidade")


# child table -> (parent table, foreign key)
REFERENCES: Sequence[tuple[str, str, str]] = (
    ("orders", "customers", "customer_id"),
    ("items", "orders", "order_id"),
    ("items", "books", "book_id"),
    ("reviews", "books", "book_id"),
    ("reviews", "customers", "customer_id"),
)


def bronze_orphans(silver: Silver) -> DataFrame:
    """Raw rows that Silver drops because a parent is missing."""
    raw, parents = silver.bronze.tables(), silver.tables()
    found = []
    for child, parent, key in REFERENCES:
        lost = orphans(raw[child].where(F.col(ID[child]).isNotNull()), parents[parent], key)
        found.append(
            lost.select(
                F.lit(fixed.ENTITY_LABELS[child]).alias("entidade"),
                F.lit(key).alias("foreign_key"),
                F.col(ID[child]).alias("row_id"),
                F.col(key).alias("missing_key"),
            )
        )
    stacked = found[0]
    for more in found[1:]:
        stacked = stacked.unionByName(more)
    return stacked


def issue_rules(as_of: AsOf) -> dict[str, dict[str, Column]]:
    """Problems looked for in each raw table, true where a row has it."""
    c = F.col

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    def respelled(raw: Column, clean: Column) -> Column:
        return flag(raw != clean)

    def unreadable(parsed: Column) -> Column:
        return parsed.isNull()

    def wide(column: str) -> Column:
        return numbers.too_wide(c(column))

    stocked = numbers.to_count(c("stock_quantity"))
    ordered = dates.parse_date(c("order_date"), fixed.ORDER_DATES)
    return {
        "customers": {
            "invalid_email": ~text.is_valid_email(c("email")),
            "missing_phone": ~text.has_text(c("phone")),
            "padded_name": respelled(c("full_name"), text.clean_name(c("full_name"))),
            "registration_date_spelling": ~text.matches(
                c("registration_date"), fixed.YMD_DASH.shape
            ),
            "birth_date_spelling": ~text.matches(c("birth_date"), fixed.YMD_DASH.shape),
            "city_spelling": respelled(c("city"), text.sentence_case(c("city"))),
            "state_spelling": respelled(c("state"), text.state_code(c("state"))),
            "country_spelling": respelled(c("country"), canonical.country(c("country"))),
        },
        "books": {
            "negative_price": flag(numbers.to_decimal(c("price")) < 0),
            "unreadable_price": unreadable(numbers.to_decimal(c("price"))),
            "no_stock": flag(F.coalesce(stocked, F.lit(0)) == 0) & ~flag(wide("stock_quantity")),
            "stock_too_wide": flag(wide("stock_quantity")),
            "year_out_of_range": unreadable(numbers.valid_year(c("publication_year"), as_of)),
            "rating_out_of_range": unreadable(numbers.catalogue_rating(c("rating"))),
            "category_spelling": respelled(c("category"), canonical.category(c("category"))),
            "language_spelling": respelled(
                c("language_code"), canonical.language(c("language_code"))
            ),
        },
        "orders": {
            "missing_amount": ~text.has_text(c("total_amount")),
            "unreadable_date": unreadable(ordered),
            "future_date": flag(ordered > dates.day(as_of)),
            "missing_shipping": ~text.has_text(c("shipping_cost")),
            "status_spelling": respelled(
                c("order_status"), canonical.order_status(c("order_status"))
            ),
            "payment_spelling": respelled(
                c("payment_method"), canonical.payment_method(c("payment_method"))
            ),
        },
        "items": {
            "quantity_replaced": flag(
                F.coalesce(numbers.to_count(c("quantity")), F.lit(0)) == 0
            )
            & ~flag(wide("quantity")),
            "quantity_too_wide": flag(wide("quantity")),
            "price_unusable": unreadable(numbers.non_negative_money(c("unit_price"))),
            "subtotal_mismatch": ~rules.subtotal_matches(
                c("subtotal"), c("quantity"), c("unit_price")
            ),
        },
        "reviews": {
            "rating_out_of_range": unreadable(numbers.review_rating(c("rating"))),
            "blank_text": ~flag(F.trim(c("review_text")) != ""),
            "unusable_date": unreadable(dates.review_date(c("review_date"), as_of)),
            "date_spelling": text.matches(c("review_date"), fixed.DMY_DASH.shape),
        },
    }


def issue_profile(bronze: Bronze, as_of: AsOf) -> DataFrame:
    """How often each problem occurs in each raw table.

    One aggregate per table counts all its rules at once; only the one-row
    results are turned into rows.
    """
    parts = {}
    for name, found in issue_rules(as_of).items():
        counted = bronze.tables()[name].agg(
            F.count("*").alias("total"), *[count_where(p).alias(rule) for rule, p in found.items()]
        )
        parts[name] = counted.unpivot("total", list(found), "rule", "affected").select(
            "rule",
            "total",
            "affected",
            ratio((F.col("affected") * 100).cast("decimal(20,0)"), F.col("total"), 2).alias(
                "affected_percentage"
            ),
        )
    return labelled_union(_named(parts), "entidade")


def issue_combinations(bronze: Bronze, as_of: AsOf) -> DataFrame:
    """Rows of each raw table by the set of problems they have.

    A row's problems are one number with a bit for each rule, by which rows are counted in
    one pass; whatever is asked about rules alone or together follows from these few rows."""
    parts = {}
    for name, found in issue_rules(as_of).items():
        bits = [F.when(problem, F.lit(1 << k)).otherwise(F.lit(0)) for k, problem in enumerate(found.values())]
        mask = bits[0]
        for bit in bits[1:]:
            mask = mask.bitwiseOR(bit)
        names = F.array(*[F.when(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0, F.lit(r)) for k, r in enumerate(found)])
        counted = bronze.tables()[name].groupBy(mask.alias("mask")).agg(F.count("*").alias("total"))
        parts[name] = counted.select(F.array_join(F.array_compact(names), ",").alias("problems"), "total")
    return labelled_union(_named(parts), "entidade")


def issue_summary(bronze: Bronze, as_of: AsOf) -> DataFrame:
    """Rows of each raw table, those with any problem, their share, and the rows that only
    repeat the id of another one."""
    with_any = F.sum(F.when(F.col("problems") != "", F.col("total")).otherwise(0))
    rows = issue_combinations(bronze, as_of).groupBy("entidade").agg(
        F.sum("total").alias("total"), with_any.alias("with_problem")
    )
    repeated = labelled_union(
        _named(
            {
                name: duplicate_keys(df, ID[name]).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("repeated"))
                for name, df in bronze.tables().items()
            }
        ),
        "entidade",
    )
    share = ratio((F.col("with_problem") * 100).cast("decimal(20,0)"), F.col("total"), 2)
    return rows.join(repeated, "entidade").select(
        "entidade", "total", "with_problem", share.alias("problem_percentage"), F.col("repeated").alias("repeated_ids")
    )


def value_variants(raw: DataFrame, column: str, cleaned: Column) -> DataFrame:
    """How many spellings and rows each canonical value has."""
    return (
        spellings(raw, column, cleaned)
        .groupBy("canonical")
        .agg(F.count("spelling").alias("variants"), F.sum("total_rows").alias("total_rows"))
    )


def spellings(raw: DataFrame, column: str, cleaned: Column) -> DataFrame:
    """One row per spelling of each canonical value."""
    return raw.groupBy(cleaned.alias("canonical"), F.col(column).alias("spelling")).agg(
        F.count("*").alias("total_rows")
    )


def kpis(silver: Silver, gold_outputs: Mapping[str, DataFrame]) -> DataFrame:
    """Success measures with their targets and whether they are met."""
    hundred = F.lit(100).cast("decimal(5,2)")

    def share(part: Column, whole: Column) -> Column:
        return ratio((part * 100).cast("decimal(20,0)"), whole, 2).cast("decimal(5,2)")

    raw_keys = silver.bronze.customers.agg(F.countDistinct("customer_id").alias("keys"))
    kept = silver.customers.agg(F.count("*").alias("rows"))
    deduplicated = raw_keys.select(
        share(F.col("keys"), kept.select("rows").scalar()).alias("value")
    )
    scores = [
        df.select("data_quality_score") for df in (silver.customers, silver.books, silver.orders)
    ]
    covered = (
        scores[0]
        .unionAll(scores[1])
        .unionAll(scores[2])
        .agg(share(F.count("data_quality_score"), F.count("*")).alias("value"))
    )
    valid = silver.orders.agg(
        share(count_where(F.col("is_valid_order")), F.count("*")).alias("value")
    )
    filled = row_counts(gold_outputs, "output").agg(
        share(count_where(F.col("total") > 0), F.count("*")).alias("value")
    )
    categories = silver.books.select("category").distinct()
    consistent = categories.agg(
        share(F.countDistinct(text.fold(F.col("category"))), F.count("category")).alias("value")
    )
    target = F.lit(fixed.VALID_ORDER_TARGET * 100).cast("decimal(5,2)")
    measured = {
        "deduplication_rate": (deduplicated, hundred),
        "score_coverage": (covered, hundred),
        "valid_orders": (valid, target),
        "gold_outputs_filled": (filled, hundred),
        "category_consistency": (consistent, hundred),
    }
    return labelled_union(
        {
            name: df.select("value", goal.alias("target"), (F.col("value") >= goal).alias("met"))
            for name, (df, goal) in measured.items()
        },
        "kpi",
    )
