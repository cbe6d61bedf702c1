"""Orders and daily metrics stored by month, so that a month can be run again alone.

A month's run reads the raw orders of that month, replaces its partition of the orders and,
from it, its partition of the daily metrics.  Files of other months are neither read nor
written.  Orders without a date are a partition of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..sources.layers import CatalogLayers, PathLayers
from . import gold

MONTH = "order_month"
UNDATED = "none"
ORDERS = "fact_orders_by_month"
DAILY = "agg_daily_metrics_by_month"


def month_of(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


def run_months(
    orders: DataFrame,
    items: DataFrame,
    layers: PathLayers | CatalogLayers,
    months: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Store cleaned orders and their daily metrics, of all months or of the given ones.

    Returns both tables whole, as stored."""
    dated = orders.withColumn(MONTH, month_of(F.col("order_date")))
    wanted = F.lit(True) if months is None else F.col(MONTH).isin(list(months))
    by_month = layers.replace_months("silver", ORDERS, dated.where(wanted), MONTH)
    daily = gold.daily_metrics(by_month.where(wanted), items)
    daily = daily.withColumn(MONTH, month_of(F.col("metric_date")))
    return by_month, layers.replace_months("gold", DAILY, daily, MONTH)


def delivered_orders(by_month: DataFrame, month: str) -> DataFrame:
    """Delivered orders of a month (``yyyy-MM``), from that month's files only."""
    found = by_month.where((F.col(MONTH) == month) & (F.col("order_status") == fixed.DELIVERED))
    return found.drop(MONTH)
