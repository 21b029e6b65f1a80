"""Daily price trends and the figures of a period."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.operators import predicates as P
from soldscope.operators.catalogue import TOTAL, price_metrics, price_metrics_wide
from soldscope.operators.projections import NO_LABEL, average


def model_price_trend(sold: DataFrame, start: date, end: date, keyword: str) -> DataFrame:
    """All shops pooled by day and currency, priced rows only.

    Rows group on the raw currency, so NULL and a literal dash stay two rows.
    """
    rows = sold.where(P.in_range(start, end) & P.title_contains(keyword) & P.has_price())
    out = price_metrics_wide(rows, ("snapshot_date", "currency"))
    return out.orderBy("snapshot_date", F.col("currency").asc_nulls_last()).select(
        "snapshot_date",
        F.coalesce("currency", F.lit(NO_LABEL)).alias("currency"),
        "item_count",
        "total_price",
        "min_price",
        "max_price",
        "median_price",
        average().alias("avg_price"),
    )


def daily_prices(sold: DataFrame, start: date, end: date, keyword: str) -> DataFrame:
    """The points of ``model_price_trend`` without the median, for figures that need none."""
    rows = sold.where(P.in_range(start, end) & P.title_contains(keyword) & P.has_price())
    out = price_metrics(rows, ("snapshot_date", "currency"))
    return out.withColumn("currency", F.coalesce("currency", F.lit(NO_LABEL)))


def shop_daily_trends(sold: DataFrame, start: date, end: date) -> DataFrame:
    return (
        sold.where(P.in_range(start, end))
        .groupBy("shop", "snapshot_date")
        .agg(F.count("*").alias("item_count"), F.sum("price").cast(TOTAL).alias("total_price"))
        .withColumn("avg_price", average())
        .orderBy("snapshot_date", "shop")
    )


def period_summary(trend: DataFrame) -> DataFrame:
    """Figures of a whole trend; the average is the ratio of sums. No row for an empty trend."""
    return (
        trend.agg(
            F.sum("item_count").alias("item_count"),
            F.round(
                F.sum("total_price").cast("double") / F.nullif(F.sum("item_count"), F.lit(0)), 2
            ).alias("avg_price"),
            F.round(F.min("min_price").cast("double"), 2).alias("min_price"),
            F.round(F.max("max_price").cast("double"), 2).alias("max_price"),
            F.countDistinct("snapshot_date").alias("snapshot_days"),
            F.count("*").alias("points"),
        )
        .where("points > 0")
        .drop("points")
    )


def currencies(trend: DataFrame) -> DataFrame:
    return trend.select("currency").where("currency is not null").distinct().orderBy("currency")


def chart_by_currency(trend: DataFrame, currency: str | None = None) -> DataFrame:
    """Price series of one currency, or all with the currency as a key; currencies never add up."""
    if currency is not None:
        trend = trend.where(F.col("currency") == currency)
    return trend.select(
        "currency", "snapshot_date", "avg_price", "median_price", "min_price", "max_price"
    ).orderBy("currency", "snapshot_date")
