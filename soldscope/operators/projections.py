"""Result shapes: labels, placeholders, sample rows, delivery names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.functions.urls import first_image_url

UNKNOWN = "未知"
NO_LABEL = "—"

# fixed values: delivery names of trend columns
DELIVERY_NAMES = {
    "snapshot_date": "快照日期",
    "currency": "货币",
    "item_count": "样本件数",
    "avg_price": "均价",
    "min_price": "最低价",
    "max_price": "最高价",
    "median_price": "中位价",
    "total_price": "成交总额",
}


def shop_rows(df: DataFrame, shop: str) -> DataFrame:
    """Tag one shop's table and bring it to the common shape."""
    if "product_name" in df.columns:
        df = df.withColumnRenamed("product_name", "model")
    if "currency" not in df.columns:
        df = df.withColumn("currency", F.lit(None).cast("string"))
    return df.withColumn("shop", F.lit(shop))


def average(total: str = "total_price", count: str = "item_count") -> Column:
    return F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0))


def product_label() -> Column:
    text = F.concat(F.coalesce("brand", F.lit("")), F.lit(" "), F.coalesce("model", F.lit("")))
    return F.nullif(F.trim(text), F.lit(""))


def bucket(column: str) -> Column:
    """Blank values share one bucket."""
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(UNKNOWN))


def iso_day(column: str = "snapshot_date") -> Column:
    """Date, timestamp or text to an ISO day, NULL when it is none."""
    text = F.trim(F.col(column).cast("string"))
    plain = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10))
    return F.coalesce(plain, F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd"))


def sample_rows(df: DataFrame) -> DataFrame:
    """Shaped sample rows: undated and unpriced rows are dropped, blanks are NULL."""
    blank_to_null = lambda c: F.nullif(F.trim(c), F.lit(""))
    label = F.concat_ws(" ", blank_to_null("brand"), blank_to_null("model"))
    return df.where(F.col("snapshot_date").isNotNull() & (F.col("price") > 0)).select(
        "shop",
        "id",
        blank_to_null("item_id").alias("item_id"),
        blank_to_null("brand").alias("brand"),
        blank_to_null("model").alias("product_name"),
        F.coalesce(F.nullif(label, F.lit("")), F.lit(NO_LABEL)).alias("label"),
        blank_to_null("condition").alias("condition"),
        blank_to_null("color").alias("color"),
        F.col("price").cast("double").alias("price"),
        "snapshot_date",
        first_image_url("image", "image_urls", "image_path").alias("image_url"),
    )


def for_delivery(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in DELIVERY_NAMES.items() if k in df.columns})


def chart_points(trend: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Trend points inside the picked interval, missing prices drawn as zero."""
    if start and end:
        trend = trend.where(F.col("snapshot_date").between(F.lit(start), F.lit(end)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return trend.select(
        "snapshot_date",
        F.date_format("snapshot_date", "MM/dd").alias("day"),
        zero("avg_price"),
        zero("min_price"),
        zero("max_price"),
        "min_price_products",
        "max_price_products",
    )
