"""What the store holds: totals, date bounds, newest snapshots, default window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soldscope.operators import predicates as P
from soldscope.schema import SHOPS


def _unfold(one_row: DataFrame, labels: tuple[str, ...], fields: tuple[str, ...], key: str) -> DataFrame:
    """A single row of ``field_label`` columns to one row per label, so that empty shops stay listed."""
    rows = F.array(
        *[
            F.struct(F.lit(label).alias(key), *[F.col(f"{f}_{label}").alias(f) for f in fields])
            for label in labels
        ]
    )
    return one_row.select(F.inline(rows))


def _of(shop: str, value: Column) -> Column:
    return F.when(F.col("shop") == shop, value)


def shop_totals(sold: DataFrame) -> DataFrame:
    """Rows per shop and altogether; a shop without rows counts 0."""
    counted = sold.agg(
        *[F.count_if(F.col("shop") == s).alias(f"row_count_{s}") for s in SHOPS],
        F.count_if(F.col("shop").isin(*SHOPS)).alias("row_count_total"),
    )
    return _unfold(counted, (*SHOPS, "total"), ("row_count",), "shop")


def table_bounds(sold: DataFrame) -> DataFrame:
    """First and last date per shop and pooled; a shop without dates has a NULL row."""
    day = F.col("snapshot_date")
    exprs = []
    for s in SHOPS:
        exprs += [F.min(_of(s, day)).alias(f"min_date_{s}"), F.max(_of(s, day)).alias(f"max_date_{s}")]
    exprs += [F.min(day).alias("min_date_all"), F.max(day).alias("max_date_all")]
    return _unfold(sold.select("shop", "snapshot_date").agg(*exprs), (*SHOPS, "all"), ("min_date", "max_date"), "shop")


def latest_dates(sold: DataFrame) -> DataFrame:
    return table_bounds(sold).where("shop <> 'all'").select("shop", F.col("max_date").alias("latest_date"))


def default_window(bounds: DataFrame, days: int = 14) -> DataFrame:
    """The last ``days`` days that data covers; without data the last days before today."""
    shops = bounds.where("shop <> 'all'")
    edge = shops.agg(F.min("min_date").alias("first"), F.max("max_date").alias("last"))
    end = F.coalesce("last", F.current_date())
    start = F.greatest(F.col("first"), F.date_sub(end, days))
    return edge.select(start.alias("start_date"), end.alias("end_date"))


def snapshot_summary(sold: DataFrame, newest: int = 20) -> DataFrame:
    """Row counts of the newest snapshots per shop; an undated bucket comes first."""
    counted = sold.groupBy("shop", "snapshot_date").agg(F.count("*").alias("row_count"))
    newest_first = Window.partitionBy("shop").orderBy(F.col("snapshot_date").desc_nulls_first())
    return (
        counted.withColumn("place", F.row_number().over(newest_first))
        .where(F.col("place") <= newest)
        .drop("place")
        .orderBy("shop", F.col("snapshot_date").desc_nulls_first())
    )


def snapshot_dates(sold: DataFrame, shop: str) -> DataFrame:
    return (
        sold.where((F.col("shop") == shop) & F.col("snapshot_date").isNotNull())
        .select("snapshot_date")
        .distinct()
        .orderBy("snapshot_date")
    )


def missing_images(sold: DataFrame, since: date | None = None) -> DataFrame:
    """Rows without an image per shop and date."""
    rows = sold.where(P.lacks_image())
    if since is not None:
        rows = rows.where(F.col("snapshot_date") >= F.lit(since).cast("date"))
    return (
        rows.groupBy("shop", "snapshot_date")
        .agg(F.count("*").alias("missing_rows"))
        .orderBy("shop", F.col("snapshot_date").asc_nulls_last())
    )
