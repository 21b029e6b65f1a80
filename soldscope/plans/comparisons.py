"""Cross-shop comparisons of catalogue groups on paired snapshot dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.operators.catalogue import price_metrics_with_median
from soldscope.operators.pairing import nearest_date

GROUP = ("brand", "model", "condition")
METRICS = ("item_count", "avg_price", "min_price", "max_price", "median_price", "total_price")
BLOCK_LABEL = {"F": "竞品F", "R": "竞品R"}


def _side(aggregated: DataFrame, prefix: str, *kept: str) -> DataFrame:
    """Aggregate with side-prefixed columns, so that a join of two of them has no name clash."""
    return aggregated.select(
        *[F.col(c).alias(f"{prefix}_{c}") for c in (*GROUP, *METRICS)], *[F.col(c) for c in kept]
    )


def _same_group(left: str, right: str) -> Column:
    """NULL and '' match each other, so the keys are compared after coalescing."""
    key = lambda side, k: F.coalesce(F.col(f"{side}_{k}"), F.lit(""))
    brand, model, condition = [key(left, k) == key(right, k) for k in GROUP]
    return brand & model & condition


def _group_of(left: str, right: str) -> list[Column]:
    return [F.coalesce(f"{left}_{k}", f"{right}_{k}").alias(k) for k in GROUP]


def _metrics_of(*sides: str) -> list[str]:
    return [f"{side}_{m}" for side in sides for m in METRICS]


def _day(sold: DataFrame, shop: str, day: Column) -> DataFrame:
    return sold.where((F.col("shop") == shop) & (F.col("snapshot_date") == day))


def _paired_day(sold: DataFrame, shop: str, anchor: date) -> Column:
    dates = sold.where(F.col("shop") == shop).select("snapshot_date")
    return nearest_date(dates, anchor).select("paired_date").scalar()


def compare_two(sold: DataFrame, anchor: date, *, base: str = "F", other: str = "R") -> DataFrame:
    """Groups of the base shop on the anchor date beside those of the other shop's nearest date.

    Both sides aggregate before the full outer join. The paired date is a scalar subquery: it
    prunes the scan at run time, and no pair means no rows.
    """
    anchor_day = F.lit(anchor).cast("date")
    paired = _paired_day(sold, other, anchor)
    b, o = base.lower(), other.lower()
    left = _side(price_metrics_with_median(_day(sold, base, anchor_day), GROUP), b)
    right = _side(price_metrics_with_median(_day(sold, other, paired), GROUP), o)
    joined = left.join(right, _same_group(b, o), "full_outer").select(
        anchor_day.alias(f"{b}_date"), paired.alias(f"{o}_date"), *_group_of(b, o), *_metrics_of(b, o)
    )
    gap = F.abs(F.datediff(F.col(f"{o}_date"), F.col(f"{b}_date"))).alias("pairing_gap_days")
    return (
        joined.where(F.col(f"{o}_date").isNotNull())
        .select(f"{b}_date", f"{o}_date", gap, *joined.columns[2:])
        .orderBy(*[F.col(k).asc_nulls_last() for k in GROUP])
    )


def compare_reference(sold: DataFrame, anchor: date, *, how: str = "left") -> DataFrame:
    """Groups of V on the anchor date against F and R, each on its own nearest date.

    One block of rows per paired shop. ``how="left"`` keeps the groups of V only; ``"full"`` adds
    those found in the other shop alone.
    """
    anchor_day = F.lit(anchor).cast("date")
    days = {shop: _paired_day(sold, shop, anchor) for shop in BLOCK_LABEL}
    base = price_metrics_with_median(_day(sold, "V", anchor_day), (*GROUP, "currency"))
    left = (
        _side(base, "v", "currency")
        .withColumn("block", F.explode(F.array(*[F.lit(s) for s in days])))
        .withColumn("shop_date", F.when(F.col("block") == "F", days["F"]).otherwise(days["R"]))
        .where("shop_date is not null")
    )
    f_day, r_day = [(F.col("shop") == s) & (F.col("snapshot_date") == day) for s, day in days.items()]
    other = price_metrics_with_median(sold.where(f_day | r_day), ("shop", "snapshot_date", *GROUP))
    right = _side(other, "shop", "shop", "snapshot_date")
    kind = "full_outer" if how == "full" else "left"
    joined = left.join(right, (F.col("block") == F.col("shop")) & _same_group("v", "shop"), kind)
    out = joined.select(
        F.when(F.coalesce("block", "shop") == "F", BLOCK_LABEL["F"]).otherwise(BLOCK_LABEL["R"]).alias("shop"),
        anchor_day.alias("v_date"),
        F.coalesce("shop_date", "snapshot_date").alias("shop_date"),
        *_group_of("v", "shop"),
        "currency",
        *_metrics_of("v", "shop"),
    )
    gap = F.abs(F.datediff("shop_date", "v_date")).alias("pairing_gap_days")
    return out.select("shop", "v_date", "shop_date", gap, *out.columns[3:]).orderBy(
        "shop", *[F.col(k).asc_nulls_last() for k in (*GROUP, "currency")]
    )


def pairing_header(comparison: DataFrame) -> DataFrame:
    """The distinct dates and gap a comparison was made on."""
    dates = [c for c in comparison.columns if c.endswith("_date")]
    return comparison.select(*dates, "pairing_gap_days").distinct()


def two_shop_header(sold: DataFrame, anchor: date, *, base: str = "F", other: str = "R") -> DataFrame:
    """The header of ``compare_two`` from the other shop's dates alone: no group is made.

    A paired date has rows of the other shop, so the comparison has rows exactly if there is one.
    """
    b, o = f"{base.lower()}_date", f"{other.lower()}_date"
    dates = sold.where(F.col("shop") == other).select("snapshot_date")
    found = nearest_date(dates, anchor).where("paired_date is not null")
    gap = F.abs(F.datediff(F.col(o), F.col(b))).alias("pairing_gap_days")
    return found.select(F.lit(anchor).cast("date").alias(b), F.col("paired_date").alias(o)).select(b, o, gap)


def brand_summary(comparison: DataFrame, top: int | None = 15, *, base: str = "f", other: str = "r") -> DataFrame:
    """Per brand of a wide comparison: summed counts and the unweighted mean of group averages."""
    out = (
        comparison.groupBy("brand")
        .agg(
            F.coalesce(F.sum(f"{base}_item_count"), F.lit(0)).alias(f"{base}_items"),
            F.coalesce(F.sum(f"{other}_item_count"), F.lit(0)).alias(f"{other}_items"),
            F.avg(f"{base}_avg_price").alias(f"{base}_avg"),
            F.avg(f"{other}_avg_price").alias(f"{other}_avg"),
        )
        .orderBy(F.col(f"{base}_items").desc(), F.col("brand").asc_nulls_last())
    )
    return out.limit(top) if top else out
