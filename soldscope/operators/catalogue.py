"""Catalogue aggregates of price by any key set, with an exact median that survives hot groups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soldscope.operators import predicates as P
from soldscope.schema import null_of

TOTAL = "decimal(28,2)"

CATALOGUE_KEYS = ("brand", "model", "condition", "currency")
BRAND_KEYS = ("brand",)


def _average() -> Column:
    return F.col("total_price").cast("double") / F.nullif(F.col("priced"), F.lit(0))


def _count(df: DataFrame) -> Column:
    """Number of rows, of a roll-up of counted prices the sum of ``n``."""
    return F.sum("n") if "n" in df.columns else F.count("*")


def price_metrics(df: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Count, average, minimum, maximum and sum of price in one partial-aggregated shuffle.

    Takes rows or counted prices, as the two below do.
    """
    if "n" in df.columns:
        total = F.sum(F.col("price") * F.col("n").cast("decimal(13,0)"))
        priced = F.sum(F.when(F.col("price").isNotNull(), F.col("n")).otherwise(0))
    else:
        total, priced = F.sum("price"), F.count("price")
    out = df.groupBy(*keys).agg(
        _count(df).alias("item_count"),
        priced.alias("priced"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        total.cast(TOTAL).alias("total_price"),
        *extra,
    )
    return out.withColumn("avg_price", _average()).drop("priced")


def price_metrics_with_median(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``price_metrics`` plus the exact continuous median.

    Equal prices are counted first, which spreads a hot group over its prices. What then meets per
    group is one row per distinct price in a sorted window that spills, never the group's rows and
    never a state in memory; the closing aggregation reuses the window's partitioning.
    """
    keys = list(keys)
    per_price = df.groupBy(*keys, "price").agg(_count(df).alias("n"))
    priced = F.when(F.col("price").isNotNull(), F.col("n")).otherwise(0)
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col("price").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = per_price.withColumn("priced", priced).select(
        *keys,
        "price",
        "n",
        "priced",
        F.sum("priced").over(running).alias("upto"),
        F.sum("priced").over(group).alias("of"),
    )

    def at(rank: Column) -> Column:
        before = F.col("upto") - F.col("priced")
        return F.max(F.when((before < rank) & (rank <= F.col("upto")), F.col("price")))

    lower = F.floor((F.col("of") + 1) / 2)
    upper = F.floor(F.col("of") / 2) + 1
    return (
        ranked.groupBy(*keys)
        .agg(
            F.sum("n").alias("item_count"),
            F.sum("priced").alias("priced"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            ((at(lower) + at(upper)) / 2).cast("double").alias("median_price"),
            F.sum(F.col("price") * F.col("n").cast("decimal(13,0)")).cast(TOTAL).alias("total_price"),
        )
        .withColumn("avg_price", _average())
        .drop("priced")
    )


def price_metrics_wide(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``price_metrics_with_median`` for few keys with very many prices each.

    Prices are counted in classes of about one percent first. A group's classes, a few thousand at most,
    tell which of them hold the middle ranks, and only the prices of those are put in order.
    """
    keys = list(keys)
    plain = F.col("price").cast("double")
    # rows without a price are a class of their own, which no rank falls into
    per_price = df.groupBy(*keys, "price").agg(_count(df).alias("n")).withColumn(
        "class", (F.signum(plain) * F.floor(F.log2(F.abs(plain) + 1) * 64)).cast("int")
    )
    classes = per_price.groupBy(*keys, "class").agg(
        F.sum("n").alias("item_count"),
        F.sum(F.when(F.col("price").isNotNull(), F.col("n")).otherwise(0)).alias("held"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(F.col("price") * F.col("n").cast("decimal(13,0)")).alias("total_price"),
    )
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col("class").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = classes.select("*", F.sum("held").over(running).alias("upto"), F.sum("held").over(group).alias("of"))
    ranks = {"lower": F.floor((F.col("of") + 1) / 2), "upper": F.floor(F.col("of") / 2) + 1}
    before = F.col("upto") - F.col("held")
    middle = ranked.withColumns(ranks).where(
        P.any_of((before < F.col(r)) & (F.col(r) <= F.col("upto")) for r in ranks)
    ).select(*[F.col(k).alias(f"_{k}") for k in (*keys, "class")], before.alias("before"), *ranks)
    same = P.all_of(F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, "class"))
    within = Window.partitionBy(*keys, "class").orderBy("price").rowsBetween(Window.unboundedPreceding, 0)
    placed = per_price.join(middle, same).withColumn("upto", F.col("before") + F.sum("n").over(within))
    at = lambda r: F.max(F.when((F.col("upto") - F.col("n") < F.col(r)) & (F.col(r) <= F.col("upto")), F.col("price")))
    medians = placed.groupBy(*keys).agg(((at("lower") + at("upper")) / 2).cast("double").alias("median_price"))
    medians = medians.withColumnsRenamed({k: f"_{k}" for k in keys})
    totals = classes.groupBy(*keys).agg(
        F.sum("item_count").alias("item_count"),
        F.sum("held").alias("priced"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("total_price").cast(TOTAL).alias("total_price"),
    )
    joined = totals.join(medians, P.all_of(F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys), "left")
    return joined.withColumn("avg_price", _average()).drop("priced", *[f"_{k}" for k in keys])


def _report(df: DataFrame, *lead: str) -> DataFrame:
    """Common column set and order of all integrated reports; absent ones are typed NULLs."""
    kinds = {"model": "string", "condition": "string", "currency": "string", "median_price": "double"}
    for column, kind in kinds.items():
        if column not in df.columns:
            df = df.withColumn(column, null_of(kind))
    metrics = ("item_count", "avg_price", "min_price", "max_price", "median_price", "total_price")
    return df.select("shop", *lead, "brand", "model", "condition", "currency", *metrics)


def _by_keys(df: DataFrame, *lead: str) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in ("shop", *lead, *CATALOGUE_KEYS)]
    return df.orderBy(*order)


def integrated_single(
    sold: DataFrame, days: dict[str, date | None], *, detail: str = "brand", keyword: str | None = None
) -> DataFrame:
    """One date per shop: catalogue rows with median, or a brand roll-up."""
    rows = sold.where(P.shop_days(days))
    if keyword is not None:
        rows = rows.where(P.title_contains(keyword))
    if detail == "catalog":
        out = price_metrics_with_median(rows, ("shop", "snapshot_date", *CATALOGUE_KEYS))
    else:
        out = price_metrics(rows, ("shop", "snapshot_date", *BRAND_KEYS))
    return _by_keys(_report(out, "snapshot_date"))


def integrated_range(
    sold: DataFrame,
    start: date,
    end: date,
    *,
    by_day: bool = False,
    detail: str = "brand",
    keyword: str | None = None,
) -> DataFrame:
    """A closed date range: brand roll-up, catalogue rows, or catalogue rows per day with median."""
    rows = sold.where(P.in_range(start, end))
    if keyword is not None:
        rows = rows.where(P.title_contains(keyword))
    if by_day:
        out = price_metrics_with_median(rows, ("shop", "snapshot_date", *CATALOGUE_KEYS)).select(
            "*",
            F.col("snapshot_date").alias("period_start"),
            F.col("snapshot_date").alias("period_end"),
            F.lit(1).cast("long").alias("snapshot_days"),
        )
        lead = ("snapshot_date", "period_start", "period_end", "snapshot_days")
        return _by_keys(_report(out, *lead), "snapshot_date")
    keys = CATALOGUE_KEYS if detail == "catalog" else BRAND_KEYS
    out = price_metrics(
        rows,
        ("shop", *keys),
        F.min("snapshot_date").alias("period_start"),
        F.max("snapshot_date").alias("period_end"),
        F.countDistinct("snapshot_date").alias("snapshot_days"),
    )
    return _by_keys(_report(out, "period_start", "period_end", "snapshot_days"))


def model_sales_single(sold: DataFrame, days: dict[str, date | None], keyword: str) -> DataFrame:
    return integrated_single(sold, days, detail="catalog", keyword=keyword)


def model_sales_range(sold: DataFrame, start: date, end: date, keyword: str, *, by_day: bool = False) -> DataFrame:
    return integrated_range(sold, start, end, by_day=by_day, detail="catalog", keyword=keyword)
