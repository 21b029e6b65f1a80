"""Currency names and conversion of the V shop's prices to CNY."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.functions import text as X
from soldscope.schema import MONEY

# fixed values: names that mean CNY
CNY_NAMES = ("CNY", "RMB", "CN¥", "¥", "人民币", "元")
CNY = "CNY"
PRICE_COLUMNS = ("price", "seller_price", "buyer_fee")
RATE = "decimal(18,8)"


def is_cny(currency: Column | str) -> Column:
    return F.coalesce(F.upper(X.strip(currency)).isin(*CNY_NAMES), F.lit(False))


def is_usd(currency: Column | str) -> Column:
    return F.coalesce(F.upper(X.strip(currency)) == "USD", F.lit(False))


def usd_to_cny(amount: Column | str, rate: Column) -> Column:
    """Half-up to two decimals."""
    return F.round(X.col(amount) * rate.cast(RATE), 2).cast(MONEY)


def prices_in_cny(df: DataFrame, rate: Decimal | str | Column) -> DataFrame:
    """USD rows converted, other names of CNY unified, unknown currencies untouched."""
    rate = rate if isinstance(rate, Column) else F.lit(str(rate))
    converts = is_usd("currency") & rate.isNotNull()
    changes = {
        c: F.when(converts, usd_to_cny(c, rate)).otherwise(F.col(c)) for c in PRICE_COLUMNS if c in df.columns
    }
    changes["currency"] = F.when(converts | is_cny("currency"), CNY).otherwise(F.col("currency"))
    return df.withColumns(changes)


def prices_in_cny_by_date(df: DataFrame, rates: DataFrame) -> DataFrame:
    """As ``prices_in_cny`` with the rate of the row's snapshot date; a date without one stays USD."""
    daily = rates.groupBy("snapshot_date").agg(F.max("usd_cny").alias("usd_cny"))
    joined = df.join(daily, "snapshot_date", "left")
    return prices_in_cny(joined, F.col("usd_cny")).select(*df.columns)


def currency_distribution(df: DataFrame) -> DataFrame:
    label = F.coalesce(F.nullif(F.trim("currency"), F.lit("")), F.lit("(null)"))
    return (
        df.groupBy(label.alias("currency"))
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.col("row_count").desc(), "currency")
    )


def leftover_currencies(df: DataFrame, examples: int = 20) -> DataFrame:
    """Rows that are neither CNY nor blank: their number, and up to ``examples`` names."""
    rest = df.where((F.trim("currency") != "") & ~is_cny("currency"))
    names = rest.select("currency").distinct().orderBy("currency").limit(examples)
    return rest.agg(
        F.count("*").alias("row_count"),
        F.lit(names.agg(F.array_sort(F.collect_list("currency"))).scalar()).alias("examples"),
    )
