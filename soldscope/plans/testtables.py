"""``sold`` derived from the star-schema test tables, for Spark and as SQL text for the oracle.

Only the dimensions that the asked columns need are joined. Both dimension keys are unique, so a
left join never changes the row count and leaving an unused one out gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soldscope.schema import MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table dealt over all tasks: few bytes, often one row group, but much work per row."""
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _shop() -> Column:
    kind = F.col("l_suppkey") % 3
    return F.when(kind == 0, "F").when(kind == 1, "R").otherwise("V")


def _condition() -> Column:
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "A", "Excellent")
        .when(flag == "N", "bc-filter-Great")
        .when(flag == "R", "Shows Wear")
    )


def _only_v(value: Column) -> Column:
    return F.when(F.col("l_suppkey") % 3 == 2, value)


def _money(value: Column) -> Column:
    return value.cast(MONEY)


def _month_snapshot() -> Column:
    """One snapshot a month, shifted by shop so that pairs lie zero to four days apart."""
    kind = F.col("l_suppkey") % 3
    first = F.trunc("l_shipdate", "month")
    shift = F.when(kind == 0, 0).when(kind == 2, 1).otherwise(F.month("l_shipdate") % 3 * 2)
    return F.date_add(first, shift.cast("int"))


def _columns() -> dict[str, tuple[str | None, Column]]:
    price = _money(F.col("l_extendedprice"))
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return {
        "shop": (None, _shop()),
        "id": (None, key),
        "item_id": (None, key.cast("string")),
        "brand": ("part", F.col("p_brand")),
        "model": ("part", F.col("p_name")),
        "title": (
            "part",
            F.concat_ws(" ", F.initcap("p_name"), F.initcap("p_type"), F.col("p_size").cast("string")),
        ),
        "condition": (None, _condition()),
        "price": (None, price),
        "color": ("part", F.substring_index("p_name", " ", 1)),
        "material": ("part", F.lower("p_type")),
        "year": ("orders", F.year("o_orderdate").cast("string")),
        "currency": (None, _only_v(F.when(F.col("l_linestatus") == "F", "USD").otherwise("CNY"))),
        "seller_price": (None, _only_v(_money(F.round(price * (1 - _money(F.col("l_discount"))), 2)))),
        "buyer_fee": (None, _only_v(_money(F.round(price * _money(F.col("l_tax")), 2)))),
        "likes": (None, F.col("l_quantity").cast("int")),
        "listed_at": ("orders", F.col("o_orderdate")),
        "sold_at": (None, F.col("l_shipdate")),
        "snapshot_date": (None, F.to_date("l_shipdate")),
        "month_snapshot": (None, _month_snapshot()),
        "old_data": (
            "part",
            F.to_json(
                F.struct(
                    F.col("p_brand").alias("brand"),
                    F.col("p_name").alias("model"),
                    _condition().alias("condition"),
                    F.substring_index("p_name", " ", 1).alias("color"),
                )
            ),
        ),
    }


def sold(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Columns ``names`` of ``sold``; ``month_snapshot`` is delivered as ``snapshot_date`` when asked alone."""
    known = _columns()
    needed = {known[n][0] for n in names} - {None}
    items = table(spark, sf_dir, "lineitem")
    if "part" in needed:
        items = items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if "orders" in needed:
        items = items.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    out = []
    for n in names:
        alias = "snapshot_date" if n == "month_snapshot" and "snapshot_date" not in names else n
        out.append(known[n][1].alias(alias))
    return items.select(*out)


SOLD_SQL = """
sold AS (
  SELECT
    CASE l_suppkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'R' ELSE 'V' END AS shop,
    l_orderkey * 10 + l_linenumber AS id,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS item_id,
    p_brand AS brand,
    p_name AS model,
    CASE l_returnflag WHEN 'A' THEN 'Excellent' WHEN 'N' THEN 'bc-filter-Great' WHEN 'R' THEN 'Shows Wear' END AS condition,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    split_part(p_name, ' ', 1) AS color,
    lower(p_type) AS material,
    CAST(year(o_orderdate) AS VARCHAR) AS year,
    CASE WHEN l_suppkey % 3 = 2 THEN CASE WHEN l_linestatus = 'F' THEN 'USD' ELSE 'CNY' END END AS currency,
    CASE WHEN l_suppkey % 3 = 2 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DECIMAL(18,2)) END AS seller_price,
    CASE WHEN l_suppkey % 3 = 2 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) END AS buyer_fee,
    CAST(l_shipdate AS DATE) AS snapshot_date,
    CAST(date_trunc('month', l_shipdate) AS DATE)
      + CASE l_suppkey % 3 WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE CAST(month(l_shipdate) % 3 * 2 AS INTEGER) END AS month_snapshot
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
)
"""
