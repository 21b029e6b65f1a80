"""Comparison reports as SQL text with a date parameter, over a view ``sold``."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

# over rows counted per price, so a group's state holds distinct prices, not its rows
_METRICS = """sum(n) AS item_count, CAST(sum(price * n) AS DOUBLE) / nullif(sum(if(price IS NULL, 0, n)), 0) AS avg_price,
    min(price) AS min_price, max(price) AS max_price,
    percentile(CAST(price AS DOUBLE), 0.5, n) AS median_price, CAST(sum(price * n) AS DECIMAL(28,2)) AS total_price"""


def _paired(shop: str) -> str:
    return f"""SELECT min(struct(abs(datediff(snapshot_date, :anchor_date)), snapshot_date)).snapshot_date
    FROM sold WHERE shop = '{shop}'
      AND snapshot_date BETWEEN date_sub(:anchor_date, 3) AND date_add(:anchor_date, 3)"""


def _groups(shop: str, day: str, extra: str = "") -> str:
    return f"""SELECT brand, model, condition{extra}, {_METRICS}
    FROM (SELECT brand, model, condition{extra}, price, count(*) AS n FROM sold
      WHERE shop = '{shop}' AND snapshot_date = {day} GROUP BY brand, model, condition{extra}, price)
    GROUP BY brand, model, condition{extra}"""


def _columns(side: str, prefix: str) -> str:
    names = ("item_count", "avg_price", "min_price", "max_price", "median_price", "total_price")
    return ", ".join(f"{side}.{n} AS {prefix}_{n}" for n in names)


def _on(a: str, b: str) -> str:
    return " AND ".join(f"coalesce({a}.{k}, '') = coalesce({b}.{k}, '')" for k in ("brand", "model", "condition"))


def _keys(a: str, b: str) -> str:
    return ", ".join(f"coalesce({a}.{k}, {b}.{k}) AS {k}" for k in ("brand", "model", "condition"))


SHOP_COMPARISON = f"""
WITH f AS ({_groups('F', ':anchor_date')}),
r AS ({_groups('R', f"({_paired('R')})")}),
both AS (
  SELECT :anchor_date AS f_date, ({_paired('R')}) AS r_date, {_keys('f', 'r')},
    {_columns('f', 'f')}, {_columns('r', 'r')}
  FROM f FULL OUTER JOIN r ON {_on('f', 'r')})
SELECT f_date, r_date, abs(datediff(r_date, f_date)) AS pairing_gap_days, * EXCEPT (f_date, r_date)
FROM both WHERE r_date IS NOT NULL
ORDER BY brand NULLS LAST, model NULLS LAST, condition NULLS LAST"""


def _block(shop: str, label: str) -> str:
    return f"""SELECT '{label}' AS shop, :anchor_date AS v_date, ({_paired(shop)}) AS shop_date, {_keys('v', 's')},
    v.currency, {_columns('v', 'v')}, {_columns('s', 'shop')}
  FROM v LEFT JOIN ({_groups(shop, f"({_paired(shop)})")}) s ON {_on('v', 's')}"""


REFERENCE_COMPARISON = f"""
WITH v AS ({_groups('V', ':anchor_date', ', currency')}),
blocks AS ({_block('F', '竞品F')} UNION ALL {_block('R', '竞品R')})
SELECT shop, v_date, shop_date, abs(datediff(shop_date, v_date)) AS pairing_gap_days,
  * EXCEPT (shop, v_date, shop_date)
FROM blocks WHERE shop_date IS NOT NULL
ORDER BY shop, brand NULLS LAST, model NULLS LAST, condition NULLS LAST, currency NULLS LAST"""

NAMED = {"shop_comparison": SHOP_COMPARISON, "reference_comparison": REFERENCE_COMPARISON}

# fixed values: how a date variable is written for the shell client and for the BI tool
VARIABLE_FORMS = (r":'anchor_date'::date", r"\{\{\s*anchor_date\s*\}\}(?:::date)?")


def with_marker(sql: str) -> str:
    """Either variable form to a named parameter marker."""
    for form in VARIABLE_FORMS:
        sql = re.sub(form, ":anchor_date", sql)
    return sql


def run_named(spark: SparkSession, sold: DataFrame, name_or_sql: str, anchor: date) -> DataFrame:
    """Run a named report, or SQL text of one's own, for an anchor date."""
    sold.createOrReplaceTempView("sold")
    sql = with_marker(NAMED.get(name_or_sql, name_or_sql))
    return spark.sql(sql, args={"anchor_date": anchor})
