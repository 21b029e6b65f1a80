"""Registered queries over the test tables and the SQL text that checks each of them.

Delivered columns are plain: money as double, dates as ISO text, arrays joined, so that two
engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soldscope.operators import catalogue, coverage, facets, pairing, trends
from soldscope.params import Page, Search
from soldscope.plans import comparisons
from soldscope.plans.testtables import SOLD_SQL, sold

Query = Callable[[SparkSession, str], DataFrame]

# the tables' whole time span
START, END = date(1995, 1, 1), date(2001, 12, 31)
DAYS = {"F": date(1998, 1, 15), "R": date(1998, 1, 16), "V": date(1998, 1, 14)}
ANCHOR = date(1998, 1, 1)
SEARCH = Search(
    keywords=("ring",),
    exclude_colors=("hot",),
    conditions=("Excellent", "great"),
    start=START,
    end=END,
)
PICKED = Search(
    keywords=("ring",),
    colors=("red", "blue"),
    conditions=("Excellent",),
    brand="Brand#12",
    product="red ring",
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


CATALOGUE = ("shop", "brand", "model", "condition", "currency", "price", "snapshot_date")
SEARCHED = ("shop", "brand", "model", "condition", "color", "material", "year", "price", "snapshot_date")

# ---------------------------------------------------------------- integrated reports

AVG = "CAST(sum(price) AS DOUBLE) / count(price) AS avg_price"
METRICS = f"""count(*) AS item_count, {AVG},
  CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
  {{median}} AS median_price, CAST(sum(price) AS DOUBLE) AS total_price"""
MEDIAN = "round(quantile_cont(CAST(price AS DOUBLE), 0.5), 3)"
NO_MEDIAN = "CAST(NULL AS DOUBLE)"
DAYS_SQL = " OR ".join(f"(shop = '{s}' AND snapshot_date = DATE '{d}')" for s, d in DAYS.items())
RANGE_SQL = f"snapshot_date BETWEEN DATE '{START}' AND DATE '{END}'"
SPAN = """CAST(min(snapshot_date) AS VARCHAR) AS period_start, CAST(max(snapshot_date) AS VARCHAR) AS period_end,
  count(DISTINCT snapshot_date) AS snapshot_days"""
NAMED = "brand, model, condition, currency"
BRAND_ONLY = "brand, CAST(NULL AS VARCHAR) AS model, CAST(NULL AS VARCHAR) AS condition, CAST(NULL AS VARCHAR) AS currency"


def _single_sql(named: bool, extra: str = "") -> str:
    keys = NAMED if named else "brand"
    return f"""WITH {SOLD_SQL} SELECT shop, CAST(snapshot_date AS VARCHAR) AS snapshot_date, {NAMED if named else BRAND_ONLY},
      {METRICS.format(median=MEDIAN if named else NO_MEDIAN)}
      FROM sold WHERE ({DAYS_SQL}) {extra} GROUP BY shop, snapshot_date, {keys}"""


def _range_sql(named: bool, extra: str = "") -> str:
    keys = NAMED if named else "brand"
    return f"""WITH {SOLD_SQL} SELECT shop, {SPAN}, {NAMED if named else BRAND_ONLY},
      {METRICS.format(median=NO_MEDIAN)}
      FROM sold WHERE {RANGE_SQL} {extra} GROUP BY shop, {keys}"""


def _daily_sql(extra: str = "") -> str:
    return f"""WITH {SOLD_SQL} SELECT shop, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
      CAST(snapshot_date AS VARCHAR) AS period_start, CAST(snapshot_date AS VARCHAR) AS period_end,
      CAST(1 AS BIGINT) AS snapshot_days, {NAMED}, {METRICS.format(median=MEDIAN)}
      FROM sold WHERE {RANGE_SQL} {extra} GROUP BY shop, snapshot_date, {NAMED}"""


@register(
    "shop_daily_trends",
    f"""WITH {SOLD_SQL} SELECT shop, CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS item_count,
    CAST(sum(price) AS DOUBLE) AS total_price, CAST(sum(price) AS DOUBLE) / count(*) AS avg_price
    FROM sold WHERE {RANGE_SQL} GROUP BY shop, snapshot_date""",
)
def _(spark, sf_dir):
    return trends.shop_daily_trends(sold(spark, sf_dir, "shop", "snapshot_date", "price"), START, END)


@register("integrated_single_catalog", _single_sql(True))
def _(spark, sf_dir):
    return catalogue.integrated_single(sold(spark, sf_dir, *CATALOGUE), DAYS, detail="catalog")


@register("integrated_single_brand", _single_sql(False))
def _(spark, sf_dir):
    return catalogue.integrated_single(sold(spark, sf_dir, *CATALOGUE), DAYS)


@register("integrated_range_catalog", _range_sql(True))
def _(spark, sf_dir):
    return catalogue.integrated_range(sold(spark, sf_dir, *CATALOGUE), START, END, detail="catalog")


@register("integrated_range_brand", _range_sql(False))
def _(spark, sf_dir):
    return catalogue.integrated_range(sold(spark, sf_dir, *CATALOGUE), START, END)


@register("integrated_range_daily", _daily_sql())
def _(spark, sf_dir):
    return catalogue.integrated_range(sold(spark, sf_dir, *CATALOGUE), START, END, by_day=True)


@register("model_sales_single", _single_sql(True, "AND model ILIKE '%g%'"))
def _(spark, sf_dir):
    return catalogue.model_sales_single(sold(spark, sf_dir, *CATALOGUE), DAYS, " G ")


@register("model_sales_range", _range_sql(True, "AND model ILIKE '%ring%'"))
def _(spark, sf_dir):
    return catalogue.model_sales_range(sold(spark, sf_dir, *CATALOGUE), END, START, "RING")


@register("model_sales_range_daily", _daily_sql("AND model ILIKE '%r_d%'"))
def _(spark, sf_dir):
    return catalogue.model_sales_range(sold(spark, sf_dir, *CATALOGUE), START, END, "R_d", by_day=True)


# ---------------------------------------------------------------- trends

TREND_SQL = f"""trend AS (
  SELECT snapshot_date, coalesce(currency, '—') AS currency, count(*) AS item_count, sum(price) AS total_price,
    min(price) AS min_price, max(price) AS max_price, {MEDIAN} AS median_price
  FROM sold WHERE {RANGE_SQL} AND model ILIKE '%ring%' AND price > 0
  GROUP BY snapshot_date, sold.currency)"""


def _trend(spark, sf_dir):
    rows = sold(spark, sf_dir, "snapshot_date", "currency", "price", "model")
    return trends.model_price_trend(rows, START, END, "ring")


def _points(spark, sf_dir):
    rows = sold(spark, sf_dir, "snapshot_date", "currency", "price", "model")
    return trends.daily_prices(rows, START, END, "ring")


@register(
    "model_price_trend",
    f"""WITH {SOLD_SQL}, {TREND_SQL} SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, currency, item_count,
    CAST(total_price AS DOUBLE) AS total_price, CAST(min_price AS DOUBLE) AS min_price,
    CAST(max_price AS DOUBLE) AS max_price, median_price,
    CAST(total_price AS DOUBLE) / item_count AS avg_price FROM trend""",
)
def _(spark, sf_dir):
    return _trend(spark, sf_dir)


@register(
    "period_summary",
    f"""WITH {SOLD_SQL}, {TREND_SQL} SELECT CAST(sum(item_count) AS BIGINT) AS item_count,
    round(CAST(sum(total_price) AS DOUBLE) / CAST(sum(item_count) AS BIGINT), 2) AS avg_price,
    CAST(min(min_price) AS DOUBLE) AS min_price, CAST(max(max_price) AS DOUBLE) AS max_price,
    count(DISTINCT snapshot_date) AS snapshot_days FROM trend HAVING count(*) > 0""",
)
def _(spark, sf_dir):
    return trends.period_summary(_points(spark, sf_dir))


@register(
    "trend_currencies",
    f"WITH {SOLD_SQL}, {TREND_SQL} SELECT DISTINCT currency FROM trend WHERE currency IS NOT NULL",
)
def _(spark, sf_dir):
    return trends.currencies(_points(spark, sf_dir))


# ---------------------------------------------------------------- pairing and comparisons

MONTHLY = "monthly AS (SELECT * EXCLUDE (snapshot_date, month_snapshot), month_snapshot AS snapshot_date FROM sold)"


def _monthly(spark, sf_dir, *columns):
    return sold(spark, sf_dir, *columns, "month_snapshot")


@register(
    "nearest_pairing_all",
    f"""WITH {SOLD_SQL}, {MONTHLY},
    a AS (SELECT DISTINCT snapshot_date AS d FROM monthly WHERE shop = 'F'),
    b AS (SELECT DISTINCT snapshot_date AS d FROM monthly WHERE shop = 'R'),
    c AS (SELECT a.d AS anchor, b.d AS pair, abs(b.d - a.d) AS gap,
      row_number() OVER (PARTITION BY a.d ORDER BY abs(b.d - a.d), b.d) AS place
      FROM a LEFT JOIN b ON abs(b.d - a.d) <= 3)
    SELECT CAST(anchor AS VARCHAR) AS anchor_date, CAST(pair AS VARCHAR) AS paired_date,
    CAST(gap AS INTEGER) AS gap_days FROM c WHERE place = 1""",
)
def _(spark, sf_dir):
    rows = _monthly(spark, sf_dir, "shop")
    return pairing.nearest_dates(rows.where("shop = 'F'"), rows.where("shop = 'R'"))


def _agg_sql(name: str, where: str, extra: str = "") -> str:
    return f"""{name} AS (SELECT brand, model, condition {extra}, count(*) AS item_count,
      CAST(sum(price) AS DOUBLE) / count(price) AS avg_price, CAST(min(price) AS DOUBLE) AS min_price,
      CAST(max(price) AS DOUBLE) AS max_price, {MEDIAN} AS median_price, CAST(sum(price) AS DOUBLE) AS total_price
      FROM monthly WHERE {where} GROUP BY brand, model, condition {extra})"""


def _pair_sql(shop: str) -> str:
    return f"""(SELECT snapshot_date FROM (SELECT DISTINCT snapshot_date FROM monthly WHERE shop = '{shop}')
      WHERE abs(snapshot_date - DATE '{ANCHOR}') <= 3
      ORDER BY abs(snapshot_date - DATE '{ANCHOR}'), snapshot_date LIMIT 1)"""


def _cols_sql(alias: str, prefix: str) -> str:
    return ", ".join(f"{alias}.{m} AS {prefix}_{m}" for m in comparisons.METRICS)


def _on_sql(a: str, b: str) -> str:
    return " AND ".join(f"coalesce({a}.{k}, '') = coalesce({b}.{k}, '')" for k in comparisons.GROUP)


TWO_SQL = f"""WITH {SOLD_SQL}, {MONTHLY}, pair AS (SELECT {_pair_sql('R')} AS r_date),
{_agg_sql('f', f"shop = 'F' AND snapshot_date = DATE '{ANCHOR}'")},
{_agg_sql('r', "shop = 'R' AND snapshot_date = (SELECT r_date FROM pair)")},
compared AS (SELECT coalesce(f.brand, r.brand) AS brand, coalesce(f.model, r.model) AS model,
  coalesce(f.condition, r.condition) AS condition, {_cols_sql('f', 'f')}, {_cols_sql('r', 'r')}
  FROM f FULL OUTER JOIN r ON {_on_sql('f', 'r')})"""


def _two(spark, sf_dir):
    return comparisons.compare_two(
        _monthly(spark, sf_dir, "shop", "brand", "model", "condition", "price"), ANCHOR
    )


@register(
    "shop_comparison",
    f"""{TWO_SQL} SELECT '{ANCHOR}' AS f_date, CAST(r_date AS VARCHAR) AS r_date,
    CAST(abs(r_date - DATE '{ANCHOR}') AS INTEGER) AS pairing_gap_days, compared.*
    FROM pair CROSS JOIN compared WHERE r_date IS NOT NULL""",
)
def shop_comparison(spark, sf_dir):
    return _two(spark, sf_dir)


@register(
    "pairing_header",
    f"""{TWO_SQL} SELECT DISTINCT '{ANCHOR}' AS f_date, CAST(r_date AS VARCHAR) AS r_date,
    CAST(abs(r_date - DATE '{ANCHOR}') AS INTEGER) AS pairing_gap_days
    FROM pair CROSS JOIN compared WHERE r_date IS NOT NULL""",
)
def _(spark, sf_dir):
    return comparisons.two_shop_header(_monthly(spark, sf_dir, "shop"), ANCHOR)


@register(
    "brand_summary_wide",
    f"""{TWO_SQL} SELECT brand, CAST(coalesce(sum(f_item_count), 0) AS BIGINT) AS f_items,
    CAST(coalesce(sum(r_item_count), 0) AS BIGINT) AS r_items,
    round(avg(f_avg_price), 8) AS f_avg, round(avg(r_avg_price), 8) AS r_avg
    FROM pair CROSS JOIN compared WHERE r_date IS NOT NULL
    GROUP BY brand ORDER BY f_items DESC, brand LIMIT 15""",
)
def _(spark, sf_dir):
    out = comparisons.brand_summary(_two(spark, sf_dir))
    return out.withColumn("f_avg", F.round("f_avg", 8)).withColumn("r_avg", F.round("r_avg", 8))


def _block_sql(shop: str) -> str:
    s = shop.lower()
    return f"""SELECT '{comparisons.BLOCK_LABEL[shop]}' AS shop, '{ANCHOR}' AS v_date,
      CAST(p_{s} AS VARCHAR) AS shop_date, CAST(abs(p_{s} - DATE '{ANCHOR}') AS INTEGER) AS pairing_gap_days,
      coalesce(v.brand, {s}.brand) AS brand, coalesce(v.model, {s}.model) AS model,
      coalesce(v.condition, {s}.condition) AS condition, v.currency, {_cols_sql('v', 'v')}, {_cols_sql(s, 'shop')}
      FROM pair CROSS JOIN v LEFT JOIN {s} ON {_on_sql('v', s)} WHERE p_{s} IS NOT NULL"""


@register(
    "reference_comparison",
    f"""WITH {SOLD_SQL}, {MONTHLY.replace("month_snapshot AS snapshot_date", "CASE shop WHEN 'V' THEN month_snapshot - 1 ELSE month_snapshot END AS snapshot_date")},
    pair AS (SELECT {_pair_sql('F')} AS p_f, {_pair_sql('R')} AS p_r),
    {_agg_sql('v', f"shop = 'V' AND snapshot_date = DATE '{ANCHOR}'", ", currency")},
    {_agg_sql('f', "shop = 'F' AND snapshot_date = (SELECT p_f FROM pair)")},
    {_agg_sql('r', "shop = 'R' AND snapshot_date = (SELECT p_r FROM pair)")}
    {_block_sql('F')} UNION ALL {_block_sql('R')}""",
)
def _(spark, sf_dir):
    rows = _monthly(spark, sf_dir, *CATALOGUE[:-1])
    day = F.when(F.col("shop") == "V", F.date_sub("snapshot_date", 1)).otherwise(F.col("snapshot_date"))
    return comparisons.compare_reference(rows.withColumn("snapshot_date", day), ANCHOR)


# ---------------------------------------------------------------- faceted search

SCOPE = {
    "wide": f"""price > 0 AND {RANGE_SQL} AND coalesce(brand, '') || ' ' || coalesce(model, '') ILIKE '%ring%'
      AND coalesce(trim(color), '') NOT ILIKE '%hot%'""",
    "conditions": "(trim(condition) ILIKE '%Excellent%' OR trim(condition) ILIKE '%great%')",
    "picked": """price > 0 AND coalesce(brand, '') || ' ' || coalesce(model, '') ILIKE '%ring%'""",
    "picked_colors": "(trim(color) ILIKE '%red%' OR trim(color) ILIKE '%blue%')",
    "picked_conditions": "trim(condition) ILIKE '%Excellent%'",
    "product": "brand = 'Brand#12' AND model = 'red ring'",
}
MATCH_SQL = f"m AS (SELECT * FROM sold WHERE {SCOPE['wide']} AND {SCOPE['conditions']})"
PRICES_SQL = """CAST(sum(price) AS DOUBLE) / count(*) AS avg_price, CAST(min(price) AS DOUBLE) AS min_price,
  CAST(max(price) AS DOUBLE) AS max_price"""


def _searched(spark, sf_dir, *columns):
    return sold(spark, sf_dir, *(columns or SEARCHED))


def _matched(spark, sf_dir):
    columns = [c for c in SEARCHED if c not in ("material", "year")]
    return facets.matching(_searched(spark, sf_dir, *columns), SEARCH)


@register(
    "search_summary",
    f"WITH {SOLD_SQL}, {MATCH_SQL} SELECT count(*) AS sample_count, {PRICES_SQL} FROM m",
)
def _(spark, sf_dir):
    return facets.summary(_matched(spark, sf_dir))


@register(
    "search_trend_extremes",
    f"""WITH {SOLD_SQL}, {MATCH_SQL},
    l AS (SELECT *, nullif(trim(coalesce(brand, '') || ' ' || coalesce(model, '')), '') AS label FROM m
      WHERE snapshot_date IS NOT NULL),
    d AS (SELECT snapshot_date, count(*) AS item_count, {PRICES_SQL}, min(price) AS lo, max(price) AS hi
      FROM l GROUP BY snapshot_date)
    SELECT CAST(d.snapshot_date AS VARCHAR) AS snapshot_date, item_count, avg_price, min_price, max_price,
    (SELECT string_agg(DISTINCT label, '、' ORDER BY label) FROM l
      WHERE l.snapshot_date = d.snapshot_date AND l.price = d.lo) AS min_price_products,
    (SELECT string_agg(DISTINCT label, '、' ORDER BY label) FROM l
      WHERE l.snapshot_date = d.snapshot_date AND l.price = d.hi) AS max_price_products
    FROM d""",
)
def _(spark, sf_dir):
    return facets.trend(_matched(spark, sf_dir))


PRODUCTS_SQL = f"""p AS (SELECT brand, model, count(*) AS sample_count,
  array_to_string(list_sort(list(DISTINCT shop)), '|') AS shops
  FROM m WHERE brand <> '' AND model <> '' GROUP BY brand, model)"""


@register(
    "matched_products",
    f"""WITH {SOLD_SQL}, {MATCH_SQL}, {PRODUCTS_SQL} SELECT brand, model AS product_name, sample_count, shops,
    (SELECT count(*) FROM p) AS matched_product_count FROM p ORDER BY sample_count DESC, brand, model LIMIT 200""",
)
def _(spark, sf_dir):
    return facets.matched_products(_matched(spark, sf_dir))


def _facet_sql(column: str, scope: str, top: int) -> str:
    return f"""WITH {SOLD_SQL}, a AS (SELECT coalesce(nullif(trim({column}), ''), '未知') AS label FROM sold WHERE {scope}),
    g AS (SELECT label, count(*) AS count FROM a GROUP BY label)
    SELECT label, count, floor(count / (SELECT count(*) FROM a) * 1000 + 0.5) / 10 AS percentage
    FROM g ORDER BY count DESC, label LIMIT {top}"""


@register("breakdown_condition", _facet_sql("condition", SCOPE["wide"], 12))
def _(spark, sf_dir):
    rows = _searched(spark, sf_dir, "shop", "brand", "model", "condition", "color", "price", "snapshot_date")
    return facets.condition_breakdown(facets.matching(rows, SEARCH.condition_scope()))


@register("breakdown_color", _facet_sql("color", f"{SCOPE['wide']} AND {SCOPE['conditions']}", 8))
def _(spark, sf_dir):
    rows = _searched(spark, sf_dir, "shop", "brand", "model", "condition", "color", "price", "snapshot_date")
    return facets.color_breakdown(facets.matching(rows, SEARCH.color_scope()))


@register(
    "scope_counts",
    f"""WITH {SOLD_SQL}, w AS (SELECT * FROM sold WHERE {SCOPE['picked']})
    SELECT count(*) FILTER ({SCOPE['picked_colors']} AND {SCOPE['picked_conditions']}) AS query_scope,
    count(*) FILTER ({SCOPE['picked_colors']} AND {SCOPE['product']}) AS condition_scope,
    count(*) FILTER ({SCOPE['picked_conditions']} AND {SCOPE['product']}) AS color_scope FROM w""",
)
def _(spark, sf_dir):
    rows = _searched(spark, sf_dir, "shop", "brand", "model", "condition", "color", "price")
    return facets.scope_counts(rows, PICKED)


@register(
    "top5_share",
    f"""WITH {SOLD_SQL}, {MATCH_SQL}, {PRODUCTS_SQL},
    t AS (SELECT * FROM p ORDER BY sample_count DESC, brand, model LIMIT 5)
    SELECT brand, model AS product_name, brand || ' ' || model AS label, sample_count,
    greatest(1, CAST(floor(sample_count / (SELECT count(*) FROM m) * 100 + 0.5) AS BIGINT)) AS percentage,
    CAST(floor((SELECT sum(sample_count) FROM t) / (SELECT count(*) FROM m) * 100 + 0.5) AS BIGINT)
      AS combined_percentage FROM t""",
)
def _(spark, sf_dir):
    rows = _matched(spark, sf_dir)
    total = rows.agg(F.count("*")).scalar()
    return facets.top_share(facets.matched_products(rows), total)


@register(
    "samples_page",
    f"""WITH {SOLD_SQL}, {MATCH_SQL} SELECT shop, id, item_id, brand, model AS product_name,
    brand || ' ' || model AS label, condition, color, CAST(price AS DOUBLE) AS price,
    CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(NULL AS VARCHAR) AS image_url,
    (SELECT count(*) FROM m) AS total FROM m
    ORDER BY m.snapshot_date DESC, shop, id DESC, m.price DESC, brand, model, condition LIMIT 20 OFFSET 40""",
)
def _(spark, sf_dir):
    rows = _searched(
        spark, sf_dir, "shop", "id", "item_id", "brand", "model", "condition", "color", "price", "snapshot_date"
    )
    blank = F.lit(None).cast("string")
    rows = rows.withColumns({"image": blank, "image_urls": blank, "image_path": blank})
    return facets.sample_page(rows, SEARCH, Page(3))


@register(
    "filter_options",
    f"""WITH {SOLD_SQL}, k AS (SELECT * FROM sold WHERE coalesce(brand, '') || ' ' || coalesce(model, '') ILIKE '%ring%'),
    u AS (SELECT 'color' AS attribute, color AS value FROM k UNION SELECT 'condition', condition FROM k
      UNION SELECT 'material', material FROM k UNION SELECT 'year', year FROM k),
    t AS (SELECT attribute, trim(unnest(string_split(value, '/'))) AS value FROM u WHERE value <> '')
    SELECT DISTINCT attribute, value FROM t WHERE value <> ''""",
)
def _(spark, sf_dir):
    rows = _searched(spark, sf_dir, "shop", "brand", "model", "condition", "color", "material", "year")
    return facets.filter_options(rows, SEARCH)


# ---------------------------------------------------------------- coverage


@register(
    "shop_totals",
    f"""WITH {SOLD_SQL} SELECT coalesce(shop, 'total') AS shop, count(*) AS row_count FROM sold GROUP BY ROLLUP (shop)""",
)
def _(spark, sf_dir):
    return coverage.shop_totals(sold(spark, sf_dir, "shop"))


@register(
    "table_bounds",
    f"""WITH {SOLD_SQL} SELECT coalesce(shop, 'all') AS shop, CAST(min(snapshot_date) AS VARCHAR) AS min_date,
    CAST(max(snapshot_date) AS VARCHAR) AS max_date FROM sold GROUP BY ROLLUP (shop)""",
)
def _(spark, sf_dir):
    return coverage.table_bounds(sold(spark, sf_dir, "shop", "snapshot_date"))


@register(
    "latest_dates",
    f"""WITH {SOLD_SQL} SELECT shop, CAST(max(snapshot_date) AS VARCHAR) AS latest_date FROM sold GROUP BY shop""",
)
def _(spark, sf_dir):
    return coverage.latest_dates(sold(spark, sf_dir, "shop", "snapshot_date"))


@register(
    "default_window",
    f"""WITH {SOLD_SQL} SELECT CAST(greatest(min(snapshot_date), max(snapshot_date) - 30) AS VARCHAR) AS start_date,
    CAST(max(snapshot_date) AS VARCHAR) AS end_date FROM sold""",
)
def _(spark, sf_dir):
    return coverage.default_window(coverage.table_bounds(sold(spark, sf_dir, "shop", "snapshot_date")), 30)


@register(
    "snapshot_summary",
    f"""WITH {SOLD_SQL}, c AS (SELECT shop, snapshot_date, count(*) AS row_count,
      row_number() OVER (PARTITION BY shop ORDER BY snapshot_date DESC NULLS FIRST) AS place
      FROM sold GROUP BY shop, snapshot_date)
    SELECT shop, CAST(snapshot_date AS VARCHAR) AS snapshot_date, row_count FROM c WHERE place <= 20""",
)
def _(spark, sf_dir):
    return coverage.snapshot_summary(sold(spark, sf_dir, "shop", "snapshot_date"))


@register(
    "snapshot_dates",
    f"""WITH {SOLD_SQL} SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM sold WHERE shop = 'V'""",
)
def _(spark, sf_dir):
    return coverage.snapshot_dates(sold(spark, sf_dir, "shop", "snapshot_date"), "V")
