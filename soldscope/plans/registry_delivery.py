"""Queries of the import, of the jobs that rewrite a store, of whole requests and of ordered delivery.

Jobs work on a store of their own below the shared checkpoint folder, filled from the test tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soldscope.operators import catalogue, facets, projections, trends, updates
from soldscope.operators.ordinal import numbered
from soldscope.plans import reformat, search
from soldscope.plans.registry import DAYS, END, MATCH_SQL, ORACLES, SEARCH, START, _matched, _searched, register
from soldscope.plans.registry_fields import GRADE_SQL
from soldscope.plans.registry_titles import MODEL_SQL, SIZED_SQL
from soldscope.plans.testtables import SOLD_SQL, sold, spread, table
from soldscope.schema import SHOPS
from soldscope.session import checkpoint_root
from soldscope.sources import landing
from soldscope.sources.rollup import PriceRollup, TitleIndex
from soldscope.sources.store import SnapshotStore

NULL_TEXT = "CAST(NULL AS VARCHAR)"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _by_year(rows: DataFrame) -> DataFrame:
    return rows.withColumn("snapshot_date", F.trunc("snapshot_date", "year"))


def _stored(spark: SparkSession, sf_dir: str, *names: str, **more: Column) -> SnapshotStore:
    """A store of the asked columns, by shop and year."""
    rows = _by_year(sold(spark, sf_dir, "shop", "id", "item_id", "snapshot_date", *names)).withColumns(more)
    store = SnapshotStore(spark, _folder(spark, "store"))
    store.overwrite_dates(rows)
    return store


# ---------------------------------------------------------------- import

SHOP_OF_PART = "['F', 'R', 'V'][p_partkey % 3 + 1]"
RAW_WORDING = "CASE p_size % 3 WHEN 0 THEN 'Excelent' WHEN 1 THEN 'bc-filter-Great' ELSE 'kept as it is' END"


def _raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as a snapshot file of a part's shop would hold them."""
    part = spread(spark, sf_dir, "part")
    cell = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))
    shop = F.element_at(F.array(*map(F.lit, SHOPS)), (F.col("p_partkey") % 3 + 1).cast("int"))
    pairs = F.array(
        cell("id", F.col("p_partkey")),
        cell("品牌", F.concat(F.lit("['"), "p_brand", F.lit("', 'Other']"))),
        cell("型号", F.col("p_name")),
        cell("材质", F.lit("Cuir")),
        cell("成色", F.expr(RAW_WORDING)),
        cell("卖出价格", F.format_number(F.col("p_retailprice").cast("decimal(18,2)"), 2)),
        cell("货币", F.lit("usd")),
        cell("颜色", F.concat(F.substring_index("p_name", " ", 1), F.lit("/Greys"))),
        cell("图片", F.lit("https://x.com/1.png")),
    )
    return part.select(shop.alias("shop"), F.lit("_20260501_x.csv").alias("file_name"), pairs.alias("pairs"))


@register(
    "prepare_import",
    f"""WITH p AS (SELECT *, {SHOP_OF_PART} AS shop, CAST(p_retailprice AS DECIMAL(18,2)) AS money, split_part(p_name, ' ', 1) AS hue,
      {RAW_WORDING} AS wording, CASE p_size % 3 WHEN 0 THEN '99新/Excellent' WHEN 1 THEN '98新/Great' ELSE 'kept as it is' END AS grade FROM part)
    SELECT shop, CAST(p_partkey AS VARCHAR) AS item_id, '2026-05-01' AS snapshot_date, lower(p_brand) AS brand, {NULL_TEXT} AS model,
      CASE WHEN shop = 'V' THEN 'Cuir' END AS material, grade AS condition,
      CASE hue WHEN 'red' THEN 'gray/red' WHEN 'blue' THEN 'blue/gray' ELSE 'gray/' || hue END AS color,
      CAST(CASE WHEN shop = 'V' THEN money * 7 ELSE money END AS DOUBLE) AS price, CASE WHEN shop = 'V' THEN 'CNY' END AS currency,
      {NULL_TEXT} AS image,
      '{{"item_id":"' || p_partkey || '","brand":"[''' || p_brand || ''', ''Other'']","' || CASE WHEN shop = 'V' THEN 'product_name' ELSE 'model' END
        || '":"' || p_name || '"' || CASE WHEN shop = 'V' THEN ',"material":"Cuir","color":"' || hue || '/Greys","condition":"' || wording || '"'
        ELSE ',"condition":"' || wording || '","color":"' || hue || '/Greys"' END
        || ',"price":"' || money || '"' || CASE WHEN shop = 'V' THEN ',"currency":"usd"' ELSE '' END || '}}' AS old_data
    FROM p""",
)
def _(spark, sf_dir):
    """Cells to stored rows: brand, color and condition cleaned, title blank, V in CNY, images off, raw record kept."""
    done = landing.prepare(landing.records(_raw_cells(spark, sf_dir)), usd_cny="7", keep_images=False)
    return done.select(
        "shop", "item_id", "snapshot_date", "brand", "model", "material", "condition", "color", "price", "currency", "image", "old_data"
    )


@register(
    "csv_landing",
    f"""SELECT {SHOP_OF_PART} AS shop, CAST(p_partkey AS VARCHAR) AS item_id, 'a, "b"
' || p_brand AS brand, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price, split_part(p_name, ' ', 1) AS color,
    {NULL_TEXT} AS snapshot_date FROM part""",
)
def _(spark, sf_dir):
    """CSV files with separators, quotes and line breaks in their cells, written, listed and read back by byte ranges."""
    root = _folder(spark, "landing")
    part = table(spark, sf_dir, "part")
    for place, shop in enumerate(SHOPS):
        rows = part.where(F.col("p_partkey") % 3 == place).select(
            F.concat(F.lit('a, "b"\n'), "p_brand").alias("品牌"),
            F.col("p_partkey").alias("ID"),
            F.format_number(F.col("p_retailprice").cast("decimal(18,2)"), 2).alias("价格"),
            F.substring_index("p_name", " ", 1).alias("颜色"),
        )
        rows.write.options(header="true", escape='"').csv(f"{root}/{shop}")
    rows = landing.records(landing.read_cells(spark, root))
    return rows.select("shop", "item_id", "brand", "price", "color", "snapshot_date")


# ---------------------------------------------------------------- jobs

CHANGED_SQL = """'brand|' || CASE WHEN shop = 'V' THEN 'product_name' ELSE 'model' END || CASE WHEN condition IS NULL THEN '' ELSE '|condition' END"""


def _title_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _by_year(sold(spark, sf_dir, "shop", "id", "item_id", "snapshot_date", "brand", "title", "condition", "color", "material"))
    blank = F.lit(None).cast("string")
    # the test tables repeat order lines, so the title tells rows of one id apart
    item = F.concat_ws("-", "item_id", "brand", "title")
    return rows.withColumn("item_id", item).withColumnRenamed("title", "model").withColumns({"year": blank, "other": blank, "old_data": blank})


@register(
    "preview_entries",
    f"""WITH {SIZED_SQL} SELECT shop AS "table", {CHANGED_SQL} AS changed_fields, {MODEL_SQL} AS model_after, {GRADE_SQL} AS condition_after,
      color AS color_after, material AS material_after, true AS changed, count(*) AS row_count FROM sold GROUP BY ALL""",
)
def _(spark, sf_dir):
    """What a format run would change, row by row, counted by what changes and to what."""
    entries = reformat.preview(_title_rows(spark, sf_dir))
    after = F.col("after")
    shown = entries.select(
        "table",
        F.array_join("changed_fields", "|").alias("changed_fields"),
        F.coalesce(after["model"], after["product_name"]).alias("model_after"),
        *[after[c].alias(f"{c}_after") for c in ("condition", "color", "material")],
        "changed",
    )
    return shown.groupBy(*shown.columns).agg(F.count("*").alias("row_count"))


@register(
    "refill_changes",
    f"""WITH {SIZED_SQL}, s AS (SELECT shop, id % 5 = 0 AS skip, CASE WHEN id % 5 = 0 THEN model || ' ' || material || ' ' || size ELSE {MODEL_SQL} END AS title FROM sold)
    SELECT shop, title AS model, count(*) AS row_count, (SELECT count(*) FROM s x WHERE x.shop = s.shop AND NOT skip) AS scanned,
      (SELECT count(*) FROM s x WHERE x.shop = s.shop AND NOT skip) AS changed, (SELECT count(*) FROM s x WHERE x.shop = s.shop AND skip) AS skipped
    FROM s GROUP BY shop, title""",
)
def _(spark, sf_dir):
    """A store refilled from exported entries, a fifth of them without raw fields: its titles, and the job's counts."""
    store = SnapshotStore(spark, _folder(spark, "store"))
    for shop in SHOPS:  # a shop's shuffles are gone before the next one's
        store.overwrite_dates(_title_rows(spark, sf_dir).where(F.col("shop") == shop))
    entries = reformat.preview(store.read()).withColumn("old_data", F.when(F.col("id") % 5 != 0, F.col("old_data")))
    counts = reformat.refill(store, entries)
    titles = store.read().groupBy("shop", F.lower("model").alias("model")).agg(F.count("*").alias("row_count"))
    return titles.join(counts, "shop")


@register(
    "backfill_images",
    f"""WITH {SOLD_SQL}, s AS (SELECT *, id % 2 = 0 AND (shop = 'V' OR id % 3 <> 0) AS hit FROM sold)
    SELECT shop, item_id, CASE WHEN hit THEN 'https://x.com/' || id || '.png' WHEN id % 3 = 0 THEN 'kept' ELSE ' ' END AS image_path,
      {NULL_TEXT} AS image, hit AS was_changed FROM s""",
)
def _(spark, sf_dir):
    """Images of rows that show none, from source rows that hold a URL."""
    rows = sold(spark, sf_dir, "shop", "id", "item_id", "snapshot_date")
    blank = F.lit(None).cast("string")
    target = rows.withColumns({"image_path": F.when(F.col("id") % 3 == 0, "kept").otherwise(" "), "image_urls": blank, "image": blank})
    url = F.when(F.col("id") % 2 == 0, F.concat(F.lit("https://x.com/"), F.col("id").cast("string"), F.lit(".png"))).otherwise("no address")
    source = rows.select("shop", "item_id", "snapshot_date", url.alias("image_path"), blank.alias("image_urls"), blank.alias("image"))
    done = updates.backfill_images(target, source)
    return done.select("shop", "item_id", "image_path", "image", F.col("_changed").alias("was_changed"))


@register(
    "repair_colors",
    f"""WITH {SOLD_SQL}, c AS (SELECT shop, id % 2 = 0 AS listed FROM sold),
    r AS (SELECT shop, CASE WHEN NOT listed THEN 'Reds' WHEN shop = 'F' THEN 'gray/red' ELSE '[''Reds'', ''Grey'']' END AS color, listed FROM c)
    SELECT shop, color, count(*) AS row_count,
      CASE WHEN shop = 'F' THEN (SELECT count(*) FROM c WHERE shop = 'F') END AS scanned,
      CASE WHEN shop = 'F' THEN (SELECT count(*) FROM c WHERE shop = 'F' AND listed) END AS changed
    FROM r GROUP BY shop, color""",
)
def _(spark, sf_dir):
    """Colors that are still list literals recomputed in one shop's partitions."""
    color = F.when(F.col("id") % 2 == 0, "['Reds', 'Grey']").otherwise("Reds")
    store = _stored(spark, sf_dir, color=color)
    counts = reformat.repair_colors(store)
    return store.read().groupBy("shop", "color").agg(F.count("*").alias("row_count")).join(counts, "shop", "left")


@register(
    "currency_update",
    f"""WITH {SOLD_SQL} SELECT shop, CASE WHEN shop = 'V' THEN 'CNY' END AS currency, count(*) AS row_count,
      CAST(sum(CASE WHEN currency = 'USD' THEN price * 7 ELSE price END) AS DOUBLE) AS price,
      CAST(sum(CASE WHEN currency = 'USD' THEN seller_price * 7 ELSE seller_price END) AS DOUBLE) AS seller_price,
      CASE WHEN shop = 'V' THEN (SELECT count(*) FROM sold WHERE shop = 'V') END AS scanned,
      CASE WHEN shop = 'V' THEN (SELECT count(*) FROM sold WHERE shop = 'V') END AS changed
    FROM sold GROUP BY shop, (shop = 'V')""",
)
def _(spark, sf_dir):
    """Stored dollar rows to CNY at one rate, and other names of CNY made one."""
    renamed = F.when(F.col("currency") == "CNY", "RMB").otherwise(F.col("currency"))
    store = _stored(spark, sf_dir, "price", "seller_price", "currency", currency=renamed)
    counts = reformat.normalize_currency(store, "7")
    sums = store.read().groupBy("shop", "currency").agg(
        F.count("*").alias("row_count"), *[F.sum(c).cast("double").alias(c) for c in ("price", "seller_price")]
    )
    return sums.join(counts, "shop", "left")


# ---------------------------------------------------------------- whole requests


def _answer_sql(answer: str, name: str, count: str, value: str, oracle: str) -> str:
    return f"SELECT '{answer}' AS answer, {name} AS name, CAST({count} AS BIGINT) AS n, CAST({value} AS DOUBLE) AS value FROM ({ORACLES[oracle]})"


@register(
    "product_analysis",
    " UNION ALL ".join(
        (
            _answer_sql("summary", "'all'", "sample_count", "avg_price", "search_summary"),
            _answer_sql("trend", "snapshot_date", "item_count", "max_price", "search_trend_extremes"),
            _answer_sql("products", "brand || ' ' || product_name", "sample_count", "matched_product_count", "matched_products"),
            _answer_sql("top_products", "label", "sample_count", "percentage", "top5_share"),
            _answer_sql("by_condition", "label", '"count"', "percentage", "breakdown_condition"),
            _answer_sql("by_color", "label", '"count"', "percentage", "breakdown_color"),
        )
    ),
)
def _(spark, sf_dir):
    """All answers of one search request, read off one checkpointed roll-up."""
    rows = _searched(spark, sf_dir, "shop", "brand", "model", "condition", "color", "price", "snapshot_date")
    found = search.product_analysis(rows, SEARCH)

    def shown(answer: str, name: Column, count: str, value: str) -> DataFrame:
        return found[answer].select(
            F.lit(answer).alias("answer"), name.cast("string").alias("name"), F.col(count).cast("long").alias("n"), F.col(value).cast("double").alias("value")
        )

    out = shown("summary", F.lit("all"), "sample_count", "avg_price")
    for part in (
        shown("trend", F.col("snapshot_date"), "item_count", "max_price"),
        shown("products", F.concat_ws(" ", "brand", "product_name"), "sample_count", "matched_product_count"),
        shown("top_products", F.col("label"), "sample_count", "percentage"),
        shown("by_condition", F.col("label"), "count", "percentage"),
        shown("by_color", F.col("label"), "count", "percentage"),
    ):
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------- maintained roll-ups

QUARTERS = "FROM (SELECT * REPLACE (CAST(date_trunc('quarter', snapshot_date) AS DATE) AS snapshot_date) FROM sold) sold WHERE"


def _rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted prices of a store that was filled, corrected and added to, refreshed after each step."""
    names = ("shop", "id", "item_id", "snapshot_date", "brand", "model", "condition", "currency", "price")
    rows = sold(spark, sf_dir, *names).withColumn("snapshot_date", F.trunc("snapshot_date", "quarter"))
    store = SnapshotStore(spark, _folder(spark, "store"))
    prices = PriceRollup(store)
    year = F.year("snapshot_date")
    store.overwrite_dates(rows.where(year < 1999).withColumn("price", F.when(year == 1997, F.col("price") + 1).otherwise(F.col("price"))))
    prices.refresh()
    store.overwrite_dates(rows.where(year == 1997))  # dates that come again
    store.overwrite_dates(rows.where((year >= 1999) | year.isNull()))  # new dates
    prices.refresh()
    return prices.read()


@register("rollup_range_daily", ORACLES["integrated_range_daily"].replace("FROM sold WHERE", QUARTERS))
def _(spark, sf_dir):
    """The daily report from counted prices kept beside the store."""
    return catalogue.integrated_range(_rolled_up(spark, sf_dir), START, END, by_day=True)


@register("rollup_range_catalog", ORACLES["integrated_range_catalog"].replace("FROM sold WHERE", QUARTERS))
def _(spark, sf_dir):
    return catalogue.integrated_range(_rolled_up(spark, sf_dir), START, END, detail="catalog")


@register("rollup_price_trend", ORACLES["model_price_trend"].replace("FROM sold WHERE", QUARTERS))
def _(spark, sf_dir):
    return trends.model_price_trend(_rolled_up(spark, sf_dir), START, END, "ring")


EDGES_SQL = f"""l AS (SELECT *, nullif(trim(coalesce(brand, '') || ' ' || coalesce(model, '')), '') AS label FROM m WHERE snapshot_date IS NOT NULL),
  d AS (SELECT snapshot_date, min(price) AS lo, max(price) AS hi FROM l GROUP BY snapshot_date),
  e AS (SELECT DISTINCT snapshot_date, 'low' AS edge, label FROM l JOIN d USING (snapshot_date) WHERE price = lo
    UNION ALL SELECT DISTINCT snapshot_date, 'high', label FROM l JOIN d USING (snapshot_date) WHERE price = hi)"""


@register(
    "edge_labels",
    f"""WITH {SOLD_SQL}, {MATCH_SQL}, {EDGES_SQL} SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, edge,
    row_number() OVER (PARTITION BY snapshot_date, edge ORDER BY label) AS rank, label FROM e""",
)
def _(spark, sf_dir):
    return facets.edge_labels(_matched(spark, sf_dir))


@register(
    "edge_heads",
    f"""WITH {SOLD_SQL}, {MATCH_SQL}, {EDGES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY snapshot_date, edge ORDER BY label) AS rank FROM e)
    SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, edge, string_agg(label, '、' ORDER BY rank) FILTER (WHERE rank <= 1) AS labels,
    count(*) AS label_count FROM r GROUP BY snapshot_date, edge""",
)
def _(spark, sf_dir):
    return facets.edge_heads(facets.edge_labels(_matched(spark, sf_dir)), 1)


@register("indexed_search", ORACLES["search_summary"])
def _(spark, sf_dir):
    """The search summary over the partitions that an index of titles leaves, one of them not indexed yet."""
    names = ("shop", "id", "item_id", "snapshot_date", "brand", "model", "condition", "color", "price")
    rows = sold(spark, sf_dir, *names)
    # folders by year; the true day is what the search asks for
    rows = rows.withColumns({"sold_at": F.col("snapshot_date").cast("timestamp"), "snapshot_date": F.trunc("snapshot_date", "year")})
    store = SnapshotStore(spark, _folder(spark, "store"))
    index = TitleIndex(store)
    store.overwrite_dates(rows.where(F.year("snapshot_date") != 1998))
    index.refresh()
    store.overwrite_dates(rows.where(F.year("snapshot_date") == 1998))
    left = index.rows(SEARCH.keywords).withColumn("snapshot_date", F.to_date("sold_at"))
    return facets.summary(facets.matching(left, SEARCH))


# ---------------------------------------------------------------- order and delivery

REPORT_ORDER = ("shop", "snapshot_date", "brand", "model", "condition", "currency")


@register(
    "ordered_report",
    f"""SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in REPORT_ORDER)}) AS place
    FROM ({ORACLES['integrated_single_catalog']})""",
)
def _(spark, sf_dir):
    """The report with each row's place in the delivered order, NULLs last; no task sees the whole report."""
    rows = sold(spark, sf_dir, "shop", "brand", "model", "condition", "currency", "price", "snapshot_date")
    report = catalogue.integrated_single(rows, DAYS, detail="catalog")
    return numbered(report, [F.col(c).asc_nulls_last() for c in REPORT_ORDER])


@register(
    "samples_deep_page",
    ORACLES["samples_page"].replace("LIMIT 20 OFFSET 40", "LIMIT 20 OFFSET 280"),
)
def _(spark, sf_dir):
    """A page far down, by the places of the rows instead of a sort that skips all rows before."""
    rows = _searched(spark, sf_dir, "shop", "id", "item_id", "brand", "model", "condition", "color", "price", "snapshot_date")
    blank = F.lit(None).cast("string")
    rows = rows.withColumns({"image": blank, "image_urls": blank, "image_path": blank})
    return facets.placed_sample_page(facets.placed_samples(rows, SEARCH), 15, 20)


@register(
    "delivery_trend",
    f"""SELECT CAST(snapshot_date AS VARCHAR) AS "快照日期", strftime(CAST(snapshot_date AS DATE), '%m/%d') AS day, avg_price AS "均价",
    min_price AS "最低价", max_price AS "最高价", min_price_products, max_price_products FROM ({ORACLES['search_trend_extremes']})
    WHERE CAST(snapshot_date AS DATE) BETWEEN DATE '{START}' AND DATE '1998-06-30'""",
)
def _(spark, sf_dir):
    """Chart points of a trend inside the picked interval, under the names they are delivered by."""
    points = projections.chart_points(facets.trend(_matched(spark, sf_dir)), START, END.replace(year=1998, month=6, day=30))
    return projections.for_delivery(points)


@register(
    "tagged_shops",
    f"""WITH {SOLD_SQL} SELECT shop, model, CASE WHEN shop = 'V' THEN currency END AS currency,
      CASE WHEN shop = 'R' THEN strftime(snapshot_date, '%Y-%m-%d') WHEN shop = 'F' THEN CAST(snapshot_date AS VARCHAR) END AS day, count(*) AS row_count
    FROM sold GROUP BY ALL""",
)
def _(spark, sf_dir):
    """Three shop tables of different shape tagged and put together, days from timestamps, texts and neither."""
    rows = sold(spark, sf_dir, "shop", "model", "currency", "snapshot_date")
    alone = {s: rows.where(F.col("shop") == s).drop("shop") for s in SHOPS}
    stamp = {
        "F": F.col("snapshot_date").cast("string"),
        "R": F.concat(F.col("snapshot_date").cast("string"), F.lit("T10:00:00Z")),
        "V": F.lit("no date"),
    }
    tables = [projections.shop_rows(alone[s].withColumn("stamp", stamp[s]), s) for s in ("F", "R")]
    tables = [t.drop("currency").withColumn("currency", F.lit(None).cast("string")) for t in tables]
    tables.append(projections.shop_rows(alone["V"].withColumn("stamp", stamp["V"]).withColumnRenamed("model", "product_name"), "V"))
    union = tables[0].unionByName(tables[1]).unionByName(tables[2])
    shown = union.select("shop", "model", "currency", projections.iso_day("stamp").alias("day"))
    return shown.groupBy("shop", "model", "currency", "day").agg(F.count("*").alias("row_count"))
