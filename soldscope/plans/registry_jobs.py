"""Registered queries of the landing path, the keyed updates, named SQL and small predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from soldscope.functions import condition
from soldscope.operators import predicates, updates
from soldscope.plans import named_sql
from soldscope.plans.registry import ANCHOR, ORACLES, _monthly, register
from soldscope.plans.testtables import SOLD_SQL, sold, spread, table
from soldscope.sources import landing

FILLERS = 66  # more cells than a narrow reader would keep


@register(
    "landing_records",
    """WITH c AS (SELECT p_partkey, ['F', 'R', 'V'][p_partkey % 3 + 1] AS shop, p_partkey % 28 + 1 AS day, * FROM part)
    SELECT shop, CAST(p_partkey AS VARCHAR) AS item_id, '2026-05-' || lpad(CAST(day AS VARCHAR), 2, '0') AS snapshot_date,
    p_brand AS brand, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
    CASE WHEN shop = 'V' THEN p_size END AS likes, 'deep
' || split_part(p_name, ' ', 1) AS color,
    CASE WHEN shop <> 'V' THEN 'https://x.com/' || p_partkey || '.png' END AS image_path FROM c""",
)
def _(spark, sf_dir):
    part = spread(spark, sf_dir, "part")
    cell = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))
    price = F.format_number(F.col("p_retailprice").cast("decimal(18,2)"), 2)
    pairs = F.array(
        *[cell(f"x{i}", F.lit("v")) for i in range(FILLERS)],
        cell("ID", F.col("p_partkey")),
        cell(" 品牌 ", F.concat(F.lit("  "), "p_brand", F.lit(" "))),
        cell("卖出价格", price),
        cell("颜色", F.concat(F.lit("deep\n"), F.substring_index("p_name", " ", 1))),
        cell("点赞数", F.concat("p_size", F.lit(".0"))),
        cell("图片路径", F.concat(F.lit("https://x.com/"), "p_partkey", F.lit(".png"))),
    )
    shop = F.element_at(F.array(*map(F.lit, "FRV")), (F.col("p_partkey") % 3 + 1).cast("int"))
    name = F.concat(F.lit("2026年5月"), (F.col("p_partkey") % 28 + 1).cast("string"), F.lit("日-x.csv"))
    rows = landing.records(part.select(shop.alias("shop"), name.alias("file_name"), pairs.alias("pairs")))
    return rows.select("shop", "item_id", "snapshot_date", "brand", "price", "likes", "color", "image_path")


def _named(spark, sf_dir, name, shift_v=False):
    rows = _monthly(spark, sf_dir, "shop", "brand", "model", "condition", "price", "currency")
    if shift_v:
        day = F.when(F.col("shop") == "V", F.date_sub("snapshot_date", 1)).otherwise(F.col("snapshot_date"))
        rows = rows.withColumn("snapshot_date", day)
    return named_sql.run_named(spark, rows, name, ANCHOR)


def _rounded(df):
    """Medians to the three digits that the oracle gives."""
    return df.withColumns({c: F.round(c, 3) for c in df.columns if c.endswith("median_price")})


@register("named_shop_comparison", ORACLES["shop_comparison"])
def _(spark, sf_dir):
    return _rounded(_named(spark, sf_dir, "shop_comparison"))


@register("named_reference_comparison", ORACLES["reference_comparison"])
def _(spark, sf_dir):
    return _rounded(_named(spark, sf_dir, "reference_comparison", shift_v=True))


# ---------------------------------------------------------------- keyed updates


@register(
    "restore_raw_fields",
    f"""WITH {SOLD_SQL}, src AS (SELECT shop, item_id, snapshot_date, max({{'b': brand || '*', 'm': model, 'a': material || '*', 'c': color || '*',
      'k': condition}}) AS s FROM sold GROUP BY ALL)
    SELECT t.shop, t.item_id, s.b AS brand, s.c AS color, CASE WHEN t.shop = 'V' THEN s.a END AS material, CAST(NULL AS VARCHAR) AS year, true AS was_changed
    FROM sold t JOIN src ON t.shop = src.shop AND t.item_id = src.item_id AND t.snapshot_date = src.snapshot_date""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "item_id", "snapshot_date", "brand", "model", "condition", "color", "material", "year")
    rows = rows.withColumns({"size": F.lit("M"), "other": F.lit("x")})
    marked = {c: F.concat(c, F.lit("*")) for c in ("brand", "color", "material")}
    done = updates.restore_raw_fields(rows, rows.withColumns(marked))
    return done.select("shop", "item_id", "brand", "color", "material", "year", F.col("_changed").alias("was_changed"))


@register(
    "backfill_old_data",
    f"""WITH {SOLD_SQL} SELECT shop, item_id, CASE WHEN color = 'red' THEN '{{"item_id":"' || item_id || '"}}' ELSE 'kept' END AS old_data,
    color = 'red' AS was_changed FROM sold""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "item_id", "snapshot_date", "color")
    target = rows.withColumn("old_data", F.when(F.col("color") != "red", "kept")).drop("color")
    source = rows.select("shop", "item_id", "snapshot_date", F.to_json(F.struct("item_id")).alias("old_data"))
    return updates.backfill_old_data(target, source).select("shop", "item_id", "old_data", F.col("_changed").alias("was_changed"))


@register(
    "change_counts",
    f"""WITH {SOLD_SQL} SELECT shop, count(*) AS scanned, count(*) FILTER (WHERE color = 'red') AS changed FROM sold GROUP BY shop""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "color")
    return updates.change_counts(rows.select("shop", (F.col("color") == "red").alias("_changed")))


# ---------------------------------------------------------------- predicates and wordings


@register(
    "on_dates_null",
    f"""WITH {SOLD_SQL}, d AS (SELECT shop, CASE WHEN color <> 'red' THEN snapshot_date END AS day FROM sold)
    SELECT shop, CAST(day AS VARCHAR) AS snapshot_date, count(*) AS row_count FROM d
    WHERE day IS NULL OR day IN (DATE '1995-03-01', DATE '1996-07-15') GROUP BY shop, day""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "color", "snapshot_date")
    rows = rows.withColumn("snapshot_date", F.when(F.col("color") != "red", F.col("snapshot_date")))
    picked = rows.where(predicates.on_dates([None, date(1995, 3, 1), date(1996, 7, 15)]))
    return picked.groupBy("shop", "snapshot_date").agg(F.count("*").alias("row_count"))


@register(
    "list_literals",
    f"""WITH {SOLD_SQL} SELECT brand, color LIKE 'r%' AS brand_listed, color LIKE '%e' AS color_listed, count(*) AS row_count FROM sold GROUP BY ALL""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "brand", "color")
    listed = lambda c, when: F.when(when, F.concat(F.lit("['"), c, F.lit("']"))).otherwise(F.col(c))
    shown = rows.select(
        "brand",
        listed("brand", F.col("color").startswith("r")).alias("b"),
        listed("color", F.col("color").endswith("e")).alias("c"),
    )
    marked = shown.select("brand", predicates.is_list_literal("b").alias("brand_listed"), predicates.list_valued_color("c").alias("color_listed"))
    return marked.groupBy("brand", "brand_listed", "color_listed").agg(F.count("*").alias("row_count"))


# the fourteen wordings by a number, and the grades written out
WORDINGS = (
    "CASE id % 15 WHEN 0 THEN ' New ' WHEN 1 THEN 'GIFTABLE' WHEN 2 THEN 'Never worn' WHEN 3 THEN 'Never worn, with tag' "
    "WHEN 4 THEN 'excellent' WHEN 5 THEN 'bc-filter-Great' WHEN 6 THEN 'very good' WHEN 7 THEN 'Good' WHEN 8 THEN 'Shows wear' "
    "WHEN 9 THEN 'Worn' WHEN 10 THEN 'Fair' WHEN 11 THEN 'Very good condition' WHEN 12 THEN 'Good condition' "
    "WHEN 13 THEN 'Fair condition' ELSE '98新/Great' END"
)


@register(
    "all_wordings",
    f"""WITH {SOLD_SQL} SELECT CASE id % 15 WHEN 0 THEN '全新/New' WHEN 1 THEN '全新/Giftable' WHEN 2 THEN '全新/Never worn'
    WHEN 3 THEN '全新/Never worn, with tag' WHEN 4 THEN '99新/Excellent' WHEN 5 THEN '98新/Great' WHEN 6 THEN '97新/Very Good'
    WHEN 7 THEN '95新/Good' WHEN 8 THEN '90新/Shows Wear' WHEN 9 THEN '85新/Worn' WHEN 10 THEN '85新/Fair'
    WHEN 11 THEN '97新/Very good condition' WHEN 12 THEN '95新/Good condition' WHEN 13 THEN '85新/Fair condition' ELSE '98新/Great' END AS grade,
    trim({WORDINGS}) AS cleaned, count(*) AS row_count FROM sold GROUP BY ALL""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "id").select(F.expr(WORDINGS).alias("wording")).groupBy("wording").agg(F.count("*").alias("row_count"))
    graded = condition.with_grade(rows, "wording", "grade")
    return graded.select("grade", condition.normalize_condition("wording").alias("cleaned"), "row_count")
