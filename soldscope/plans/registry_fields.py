"""Registered queries of field normalisation, titles, URLs, selection and updates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from soldscope.functions import color, condition, money, names, text, urls, year
from soldscope.operators import coverage, images, lexicon, parse_results, titles, updates
from soldscope.plans.reformat import format_rows
from soldscope.plans.registry import register
from soldscope.plans.testtables import SOLD_SQL, sold, spread, table
from soldscope.sources.selection import files_to_backfill, select_files

RATE = "6.801586"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# ---------------------------------------------------------------- values

ALIAS_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in color.ALIASES.items()) + "}"
RANK_SQL = "MAP {" + ", ".join(f"'{k}': '{i:02d}'" for i, k in enumerate(color.CANONICAL)) + "}"
TITLE_SQL = "MAP {" + ", ".join(f"'{k}': '{v.title()}'" for k, v in color.ENGLISH.items()) + "}"
GRADE_SQL = "CASE condition WHEN 'Excellent' THEN '99新/Excellent' WHEN 'bc-filter-Great' THEN '98新/Great' WHEN 'Shows Wear' THEN '90新/Shows Wear' END"


@register(
    "color_normalize",
    f"""WITH {SOLD_SQL},
    raw AS (SELECT replace(model, ' ', '/') || '/Greys' AS raw_color, count(*) AS row_count FROM sold GROUP BY ALL),
    t AS (SELECT *, list_distinct(list_transform(string_split(lower(raw_color), '/'),
      lambda w: coalesce({ALIAS_SQL}[w], w))) AS names FROM raw)
    SELECT raw_color, row_count, array_to_string(list_transform(list_sort(list_transform(names,
      lambda w: coalesce({RANK_SQL}[w], '99') || w)), lambda w: w[3:]), '/') AS color FROM t""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "model")
    raw = F.concat(F.replace("model", F.lit(" "), F.lit("/")), F.lit("/Greys")).alias("raw_color")
    counted = rows.groupBy(raw).agg(F.count("*").alias("row_count"))
    return counted.withColumn("color", color.normalize_color("raw_color"))


@register(
    "color_display",
    f"""WITH {SOLD_SQL} SELECT shop, color, coalesce({TITLE_SQL}[color], upper(color[1]) || color[2:]) AS shown,
    count(*) AS row_count FROM sold GROUP BY shop, color""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "color").groupBy("shop", "color").agg(F.count("*").alias("row_count"))
    return rows.withColumn("shown", color.display_color("color"))


@register(
    "condition_grade",
    f"""WITH {SOLD_SQL} SELECT condition, {GRADE_SQL} AS grade, count(*) AS row_count FROM sold GROUP BY condition""",
)
def _(spark, sf_dir):
    counted = sold(spark, sf_dir, "condition").groupBy("condition").agg(F.count("*").alias("row_count"))
    return condition.with_grade(counted, "condition", "grade").select("condition", "grade", "row_count")


@register(
    "fuzzy_grade",
    f"""WITH {SOLD_SQL} SELECT condition[:-2] AS wording, {GRADE_SQL} AS grade, count(*) AS row_count
    FROM sold GROUP BY condition""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "condition").select(F.expr("left(condition, length(condition) - 1)").alias("wording"))
    counted = rows.groupBy("wording").agg(F.count("*").alias("row_count"))
    return condition.with_grade(counted, "wording", "grade").select("wording", "grade", "row_count")


@register(
    "accent_fold",
    """SELECT doc_id, md5(lower(replace(replace(replace(replace(strip_accents(
      regexp_replace(text, '^\\s+|\\s+$', '', 'g')), 'œ', 'oe'), 'Œ', 'OE'), 'æ', 'ae'), 'Æ', 'AE'))) AS folded
    FROM documents""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(text.english_lower("text")).alias("folded"))


@register(
    "json_field",
    """SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS row_count FROM events GROUP BY ALL""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type", parse_results.old_value("k", "props").alias("k")).agg(
        F.count("*").alias("row_count")
    )


@register(
    "fx_to_cny",
    f"""WITH {SOLD_SQL} SELECT id, CAST(price AS DOUBLE) AS usd_price,
    CASE WHEN currency = 'USD' THEN CAST(round(price * CAST({RATE} AS DECIMAL(18,8)), 2) AS DOUBLE) ELSE CAST(price AS DOUBLE) END AS price,
    CASE WHEN currency = 'USD' THEN CAST(round(seller_price * CAST({RATE} AS DECIMAL(18,8)), 2) AS DOUBLE) ELSE CAST(seller_price AS DOUBLE) END AS seller_price,
    CASE WHEN currency = 'USD' THEN CAST(round(buyer_fee * CAST({RATE} AS DECIMAL(18,8)), 2) AS DOUBLE) ELSE CAST(buyer_fee AS DOUBLE) END AS buyer_fee,
    CASE WHEN currency IS NOT NULL THEN 'CNY' END AS currency FROM sold""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "id", "price", "seller_price", "buyer_fee", "currency")
    return money.prices_in_cny(rows.withColumn("usd_price", F.col("price")), RATE)


@register(
    "fx_by_date",
    f"""WITH {SOLD_SQL}, rates AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(max(6 + o_orderkey % 100 / 100) AS DECIMAL(18,8)) AS rate
      FROM orders GROUP BY ALL)
    SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CASE WHEN currency = 'USD' AND rate IS NOT NULL THEN 'CNY' ELSE currency END AS currency,
    count(*) AS row_count, CAST(sum(CASE WHEN currency = 'USD' AND rate IS NOT NULL THEN CAST(round(price * rate, 2) AS DECIMAL(18,2)) ELSE price END) AS DOUBLE) AS total
    FROM sold LEFT JOIN rates ON snapshot_date = day GROUP BY ALL""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rates = orders.select(
        F.to_date("o_orderdate").alias("snapshot_date"),
        (6 + F.col("o_orderkey") % 100 / 100).cast("decimal(18,8)").alias("usd_cny"),
    )
    rows = money.prices_in_cny_by_date(sold(spark, sf_dir, "snapshot_date", "price", "currency"), rates)
    return rows.groupBy("snapshot_date", "currency").agg(
        F.count("*").alias("row_count"), F.sum("price").alias("total")
    )


@register(
    "currency_distribution",
    f"""WITH {SOLD_SQL} SELECT coalesce(nullif(trim(currency), ''), '(null)') AS currency, count(*) AS row_count
    FROM sold GROUP BY 1""",
)
def _(spark, sf_dir):
    return money.currency_distribution(sold(spark, sf_dir, "currency"))


@register(
    "leftover_currencies",
    f"""WITH {SOLD_SQL}, r AS (SELECT currency FROM sold WHERE trim(currency) <> '' AND upper(trim(currency)) <> 'CNY')
    SELECT count(*) AS row_count, (SELECT string_agg(DISTINCT currency, '|' ORDER BY currency) FROM r) AS examples FROM r""",
)
def _(spark, sf_dir):
    return money.leftover_currencies(sold(spark, sf_dir, "currency"))


@register(
    "year_stamp",
    f"""WITH {SOLD_SQL} SELECT id, regexp_extract(model || ' ' || upper(color[1]) || '/' || year, '[A-Z]/[0-9]{{4}}') AS stamp FROM sold""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "id", "model", "color", "year")
    title = F.concat_ws(" ", "model", F.concat(F.upper(F.substring("color", 1, 1)), F.lit("/"), F.col("year")))
    return rows.select("id", title.alias("title")).select("id", year.extract_year("title").alias("stamp"))


# ---------------------------------------------------------------- URLs

EXT_SQL = """CASE regexp_extract(regexp_extract(url, '^https?://[^/]+([^?#]*)', 1), '\\.([^.]*)$', 1)
  WHEN 'jpeg' THEN '.jpg' WHEN 'png' THEN '.png' WHEN 'gif' THEN '.gif' WHEN 'webp' THEN '.webp'
  WHEN 'bmp' THEN '.bmp' WHEN 'heic' THEN '.heic' ELSE '.jpg' END"""
KEY_SQL = f"'images/by-source/' || sha256(url)[1:32] || {EXT_SQL}"


@register("url_keys", f"SELECT page_id, {KEY_SQL} AS object_key FROM pages")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.url_key("url", "images").alias("object_key"))


@register(
    "url_extract",
    """SELECT page_id, array_to_string(list_distinct([regexp_replace(url, '[.,);\\]]+$', ''),
      regexp_extract(url, '^https?://[^/]+')]).list_sort(), '|') AS urls FROM pages""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    cell = F.concat(
        F.lit("see ("), F.col("url"), F.lit("), "), F.regexp_extract("url", "^https?://[^/]+", 0), F.lit("; "), F.col("url")
    )
    return pages.select("page_id", F.array_sort(urls.extract_urls(cell)).alias("urls"))


@register(
    "urls_to_fetch",
    f"""SELECT DISTINCT url, {KEY_SQL} AS object_key, false AS needs_login FROM pages""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(F.col("url").alias("image"), F.lit(None).cast("string").alias("image_path"), F.col("url").alias("image_urls"))
    return images.urls_to_fetch(rows, "images")


@register(
    "url_replace",
    f"SELECT page_id, 'a ' || {KEY_SQL} || ' ; b' AS cell FROM pages",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    mirrored = pages.select("url", urls.url_key("url", "images").alias("mirrored_url"))
    cells = pages.select("page_id", F.concat(F.lit("a "), F.col("url"), F.lit(" ; b")).alias("cell"))
    return images.replace_urls(cells, mirrored, "cell")


# ---------------------------------------------------------------- lexicon


# title-ending words of the test tables that name goods, written out: both lists drop them
NO_COLOR_WORDS = ("ring", "box", "bag", "hat")


def _titled(spark, sf_dir):
    return sold(spark, sf_dir, "model").select(F.initcap("model").alias("title"))


MINED_SQL = f"""w AS (SELECT upper(split_part(model, ' ', 2)[1]) || split_part(model, ' ', 2)[2:] AS word FROM sold),
  mined AS (SELECT word, count(*) AS occurrences FROM w WHERE regexp_full_match(word, '[A-Za-z]{{3,}}')
    AND lower(word) NOT IN ({_quoted(NO_COLOR_WORDS)}) GROUP BY word HAVING count(*) >= 8)"""


@register("tail_word_mining", f"WITH {SOLD_SQL}, {MINED_SQL} SELECT * FROM mined")
def _(spark, sf_dir):
    mined = lexicon.mine_tail_words(_titled(spark, sf_dir), lexicon.default_skip_words(spark))
    return lexicon.new_words(mined, lexicon.read_lexicon(spark))


@register(
    "lexicon_additions",
    f"""WITH {SOLD_SQL}, {MINED_SQL} SELECT * FROM mined WHERE occurrences >= 25 AND NOT (upper(word) = word AND length(word) <= 4)
    AND lower(word) <> word""",
)
def _(spark, sf_dir):
    mined = lexicon.mine_tail_words(_titled(spark, sf_dir), lexicon.default_skip_words(spark))
    return lexicon.words_to_add(lexicon.new_words(mined, lexicon.read_lexicon(spark)))


@register(
    "lexicon_hits",
    f"""WITH {SOLD_SQL}, t AS (SELECT DISTINCT model || ' ' || material || ' ' || brand AS title FROM sold),
    l AS (SELECT DISTINCT p_name AS word FROM part UNION SELECT DISTINCT lower(p_type) FROM part),
    h AS (SELECT title, word FROM t JOIN l ON contains(' ' || lower(title) || ' ', ' ' || word || ' '))
    SELECT title, string_agg(word, '|' ORDER BY word) AS lexicon_words FROM h GROUP BY title""",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    words = part.select(F.col("p_name").alias("word")).union(part.select(F.lower("p_type"))).distinct()
    rows = sold(spark, sf_dir, "model", "material", "brand")
    return lexicon.lexicon_hits(rows.select(F.concat_ws(" ", "model", "material", "brand").alias("title")), words)


# ---------------------------------------------------------------- parse results


def _payloads(spark, sf_dir):
    """A parser's answer per part: a fenced JSON text whose model has to be put together from tokens."""
    part = spread(spark, sf_dir, "part")
    word = lambda i: F.element_at(F.split("p_name", " "), i)
    token = lambda value, role: F.struct(value.alias("text"), F.lit(role).alias("role"))
    body = F.to_json(
        F.struct(
            F.array(
                token(word(1), "color"),
                token(word(2), "MODEL"),
                token(F.lower("p_type"), "material"),
                token(F.col("p_size").cast("string"), "size"),
                token(F.col("p_brand"), "maker"),
            ).alias("tokens"),
            F.lit("null").alias("model"),
            F.lit(None).cast("string").alias("color"),
        )
    )
    return part.withColumn("payload", F.concat(F.lit("```json\n"), body, F.lit("\n```")))


@register(
    "parse_payload",
    """SELECT p_partkey, split_part(p_name, ' ', 2) || ' ' || p_size AS model, lower(p_type) AS material,
    split_part(p_name, ' ', 1) AS color, CAST(NULL AS VARCHAR) AS other, CAST(5 AS INTEGER) AS token_count FROM part""",
)
def _(spark, sf_dir):
    fields = parse_results.result_fields(parse_results.payload("payload"))
    rows = _payloads(spark, sf_dir).select("p_partkey", fields.alias("f"))
    return rows.select("p_partkey", "f.model", "f.material", "f.color", "f.other", F.size("f.tokens").alias("token_count"))


@register(
    "result_reuse",
    f"""WITH {SOLD_SQL}, t AS (SELECT DISTINCT brand, model AS title, color, condition FROM sold),
    r AS (SELECT DISTINCT p_brand AS brand, p_name AS title FROM part WHERE p_size > 25)
    SELECT hit_level, count(*) AS titles FROM (
      SELECT CASE WHEN r.title IS NULL THEN 'none' WHEN condition = 'Excellent' THEN 'exact' ELSE 'title' END AS hit_level
      FROM t LEFT JOIN r ON t.brand = r.brand AND t.title = r.title) GROUP BY hit_level""",
)
def _(spark, sf_dir):
    asked = sold(spark, sf_dir, "brand", "model", "color", "condition")
    asked = asked.withColumnRenamed("model", "title").distinct()
    stored = _payloads(spark, sf_dir).where("p_size > 25").select(
        F.upper("p_brand").alias("brand"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("title"),
        F.substring_index("p_name", " ", 1).alias("color"),
        F.lit("excellent").alias("condition"),
        "payload",
        F.col("p_retailprice").alias("created_at"),
    )
    return parse_results.hit_statistics(parse_results.attach_results(asked, stored))


# ---------------------------------------------------------------- selection, updates


@register(
    "incremental_select",
    f"""WITH {SOLD_SQL}, files AS (SELECT DISTINCT shop, snapshot_date, shop || '-' || CAST(snapshot_date AS VARCHAR) || '-' || condition AS file_name FROM sold),
    stored AS (SELECT DISTINCT shop, snapshot_date FROM sold WHERE material = 'promo')
    SELECT shop, CAST(snapshot_date AS VARCHAR) AS snapshot_date, min(file_name) AS file_name FROM files
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.shop = files.shop AND s.snapshot_date = files.snapshot_date)
    GROUP BY shop, snapshot_date""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "snapshot_date", "condition", "material")
    name = F.concat_ws("-", "shop", F.col("snapshot_date").cast("string"), "condition")
    files = rows.select("shop", "snapshot_date", name.alias("file_name")).distinct()
    return select_files(files, rows.where("material = 'promo'"))


BLANKED_SQL = "CASE WHEN condition <> 'bc-filter-Great' THEN condition END"


@register(
    "backfill_keyed",
    f"""WITH {SOLD_SQL}, src AS (SELECT shop, item_id, snapshot_date, max(condition || '!') AS filled FROM sold GROUP BY ALL),
    tgt AS (SELECT shop, item_id, snapshot_date, {BLANKED_SQL} AS condition FROM sold)
    SELECT t.shop, t.item_id, CAST(t.snapshot_date AS VARCHAR) AS snapshot_date, coalesce(t.condition, filled) AS condition,
    t.condition IS NULL AS was_changed FROM tgt t JOIN src s ON t.shop = s.shop AND t.item_id = s.item_id AND t.snapshot_date = s.snapshot_date""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "item_id", "snapshot_date", "condition")
    target = rows.withColumn("condition", F.when(F.col("condition") != "bc-filter-Great", F.col("condition")))
    source = rows.withColumn("condition", F.concat("condition", F.lit("!")))
    return updates.backfill_condition(target, source).withColumnRenamed("_changed", "was_changed")


@register(
    "changed_fields",
    f"""WITH {SOLD_SQL}, c AS (SELECT array_to_string(list_filter([
      CASE WHEN condition IS DISTINCT FROM {GRADE_SQL} THEN 'condition' END,
      CASE WHEN color IS DISTINCT FROM CASE color WHEN 'hot' THEN NULL ELSE color END THEN 'color' END,
      CASE WHEN currency IS DISTINCT FROM CASE currency WHEN 'USD' THEN 'CNY' ELSE currency END THEN 'currency' END],
      lambda x: x IS NOT NULL), '|') AS changed, shop FROM sold)
    SELECT shop, changed, count(*) AS row_count FROM c GROUP BY ALL""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "condition", "color", "currency")
    rows = rows.groupBy("shop", "condition", "color", "currency").agg(F.count("*").alias("n"))
    rows = condition.with_grade(rows, "condition", "grade").withColumn("canonical", color.normalize_color("color"))
    changed = updates.changed_fields(
        {
            "condition": (F.col("condition"), F.col("grade")),
            "color": (F.col("color"), F.when(F.col("color") != "hot", F.col("canonical"))),
            "currency": (F.col("currency"), F.when(money.is_usd("currency"), "CNY").otherwise(F.col("currency"))),
        }
    )
    marked = rows.select("shop", "n", F.array_join(changed, "|").alias("changed"))
    return marked.groupBy("shop", "changed").agg(F.sum("n").alias("row_count"))


@register(
    "missing_images",
    f"""WITH {SOLD_SQL} SELECT shop, CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS missing_rows
    FROM sold WHERE CASE shop WHEN 'V' THEN currency = 'USD' ELSE color = 'red' END GROUP BY shop, snapshot_date""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "snapshot_date", "color", "currency", "item_id")
    url = F.concat(F.lit("https://img.example.com/"), F.col("item_id"))
    return coverage.missing_images(
        rows.withColumns(
            {
                "image": F.when(F.col("currency") != "USD", url).otherwise("  "),
                "image_path": F.when(F.col("color") != "red", url),
                "image_urls": F.lit(""),
            }
        )
    )


# ---------------------------------------------------------------- names, merged fields


@register(
    "english_names",
    """SELECT p_partkey, lower(p_brand) || ' / hermes' AS brand, 'belt bag ' || lower(p_name) || ' leather, canvas' AS name,
    'canvas and leather ' || lower(p_type) || ' snake' AS material FROM part""",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        names.normalize_brand(F.concat(F.lit("['"), F.col("p_brand"), F.lit(" / Hermès']"))).alias("brand"),
        names.product_name(F.concat(F.lit("Sac  Ceinture "), F.col("p_name"), F.lit("  Cuir, toile "))).alias("name"),
        names.material(F.concat(F.lit("Toile et cuir "), F.col("p_type"), F.lit("\tSerpent"))).alias("material"),
    )


@register(
    "merged_fields",
    """SELECT p_partkey, CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'gray/red' WHEN 'blue' THEN 'blue/gray'
      ELSE 'gray/' || split_part(p_name, ' ', 1) END AS color,
    CASE WHEN lower(p_type) = 'large' THEN 'large/leather' ELSE 'large/leather/' || lower(p_type) END AS material,
    'sellier/' || split_part(p_name, ' ', 2) AS other FROM part""",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    word = lambda i: F.element_at(F.split("p_name", " "), i)
    return part.select(
        "p_partkey",
        color.merge_colors(F.lit("Grey"), F.concat(F.initcap(word(1)), F.lit("/GRIS"))).alias("color"),
        names.merge_materials(F.lit("LARGE / cuir"), F.col("p_type")).alias("material"),
        names.merge_other(F.lit("Sellier"), F.concat(word(2), F.lit(" / SELLIER"))).alias("other"),
    )


@register(
    "files_to_backfill",
    f"""WITH {SOLD_SQL}, files AS (SELECT DISTINCT shop, snapshot_date, shop || '-' || CAST(snapshot_date AS VARCHAR) || '.csv' AS file_name FROM sold),
    missing AS (SELECT DISTINCT shop, snapshot_date FROM sold WHERE color = 'red')
    SELECT f.shop, CAST(f.snapshot_date AS VARCHAR) AS snapshot_date, file_name FROM files f
    JOIN missing m ON f.shop = m.shop AND f.snapshot_date = m.snapshot_date WHERE f.snapshot_date >= DATE '1997-01-01'""",
)
def _(spark, sf_dir):
    rows = sold(spark, sf_dir, "shop", "snapshot_date", "color")
    name = F.concat(F.concat_ws("-", "shop", F.col("snapshot_date").cast("string")), F.lit(".csv"))
    files = rows.select("shop", "snapshot_date", name.alias("file_name")).distinct()
    return files_to_backfill(files, rows.where("color = 'red'"), date(1997, 1, 1))
