"""Dated snapshot files in a landing folder to records of the ``sold`` table.

Files lie in one folder per shop (``…/F/…``, ``…/R/…``, ``…/V/…``) as CSV, JSON lines or Parquet.
Headers differ from file to file, so every row is read as a map from header to cell first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soldscope.functions import text as X
from soldscope.functions.color import normalize_color
from soldscope.functions.condition import with_grade
from soldscope.functions.money import prices_in_cny
from soldscope.functions.names import normalize_brand
from soldscope.schema import MONEY, SOLD, align
from soldscope.sources.csv_records import cells, csv_records

# fixed values: header to column, per kind of shop
HEADERS = {
    "品牌": "brand", "型号": "model", "商品名称": "model", "成色": "condition", "品相": "condition",
    "condition": "condition", "颜色": "color", "图片路径": "image_path", "所有图片网址": "image_urls",
    "图片": "image", "材质": "material", "尺寸": "size", "货币": "currency",
    "卖家价格": "seller_price", "买家手续费": "buyer_fee", "点赞数": "likes", "上架时间": "listed_at",
    "售出时间": "sold_at", "链接": "url",
}
ID_HEADER = "id"
PRICE_WORD = "价格"
FR_ONLY = ("image_path", "image_urls")
V_ONLY = ("image", "material", "size", "currency", "seller_price", "buyer_fee", "likes", "listed_at", "sold_at", "url")
TEXT_COLUMNS = ("item_id", "brand", "model", "condition", "color", "material", "size", "currency", "image_path", "image_urls", "image", "url")
OLD_DATA_FR = ("item_id", "brand", "model", "condition", "color", "price")
OLD_DATA_V = (
    "item_id", "brand", "product_name", "material", "color", "condition", "size", "price", "currency",
    "seller_price", "buyer_fee", "likes", "listed_at", "sold_at", "url",
)
GLOBS = {"csv": "*.[cC][sS][vV]", "json": "*.[jJ][sS][oO][nN]*", "parquet": "*.[pP][aA][rR][qQ][uU][eE][tT]"}


def snapshot_date(file_name: Column | str) -> Column:
    """Date in a file name: ``2025年3月1日`` anywhere, else ``_20250301_``, else NULL."""
    name = X.col(file_name)
    spelled = r"(\d{4})年(\d{1,2})月(\d{1,2})日"
    part = lambda i: F.regexp_extract(name, spelled, i)
    long_form = F.try_to_timestamp(F.concat_ws("-", part(1), part(2), part(3)), F.lit("y-M-d"))
    short_form = F.try_to_timestamp(F.regexp_extract(name, r"_(\d{8})_", 1), F.lit("yyyyMMdd"))
    return F.when(name.rlike(spelled), long_form).otherwise(short_form).cast("date")


def shop_of_path(path: Column | str) -> Column:
    return X.filled(F.regexp_extract(F.url_decode(X.col(path)), r"/([FRV])/[^/]+$", 1))


def list_files(spark: SparkSession, root: str, fmt: str = "csv") -> DataFrame:
    """Snapshot files under ``root`` by suffix in any case; only the listing is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", GLOBS[fmt])
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.element_at(F.split(F.url_decode("path"), "/"), -1).alias("file_name"))
    )
    return files.select(shop_of_path("path").alias("shop"), "file_name", snapshot_date("file_name").alias("snapshot_date")).where(
        "shop is not null"
    )


def _is_header(cells: Column) -> Column:
    known = F.exists(cells, lambda c: F.contains(c, F.lit(PRICE_WORD)) | X.lookup(HEADERS, X.strip(c)).isNotNull())
    return known & F.exists(cells, lambda c: F.lower(X.strip(c)) == ID_HEADER)


def _file_columns() -> list[Column]:
    return [
        shop_of_path("_metadata.file_path").alias("shop"),
        F.url_decode("_metadata.file_name").alias("file_name"),
    ]


def read_csv(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Rows of CSV files as one array of cells each, however long; quoted cells may hold line breaks.

    Files are split by byte ranges whatever their cells hold.
    """
    lines = _reader(spark, "csv").option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    named = csv_records(spark, lines).select(
        shop_of_path("path").alias("shop"), F.element_at(F.split(F.url_decode("path"), "/"), -1).alias("file_name"), "record"
    )
    return named.select("shop", "file_name", cells("record").alias("cells"))


def cells_of_csv(rows: DataFrame) -> DataFrame:
    """Rows of cells with file columns: each file's own header row names its cells.

    A file without a header row keeps its rows, with no named cell: the record step counts them out.
    Headers are few and narrow, so the large side of the join is the one that may be split.
    """
    cells = rows.select("shop", "file_name", "cells").withColumn("is_header", _is_header(F.col("cells")))
    headers = cells.where("is_header").groupBy("shop", "file_name").agg(F.min("cells").alias("header"))
    body = cells.where(~F.coalesce("is_header", F.lit(False)))
    named = body.join(headers, ["shop", "file_name"], "left").withColumn(
        "pairs",
        F.filter(F.arrays_zip(F.col("header").alias("key"), F.col("cells").alias("value")), lambda p: p["key"].isNotNull()),
    )
    return named.select("shop", "file_name", F.coalesce("pairs", F.array().cast("array<struct<key:string,value:string>>")).alias("pairs"))


def files_without_header(spark: SparkSession, root: str) -> DataFrame:
    """shop, file_name and rows of the CSV files in which no row is a header; their rows are not loaded."""
    rows = read_csv(spark, root)
    return rows.groupBy("shop", "file_name").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.coalesce(_is_header(F.col("cells")), F.lit(False))).alias("headed")
    ).where("not headed").select("shop", "file_name", "rows")


def cells_of_json(lines: DataFrame) -> DataFrame:
    """JSON lines in ``value``: one object per row, keys are headers."""
    row = F.from_json("value", "map<string,string>")
    return lines.select("shop", "file_name", F.map_entries(row).alias("pairs"))


def _reader(spark: SparkSession, fmt: str):
    return spark.read.option("pathGlobFilter", GLOBS[fmt]).option("recursiveFileLookup", "true")


def read_cells(spark: SparkSession, root: list[str] | str, fmt: str = "csv") -> DataFrame:
    """Rows of all files as ``(shop, file_name, pairs)``; ``pairs`` lists header and cell in file order."""
    if fmt == "csv":
        return cells_of_csv(read_csv(spark, root))
    reader = _reader(spark, fmt)
    if fmt == "json":
        return cells_of_json(reader.text(root).select("value", *_file_columns()))
    rows = reader.option("mergeSchema", "true").parquet(*([root] if isinstance(root, str) else root))
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for c in rows.columns])
    return rows.select(*_file_columns(), pairs.alias("pairs"))


def stream_files(spark: SparkSession, root: str, fmt: str = "csv", max_files: int | None = None) -> DataFrame:
    """Stream of the paths of new files; only the listing is read."""
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", GLOBS[fmt]).option("recursiveFileLookup", "true")
    kind = "path string, modificationTime timestamp, length long, content binary"
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(kind).load(root).select("path")


def batch_cells(batch: DataFrame, fmt: str = "csv") -> DataFrame:
    """Cells of the files of one micro-batch. Their names go through the driver, which planned the batch."""
    paths = [r.path for r in batch.select("path").distinct().collect()]
    return read_cells(batch.sparkSession, paths, fmt)


def _field(header: Column) -> Column:
    """Column a header fills. Exact names win over the rule that any other price header means price."""

    def named(name: Column) -> Column:
        known = F.coalesce(X.lookup(HEADERS, name), X.lookup(HEADERS, F.lower(name)), F.when(F.contains(name, F.lit(PRICE_WORD)), "price"))
        return F.when(F.lower(name) == ID_HEADER, "item_id").otherwise(known)

    return X.let(X.strip(header), named)


def text_cell(value: Column) -> Column:
    return F.regexp_replace(X.clean(value), r"^(-?\d+)\.0$", "$1")


def _number(value: Column) -> Column:
    return F.replace(value, F.lit(","), F.lit(""))


def decimal_cell(value: Column) -> Column:
    return _number(value).try_cast(MONEY)


def int_cell(value: Column) -> Column:
    return value.try_cast("double").try_cast("int")


def timestamp_cell(value: Column) -> Column:
    return F.try_to_timestamp(X.strip(value))


def old_data(df: DataFrame, shop: Column | str = "shop") -> Column:
    """JSON of the raw cells; NULLs are left out, numbers and times are text."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    shown = {
        "product_name": F.col("model"),
        "price": F.when(F.col("price").isNotNull(), _number(F.col("_raw_price")) if "_raw_price" in df.columns else F.col("price").cast("string")),
        "seller_price": F.col("seller_price").cast("string"),
        "buyer_fee": F.col("buyer_fee").cast("string"),
        "likes": F.col("likes").cast("string"),
        "listed_at": iso("listed_at"),
        "sold_at": iso("sold_at"),
    }
    text = lambda names: F.to_json(F.struct(*[shown.get(n, F.col(n) if n in df.columns else F.lit(None).cast("string")).alias(n) for n in names]))
    return F.when(X.col(shop) == "V", text(OLD_DATA_V)).otherwise(text(OLD_DATA_FR))


def records(cells: DataFrame) -> DataFrame:
    """Typed rows with ``old_data``, still in raw wording; blank rows and rows without an id are dropped.

    Each header is named once, and cells that fill no column are left out before columns are looked up. A row
    without an id gives no element, so no filter repeats that work in front of it.
    """
    named = F.transform("pairs", lambda p: F.struct(_field(p["key"]).alias("field"), p["value"].alias("value")))
    fields = F.filter(named, lambda f: f["field"].isNotNull())

    def value_of(held: Column, name: str) -> Column:
        return F.try_element_at(F.filter(held, lambda f: f["field"] == name), F.lit(-1))["value"]

    with_id = F.filter(F.array(fields), lambda held: text_cell(value_of(held, "item_id")).isNotNull())
    df = cells.select("shop", "file_name", F.explode(with_id).alias("fields"))
    is_v = F.col("shop") == "V"

    def cell(name: str) -> Column:
        value = value_of(F.col("fields"), name)
        if name in FR_ONLY:
            value = F.when(~is_v, value)
        if name in V_ONLY:
            value = F.when(is_v, value)
        return value

    kinds = {f.name: f.dataType for f in SOLD.fields}
    out = {c: text_cell(cell(c)) for c in TEXT_COLUMNS}
    out["price"] = decimal_cell(cell("price"))
    out["_raw_price"] = X.strip(cell("price"))
    out["seller_price"] = decimal_cell(cell("seller_price"))
    out["buyer_fee"] = decimal_cell(cell("buyer_fee"))
    out["likes"] = int_cell(cell("likes"))
    out["listed_at"] = timestamp_cell(cell("listed_at"))
    out["sold_at"] = timestamp_cell(cell("sold_at"))
    typed = df.select(
        "shop",
        "file_name",
        snapshot_date("file_name").alias("snapshot_date"),
        *[(v.cast(kinds[c]) if c in kinds else v).alias(c) for c, v in out.items()],
    )
    return typed.withColumn("old_data", old_data(typed)).drop("_raw_price")


def prepare(raw: DataFrame, *, usd_cny: str | None = None, keep_images: bool = True) -> DataFrame:
    """Rows as stored at import: brand, color and condition cleaned, title-derived columns left blank.

    ``old_data`` was built before prices are converted, so it keeps the raw ones.
    """
    df = with_grade(raw, "condition")
    df = df.withColumns({"brand": normalize_brand("brand"), "color": normalize_color("color")})
    df = df.withColumns(
        {
            "model": F.lit(None).cast("string"),
            "material": F.when(F.col("shop") == "V", F.col("material")),
            "id": F.xxhash64("shop", "item_id", "snapshot_date", "file_name", "old_data"),
            "imported_at": F.current_timestamp(),
        }
    )
    if usd_cny is not None:
        df = prices_in_cny(df, usd_cny)
    if not keep_images:
        df = df.drop("image", "image_path", "image_urls")
    return align(df)
