"""Shape of the ``sold`` table: one table for all shops, ``shop`` and ``snapshot_date`` partition it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHOPS = ("F", "R", "V")
PARTITION_COLUMNS = ("shop", "snapshot_date")
MONEY = T.DecimalType(18, 2)

SOLD = T.StructType(
    [
        T.StructField("shop", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("color", T.StringType()),
        T.StructField("material", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("seller_price", MONEY),
        T.StructField("buyer_fee", MONEY),
        T.StructField("likes", T.IntegerType()),
        T.StructField("listed_at", T.TimestampType()),
        T.StructField("sold_at", T.TimestampType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("image_urls", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("other", T.StringType()),
        T.StructField("old_data", T.StringType()),
        T.StructField("imported_at", T.TimestampType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)

# columns a reformat may change
FORMATTED = ("brand", "model", "condition", "color", "material", "year", "other")
RETIRED = ("model_size",)


def align(df: DataFrame, schema: T.StructType = SOLD) -> DataFrame:
    """Project onto ``schema``: columns the input lacks come out NULL, retired ones are dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def evolve(df: DataFrame, schema: T.StructType = SOLD) -> DataFrame:
    """Keep every column of ``df``, add the nullable ones it lacks, drop retired ones."""
    empty = df.sparkSession.createDataFrame([], schema)
    return df.drop(*RETIRED).unionByName(empty, allowMissingColumns=True)


def null_of(kind: str) -> Column:
    """Typed NULL placeholder that keeps one result shape across report variants."""
    return F.lit(None).cast(kind)
