"""Documents to packed training sequences: each stage's result is written and read by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soldscope.llm import exact_dedup, jaccard_join, quality, secrets
from soldscope.llm.common import table
from soldscope.llm.queries import LEAST_QUALITY, packed, quality_model
from soldscope.session import checkpoint_root

MASK = "[secret]"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, quality_model(spark, sf_dir), LEAST_QUALITY)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the row with the greatest id."""
    return exact_dedup.exact_dedup_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more keeps the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; documents without secrets stay as they are."""
    masked = secrets.mask_secrets(docs, mask=MASK)
    if "n_chars" not in docs.columns:
        return masked
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col("text").contains(MASK), changed).otherwise(F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens."""
    return packed(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_duplicates", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]
# the classifier is fitted, so no SQL can say which rows stay
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
