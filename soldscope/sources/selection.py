"""Which landing files a run takes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("shop", "snapshot_date")


def _same(left: DataFrame, right: DataFrame):
    return (left["shop"] == right["shop"]) & left["snapshot_date"].eqNullSafe(right["snapshot_date"])


def select_files(files: DataFrame, stored: DataFrame, *, skip_existing: bool = True) -> DataFrame:
    """Files whose date is not stored yet, the first by name per shop and date.

    The undated bucket counts as a date. ``skip_existing=False`` takes stored dates as well.
    """
    if skip_existing:
        known = stored.select(*KEYS).distinct()
        files = files.join(known, _same(files, known), "left_anti")
    return files.groupBy(*KEYS).agg(F.min("file_name").alias("file_name")).select("shop", "file_name", "snapshot_date")


def rows_of(rows: DataFrame, files: DataFrame) -> DataFrame:
    return rows.join(files.select("shop", "file_name"), ["shop", "file_name"], "left_semi")


def files_to_backfill(files: DataFrame, missing: DataFrame, since: date | None = None) -> DataFrame:
    """Dated files whose date still has rows to fill, from an optional first date on."""
    dated = files.where("snapshot_date is not null")
    if since is not None:
        dated = dated.where(F.col("snapshot_date") >= F.lit(since).cast("date"))
    return dated.join(missing.select(*KEYS).distinct(), list(KEYS), "left_semi")
