"""Daily incremental load as a file stream: new landing files, unseen dates, formatting of that batch.

The stream checkpoint keeps loaded files from being read again; the date rule still guards a date
that arrives a second time under another name. Both steps of a batch can be repeated safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from soldscope.plans.reformat import reconcile_brands, reformat
from soldscope.session import written
from soldscope.sources import landing
from soldscope.sources.selection import rows_of, select_files
from soldscope.sources.store import SnapshotStore


def load_batch(
    batch: DataFrame,
    store: SnapshotStore,
    *,
    fmt: str = "csv",
    skip_existing: bool = True,
    usd_cny: str | None = None,
    keep_images: bool = True,
    skip_format: bool = False,
    **format_options: DataFrame,
) -> None:
    """Store one micro-batch date by date, then format the dates it brought."""
    if batch.isEmpty():
        return
    # written once: the files are parsed one time, whatever the steps below read
    raw = written(landing.records(landing.batch_cells(batch, fmt)), "landed")
    files = raw.select("shop", "file_name", "snapshot_date").distinct()
    chosen = select_files(files, store.stored_dates(), skip_existing=skip_existing)
    rows = landing.prepare(rows_of(raw, chosen), usd_cny=usd_cny, keep_images=keep_images)
    store.overwrite_dates(rows)
    if not skip_format:
        # every date of the batch: a repeated batch formats what an interrupted one had stored
        reformat(store, shop_dates=files, **format_options)


def run_incremental(
    spark: SparkSession,
    root: str,
    store: SnapshotStore,
    *,
    fmt: str = "csv",
    max_files: int | None = None,
    checkpoint: str | None = None,
    **options,
) -> None:
    """Take every file that arrived since the last run, then stop.

    What the stream has read is remembered under ``checkpoint``, else beside the store, where it stays
    for the next session.
    """
    stream = landing.stream_files(spark, root, fmt, max_files)
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: load_batch(batch, store, fmt=fmt, **options))
        .option("checkpointLocation", checkpoint or f"{store.path.rstrip('/')}_incremental")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_daily(spark: SparkSession, root: str, store: SnapshotStore, **options) -> DataFrame:
    """Incremental load, then the rows of all dates whose brand is still a list literal."""
    run_incremental(spark, root, store, **options)
    return reconcile_brands(store)


def load_once(spark: SparkSession, root: str, store: SnapshotStore, *, fmt: str = "csv", skip_existing: bool = True, **options) -> None:
    """Batch load of a landing folder; only chosen files reach the store."""
    raw = landing.records(landing.read_cells(spark, root, fmt))
    chosen = select_files(landing.list_files(spark, root, fmt), store.stored_dates(), skip_existing=skip_existing)
    store.overwrite_dates(landing.prepare(rows_of(raw, chosen), **options))
