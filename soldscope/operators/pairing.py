"""Nearest-date pairing: smallest day gap up to a limit, the earlier date on a tie."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_GAP_DAYS = 3


def nearest_date(dates: DataFrame, anchor: date, max_gap: int = MAX_GAP_DAYS, column: str = "snapshot_date") -> DataFrame:
    """One row ``(paired_date, gap_days)`` for one anchor, NULLs when nothing is near enough.

    The range filter leaves only the few partitions around the anchor to read, and the minimum
    is combined on the map side.
    """
    at = F.lit(anchor).cast("date")
    gap = F.abs(F.datediff(F.col(column), at))
    near = dates.where(F.col(column).between(F.date_sub(at, max_gap), F.date_add(at, max_gap)))
    best = near.agg(F.min(F.struct(gap.alias("gap"), F.col(column).alias("day"))).alias("best"))
    return best.select(F.col("best.day").alias("paired_date"), F.col("best.gap").alias("gap_days"))


def nearest_dates(anchors: DataFrame, candidates: DataFrame, max_gap: int = MAX_GAP_DAYS) -> DataFrame:
    """All anchors at once: every anchor meets its 2·max_gap+1 possible dates by an equi-join."""
    anchor = anchors.select(F.col("snapshot_date").alias("anchor_date")).where("anchor_date is not null").distinct()
    other = candidates.select(F.col("snapshot_date").alias("paired_date")).where("paired_date is not null").distinct()
    offsets = F.sequence(F.lit(-max_gap), F.lit(max_gap))
    wanted = anchor.select("anchor_date", F.explode(offsets).alias("shift")).withColumn(
        "paired_date", F.date_add("anchor_date", F.col("shift"))
    )
    met = wanted.join(other, "paired_date")
    best = met.groupBy("anchor_date").agg(
        F.min(F.struct(F.abs("shift").alias("gap"), F.col("paired_date").alias("day"))).alias("best")
    )
    return anchor.join(best, "anchor_date", "left").select(
        "anchor_date",
        F.col("best.day").alias("paired_date"),
        F.col("best.gap").alias("gap_days"),
    )
