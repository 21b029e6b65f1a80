"""Places of rows in a total order, without a window over the whole table.

Rows are dealt by ranges of the order, sorted inside their range and numbered there; the ranges' sizes,
one number each, are summed up, and a row's place is its number plus the rows of the ranges before.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.session import written

_WITHIN = (1 << 33) - 1  # the part of a generated id that counts the rows of its partition


def numbered(df: DataFrame, order: Iterable[Column], name: str = "place") -> DataFrame:
    """``df`` with the place of every row (from 1) in ``order``; ties get different places.

    ``df`` is read twice, once for the bounds of the ranges, so a dear one should be a written table.
    Equal rows are told apart by where they were read, so a third of all rows may be equal in the order
    and still spreads over many ranges. No row order is promised, only the column.
    """
    keys = [*order, F.col("_met").asc()]
    ranged = df.withColumn("_met", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = written(
        ranged.drop("_met").withColumns(
            {
                "_part": F.spark_partition_id(),
                "_turn": F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)),
            }
        ),
        "ordinal",
    )
    sizes = sorted((r["_part"], r["n"]) for r in held.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, before)], "_part int, _before long"
    )
    # one row a shuffle partition
    placed = held.join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_turn") + 1).select(*df.columns, name)


def page(df: DataFrame, place: str, size: int, number: int) -> DataFrame:
    """Rows of page ``number`` (from 1) by their places; a filter, so a deep page costs no more than the first."""
    first = size * (number - 1) + 1
    return df.where(F.col(place).between(first, first + size - 1))
