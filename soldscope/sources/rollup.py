"""Tables kept beside a store and refreshed where the store changed: counted prices, trigrams of titles.

Both are partitioned like the store. A refresh lists the store's files, never its rows, and derives the
partitions anew whose files differ from those seen last; repeating one that broke off does no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soldscope.operators import predicates as P
from soldscope.operators.catalogue import CATALOGUE_KEYS
from soldscope.schema import MONEY, PARTITION_COLUMNS
from soldscope.session import reliable_checkpoint
from soldscope.sources.store import SnapshotStore

VERSIONS = "shop string, snapshot_date date, version long"
GRAM = 3


class SideTable:
    """What ``derive`` makes of each partition of a store."""

    name = "side"
    columns: tuple[T.StructField, ...] = ()

    def __init__(self, store: SnapshotStore, path: str | None = None):
        self.store = store
        self.path = path or f"{store.path.rstrip('/')}_{self.name}"
        self.schema = T.StructType(
            [*self.columns, T.StructField("shop", T.StringType()), T.StructField("snapshot_date", T.DateType())]
        )

    def derive(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _read(self, part: str, schema) -> DataFrame:
        spark = self.store.spark
        try:
            spark.catalog.refreshByPath(f"{self.path}/{part}")
            return spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], schema)
            raise

    def read(self) -> DataFrame:
        return self._read("rows", self.schema)

    def stale(self) -> DataFrame:
        """Partitions whose files differ from those that were read, with the files' present version."""
        kept = reliable_checkpoint(self.store.spark, self._read("versions", VERSIONS))
        old = kept.select(F.col("shop").alias("_s"), F.col("snapshot_date").alias("_d"), F.col("version").alias("_v"))
        same = (F.col("shop") == F.col("_s")) & F.col("snapshot_date").eqNullSafe(F.col("_d")) & (F.col("version") == F.col("_v"))
        return self.store.versions().join(old, same, "left_anti")

    def refresh(self) -> DataFrame:
        """Derive the stale partitions anew; returns them."""
        spark = self.store.spark
        stale = reliable_checkpoint(spark, self.stale())
        touched = _dates(stale)
        if not touched:
            return stale
        (
            self.derive(self.store.read().where(P.in_partitions(touched)))
            .select(*self.schema.names)
            .hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITION_COLUMNS)
            .parquet(f"{self.path}/rows")
        )
        # versions last: what a broken refresh has derived is then derived again
        renamed = stale.select(F.col("shop").alias("_s"), F.col("snapshot_date").alias("_d"))
        same = (F.col("shop") == F.col("_s")) & F.col("snapshot_date").eqNullSafe(F.col("_d"))
        held = self._read("versions", VERSIONS).join(renamed, same, "left_anti")
        reliable_checkpoint(spark, held.unionByName(stale)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions")
        return stale


def _dates(partitions: DataFrame) -> list[tuple[str, date | None]]:
    """Shops and dates, never rows, come to the driver."""
    return [(r.shop, r.snapshot_date) for r in partitions.select(*PARTITION_COLUMNS).collect()]


class PriceRollup(SideTable):
    """Rows per shop, date, catalogue key and price.

    Counts merge, so the price reports of any range, coarser keys and exact medians take ``read()`` in
    place of the rows; it is as large as the distinct prices are many.
    """

    name = "prices"
    columns = (
        *(T.StructField(c, T.StringType()) for c in CATALOGUE_KEYS),
        T.StructField("price", MONEY),
        T.StructField("n", T.LongType()),
    )

    def derive(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*PARTITION_COLUMNS, *CATALOGUE_KEYS, "price").agg(F.count("*").alias("n"))


class TitleIndex(SideTable):
    """Runs of three characters in the searched text of each partition's rows."""

    name = "title_grams"
    columns = (T.StructField("gram", T.StringType()),)

    def derive(self, rows: DataFrame) -> DataFrame:
        text = rows.select(*PARTITION_COLUMNS, F.lower(P.search_text()).alias("t")).distinct().where(F.length("t") >= GRAM)
        grams = F.transform(F.sequence(F.lit(1), F.length("t") - (GRAM - 1)), lambda i: F.substring(F.col("t"), i, F.lit(GRAM)))
        return text.select(*PARTITION_COLUMNS, F.explode(F.array_distinct(grams)).alias("gram")).distinct()

    def partitions(self, keywords: Iterable[str]) -> list[tuple[str, date | None]] | None:
        """Partitions that can hold a row with all keywords; None where the keywords rule nothing out.

        Partitions that changed since the last refresh are always among them.
        """
        # wildcards that a user typed part a keyword into pieces
        pieces = [p.lower() for k in keywords for p in re.split(r"[%_\\]", k)]
        grams = sorted({p[i : i + GRAM] for p in pieces for i in range(len(p) - GRAM + 1)})
        if not grams:
            return None
        held = self.read().where(F.col("gram").isin(grams)).groupBy(*PARTITION_COLUMNS).agg(F.count_distinct("gram").alias("n"))
        return sorted({*_dates(held.where(F.col("n") == len(grams))), *_dates(self.stale())}, key=str)

    def rows(self, keywords: Iterable[str]) -> DataFrame:
        """Rows of the store that a search for ``keywords`` has to look at; other partitions are not read."""
        found = self.partitions(keywords)
        return self.store.read() if found is None else self.store.read().where(P.in_partitions(found))
