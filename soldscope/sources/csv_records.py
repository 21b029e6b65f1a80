"""Records of CSV files of any size, cells with line breaks included, by byte ranges.

Files are read as lines, so Spark splits them. Whether a line begins a record depends on the quotes before
it; inside a range that is known up to one bit, and the bits follow from the ranges' quote counts, a few
numbers a file. Lines that are whole records, nearly all, never leave their task; only the lines of records
with line breaks meet again by record.

A record's cells are taken out by one pattern, so no width has to be known and one odd row widens nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from soldscope.session import ship_package, written

_LINES = "path string, block long, at long, odd int, quotes int, even_starts long, odd_starts long, value string"


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their number in the range, the quotes before them modulo 2, and the records begun so far.

    Records are counted both ways: as if the range began outside and as if it began inside quotes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seen = None, np.zeros(4, np.int64)  # lines, quotes, records begun either way
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, blocks = batch["path"].to_pylist(), batch["block"].to_pylist()
            quotes = pc.count_substring(batch["value"], '"').to_numpy(zero_copy_only=False).astype(np.int64)
            at, odd, even_starts, odd_starts = (np.empty(len(quotes), np.int64) for _ in range(4))
            here = list(zip(paths, blocks))
            cuts = [0, *(i for i in range(1, len(here)) if here[i] != here[i - 1]), len(here)]
            for a, b in zip(cuts, cuts[1:]):
                if here[a] != place:
                    place, seen = here[a], np.zeros(4, np.int64)
                q = quotes[a:b]
                odd[a:b] = (seen[1] + np.cumsum(q) - q) & 1
                at[a:b] = seen[0] + np.arange(b - a)
                even_starts[a:b] = seen[2] + np.cumsum(odd[a:b] == 0)
                odd_starts[a:b] = seen[3] + np.cumsum(odd[a:b] == 1)
                seen = np.array([seen[0] + b - a, seen[1] + q.sum(), even_starts[b - 1], odd_starts[b - 1]])
            yield pa.record_batch(
                [
                    batch["path"], batch["block"], pa.array(at), pa.array(odd.astype(np.int32)),
                    pa.array((quotes & 1).astype(np.int32)), pa.array(even_starts), pa.array(odd_starts), batch["value"],
                ],
                names=["path", "block", "at", "odd", "quotes", "even_starts", "odd_starts", "value"],
            )

    return lines.mapInArrow(run, _LINES)


def _ranges(held: DataFrame) -> DataFrame:
    """Per byte range: whether it begins inside quotes, and the record that was open then; one row a range."""
    counted = held.groupBy("path", "block").agg(
        (F.sum("quotes") % 2).alias("parity"), F.max("even_starts").alias("even"), F.max("odd_starts").alias("odd_n")
    )
    file = Window.partitionBy("path").orderBy("block")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    inside = counted.withColumn("inside", (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).cast("int"))
    begun = inside.withColumn("begun", F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd_n")))
    last = F.when(F.col("begun") > 0, F.struct(F.col("block").alias("block"), F.col("begun").alias("n")))
    return begun.select(
        "path",
        "block",
        "inside",
        F.last(last, ignorenulls=True).over(earlier).alias("owner"),
        # the quote that opens this record is never closed
        F.when(F.sum("parity").over(whole) % 2 == 1, F.max(last).over(whole)).alias("broken"),
    )


def csv_records(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """path and record of every CSV record, from the lines of files as ``path``, ``block``, ``value``.

    ``block`` is where the line's byte range starts. Blank records are left out. A quote that is never
    closed opens nothing: the lines from there on are records one by one.
    """
    ship_package(spark)
    held = written(_numbered(lines), "csv-lines")
    placed = held.join(_ranges(held), ["path", "block"])
    begins = F.col("odd") == F.col("inside")
    n = F.when(F.col("inside") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))
    own = F.when(n > 0, F.struct(F.col("block").alias("block"), n.alias("n"))).otherwise(F.col("owner"))
    placed = placed.withColumn("record_key", own)
    alone = (begins & (F.col("quotes") == 0)) | F.coalesce(F.col("record_key") == F.col("broken"), F.lit(False))
    joined = (
        placed.where(~alone)
        .groupBy("path", "record_key")
        .agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
        .select("path", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"))
    )
    records = placed.where(alone).select("path", F.col("value").alias("record")).unionByName(joined)
    bare = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "^\ufeff", "")
    return records.select("path", bare.alias("record")).where(F.trim("record") != "")


def cells(record: Column | str) -> Column:
    """Cells of a record; quotes around a cell are taken off, doubled ones inside become one, an empty cell is NULL."""
    text = F.col(record) if isinstance(record, str) else record
    pieces = F.regexp_extract_all(F.concat(text, F.lit(",")), F.lit(r'("(?:[^"]++|"")*+"|[^,]*+),'), F.lit(1))

    def bare(c: Column) -> Column:
        inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        is_quoted = (F.length(c) >= 2) & c.startswith('"') & c.endswith('"')
        return F.when(c == "", F.lit(None).cast("string")).when(is_quoted, inner).otherwise(c)

    return F.transform(pieces, bare)
