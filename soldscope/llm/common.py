"""Helpers of the training-data operators: tables, saved steps, groups in Arrow streams."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soldscope.session import checkpoint_root, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data; the workers get this package with the first one."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    Later steps read the files, so that a lost executor costs no recomputation of what led to them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def rows_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names; a null text becomes the empty text."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def groups_in_order(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 50_000
) -> Iterator[pa.Table]:
    """Tables of whole groups, cut only where the key changes, from batches sorted by ``keys``.

    A table has about ``rows`` rows, or one group if that is larger.
    """
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size < rows:
            continue
        whole = pa.concat_tables(held).combine_chunks()
        cuts = boundaries(whole, keys)
        last = int(cuts[-1])  # the last group may go on in the next batch
        if last:
            yield whole.slice(0, last)
        held, size = [whole.slice(last)], whole.num_rows - last
    if size:
        yield pa.concat_tables(held).combine_chunks()


def boundaries(whole: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each group of a sorted table."""
    changed = np.zeros(whole.num_rows, bool)
    changed[0] = True
    for key in keys:
        values = whole[key].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def crc_remainder(value: object, divisor: int) -> int:
    """What ``id_remainder`` gives, outside Spark."""
    return zlib.crc32(("" if value is None else str(value)).encode()) % divisor


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the result."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, rows_per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts of a bounded sample of labelled rows (doc_id, text, y), and the labelled ids of each class.

    Of each class the ids with the smallest hash are taken, whatever their order in the files.
    """
    labelled = (
        labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label_col).cast("int").alias("y"))
    )
    total = {r.y: r.n for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        labelled.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for y in (0, 1)
    ]
    picked = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * rows_per_class rows of two numbers
    return rows_of(docs, "doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "y"), total


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton steps on the standardised feature."""
    mean, scale = float(x.mean()), float(x.std()) or 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge * np.eye(2), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)
