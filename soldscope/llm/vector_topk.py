"""Exact top-k inner products over a vector-approximation file.

The file holds, for every vector, one byte a component: the cell of that component's range that it falls
into. It is written once; searches scan it in blocks and never read exact vectors while they scan.

1. Each block of queries meets each block of cells. Cells bound every score from both sides. A block
   passes on, for each query, the vectors whose upper bound reaches its own kth lower bound; of equal
   vectors it keeps the k + 1 smallest ids, so copies without number stay few.
2. The kth lower bound over all blocks leaves the survivors of a query.
3. The exact vectors of the ``k`` survivors with the highest upper bounds are fetched by a join; the kth
   exact score is the new limit, and only survivors whose upper bound still reaches it are fetched after.

Components and scores are 64-bit integers. Bounds are floating-point numbers widened by more than their
rounding. Blocks whose scores might leave 53 bits are multiplied as Python integers, and a score that
leaves 64 bits is an error, never a wrapped number.

Defined results: null vectors, vectors with null or non-finite components, and null ids take no part;
only vectors of equal length are compared; rows with the query's id are the query's own; of queries
repeated with one id the greatest vector is asked; rows repeated with one id are candidates one by one;
ties go to the smaller id; fewer than k candidates give all of them; empty tables give an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soldscope.llm.common import boundaries, groups_in_order, saved

CELLS = 256
QUERY_BLOCK = 256
VECTOR_BLOCK = 8192
_BOUNDS = "dim int, query_id long, row long, least double, most double"


def usable(column: str) -> Column:
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~bad


def whole_numbers(values: Column) -> Column:
    """Doubles rounded down to 64-bit integers; one that has no such integer is an error."""
    fits = lambda v: (v >= -(2.0**63)) & (v < 2.0**63)
    floor = lambda v: F.when(fits(v), F.floor(v).cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("component beyond 64 bits: "), v.cast("string"))).cast("long")
    )
    return F.transform(values, floor)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def bounds(q: np.ndarray, low: np.ndarray, width: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score that a vector of each row of cells can have with each query."""
    at_low = (q @ low)[:, None] + (q * width) @ cells.T.astype(np.float64)
    least = at_low + (np.minimum(q, 0) @ (width - 1))[:, None]
    most = at_low + (np.maximum(q, 0) @ (width - 1))[:, None]
    # sums of dim products, each with a relative error of a few units in the last place
    reach = np.abs(q) @ (np.abs(low) + width * CELLS)
    slack = (reach * (len(low) + 8) * 2.0**-50)[:, None]
    return least - slack, most + slack


def exact_scores(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products of rows with one query, exact whatever their size."""
    span = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(q.astype(np.float64)).max(initial=0)) * max(1, len(q))
    if span < 2**52:
        return [int(s) for s in x.astype(np.float64) @ q.astype(np.float64)]
    return [sum(a * b for a, b in zip(row, q.tolist())) for row in x.tolist()]


class Grid:
    """Cells of one length of vectors: where each component's range starts and how wide a cell is."""

    def __init__(self, least: list[int], most: list[int], cells: int = CELLS):
        self.low = least
        self.width = [max(1, -(-(b - a + 1) // cells)) for a, b in zip(least, most)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """One byte a component."""
        low, width = np.array(self.low, np.int64), np.array(self.width, object)
        if max(self.width, default=1) < 2**54:  # differences fit 64 bits
            return ((x - low) // width.astype(np.int64)).astype(np.uint8)
        return ((x.astype(object) - low.astype(object)) // width).astype(np.uint8)


def grids(vectors: DataFrame, vec_col: str) -> dict[int, Grid]:
    """A grid for every length; two numbers a component reach the driver."""
    ranges = (
        vectors.select(F.size(vec_col).alias("dim"), F.posexplode(vec_col).alias("at", "v"))
        .groupBy("dim", "at").agg(F.min("v").alias("least"), F.max("v").alias("most"))
        .groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("at", "least", "most"))).alias("r"))
    )
    return {r.dim: Grid([x.least for x in r.r], [x.most for x in r.r]) for r in ranges.collect()}


def approximation(vectors: DataFrame, vec_col: str, held: dict[int, Grid]) -> DataFrame:
    """The approximation file: row, id, dim, the packed cells and a digest in two halves of every vector."""

    def rows(batch: pa.RecordBatch, packed: list[bytes]) -> pa.RecordBatch:
        whole = [blake2b(np.array(x.as_py(), np.int64).tobytes(), digest_size=16).digest() for x in batch["x"]]
        halves = np.frombuffer(b"".join(whole), np.int64).reshape(-1, 2)
        return pa.record_batch(
            {
                "row": batch["row"], "id": batch["id"], "dim": batch["dim"], "packed": pa.array(packed, pa.binary()),
                "half": pa.array(halves[:, 0].copy()), "other": pa.array(halves[:, 1].copy()),
            }
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch["dim"].to_pylist(), batch["x"])
            yield rows(batch, [held[dim].cells(np.array(x.as_py(), np.int64)).tobytes() if dim else b"" for dim, x in pairs])

    def pack_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (dim, grid), = held.items()
        for batch in batches:
            cells = grid.cells(_matrix(batch["x"])) if batch.num_rows and dim else np.empty((batch.num_rows, 0), np.uint8)
            yield rows(batch, [c.tobytes() for c in cells])

    schema = "row long, id long, dim int, packed binary, half long, other long"
    return vectors.select("row", "id", "dim", F.col(vec_col).alias("x")).mapInArrow(pack_alike if len(held) == 1 else pack, schema)


def _few_of_each(ids: np.ndarray, half: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    """Rows of a block: of equal vectors only the ``n`` smallest ids, since ties go to smaller ids."""
    order = np.lexsort((ids, other, half))
    new = np.ones(len(ids), bool)
    new[1:] = (half[order][1:] != half[order][:-1]) | (other[order][1:] != other[order][:-1])
    first = np.flatnonzero(new)
    turn = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    return np.sort(order[turn < n])


def _kept(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, cells: np.ndarray, grid: Grid, k: int) -> tuple:
    """Of one block: (query, row, least, most) of the vectors that can be among a query's k best here."""
    least, most = bounds(q.astype(np.float64), np.array(grid.low, np.float64), np.array(grid.width, np.float64), cells)
    own = q_ids[:, None] == ids[None, :]
    least[own] = most[own] = -np.inf
    n = len(ids)
    limit = np.partition(least, n - k, axis=1)[:, n - k, None] if n > k else np.full((len(q), 1), -np.inf)
    i, j = np.nonzero((most >= limit) & ~own)
    return q_ids[i], rows[j], least[i, j], most[i, j]


def exact_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "cells",
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best vectors by integer inner product for each query.

    ``vec_col`` holds arrays of long. Each block of queries goes to each block of cells.
    """
    columns = (F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"), F.col(vec_col).alias("x"))
    base = saved(vectors.where(F.col(id_col).isNotNull()).select(F.monotonically_increasing_id().alias("row"), *columns), "vectors")
    asked = queries.where(F.col(id_col).isNotNull()).select(*columns)
    asked = saved(asked.groupBy("id").agg(F.max(F.struct("dim", "x")).alias("v")).select("id", "v.dim", "v.x"), "queries")
    held = grids(base, "x")
    file = saved(approximation(base, "x", held), "approximation")
    q_blocks, v_blocks = max(1, -(-asked.count() // query_block)), max(1, -(-file.count() // vector_block))

    facing = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n)).cast("int")
    none = lambda kind: F.lit(None).cast(kind)
    one = asked.select("dim", block(q_blocks).alias("qb"), facing(v_blocks).alias("vb"), none("long").alias("row"), "id", "x", none("binary").alias("packed"), none("long").alias("half"), none("long").alias("other"))
    two = file.select("dim", facing(q_blocks).alias("qb"), block(v_blocks).alias("vb"), "row", "id", none("array<long>").alias("x"), "packed", "half", "other")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["dim", "qb", "vb"]
        for whole in groups_in_order(batches, keys, 2 * vector_block):
            cuts = np.append(boundaries(whole, keys), whole.num_rows).tolist()
            for a, b in zip(cuts, cuts[1:]):
                group = whole.slice(a, b - a)
                n = group["row"].null_count  # queries come first
                if not n or n == group.num_rows:
                    continue
                dim = group["dim"][0].as_py()
                ids, rows, half, other = (group[c][n:].to_numpy() for c in ("id", "row", "half", "other"))
                cells = np.frombuffer(b"".join(group["packed"][n:].to_pylist()), np.uint8).reshape(len(ids), -1)
                few = _few_of_each(ids, half, other, k + 1)  # one of them may be the query's own
                found = _kept(group["id"][:n].to_numpy(), _matrix(group["x"][:n]), ids[few], rows[few], cells[few], held[dim], k)
                yield pa.record_batch([pa.array([dim] * len(found[0]), pa.int32()), *map(pa.array, found)], names=["dim", "query_id", "row", "least", "most"])

    met = one.unionByName(two).repartition("dim", "qb", "vb").sortWithinPartitions("dim", "qb", "vb", F.col("row").isNotNull())
    possible = saved(met.mapInArrow(scan, _BOUNDS), "bounds")
    by_least = Window.partitionBy("query_id").orderBy(F.desc("least"))
    limit = possible.withColumn("r", F.row_number().over(by_least)).where(F.col("r") == k).select("query_id", F.col("least").alias("limit"))
    by_most = Window.partitionBy("query_id").orderBy(F.desc("most"), "row")
    survivors = saved(
        possible.join(limit, "query_id", "left").where(F.col("limit").isNull() | (F.col("most") >= F.col("limit")))
        .select("query_id", "row", "most", F.row_number().over(by_most).alias("turn")),
        "survivors",
    )
    first = saved(_scored(survivors.where(F.col("turn") <= k), base, asked), "scores")
    certain = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    later = survivors.where(F.col("turn") > k).join(certain.where(F.col("n") >= k), "query_id").where(F.col("most") >= F.col("kth").cast("double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(_scored(later, base, asked))
        .withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _scored(pairs: DataFrame, base: DataFrame, asked: DataFrame) -> DataFrame:
    """query_id, vec_id, score: exact vectors fetched for the given (query_id, row)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, q = batch["x"].to_pylist(), batch["q"].to_pylist()
            out = [exact_scores(np.array([a], np.int64), np.array(b, np.int64))[0] for a, b in zip(x, q)]
            if any(not -(2**63) <= s < 2**63 for s in out):
                raise OverflowError("a score among the best leaves 64 bits")
            yield pa.record_batch({"query_id": batch["query_id"], "vec_id": batch["vec_id"], "score": pa.array(out, pa.int64())})

    fetched = pairs.select("query_id", "row").join(base.select("row", F.col("id").alias("vec_id"), "x"), "row")
    both = fetched.join(asked.select(F.col("id").alias("query_id"), F.col("x").alias("q")), "query_id")
    return both.select("query_id", "vec_id", "x", "q").mapInArrow(score, "query_id long, vec_id long, score long")
