"""Importance resampling towards a target text: hashed word runs, weights, a draw without replacement.

A text becomes words joined by single blanks. One scan of it stores the running CRC-32 before and after
every word. The CRC of any run of words then follows from two of them: the CRC of what comes before, moved
over the run's bytes by a linear map over GF(2), cancels out of the CRC after the run. So runs of every
length up to ``longest`` cost a few table look-ups each and no second pass over their bytes.

Counts per bucket are summed in each task first, so a word that fills a third of the corpus is one number a
task. Gains are one number a bucket, whatever the size of the corpus. The draw takes the highest
``weight + Gumbel noise`` of the documents with enough words; their places come from a range partitioning.

Defined results: a null text has no words, no features and weight 0; a null id counts as the empty text
in the noise and sorts first among ties; equal rows are drawn one by one; an empty table gives an empty
result, an empty target gives gains by the same formula; further columns are ignored. A text of any
length passes in pieces of about ``BLOCK`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import rows_of, saved
from soldscope.operators.ordinal import numbered

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
BLOCK = 1 << 20  # bytes of text, or of short texts together, that are worked on at once

# every byte outside words becomes a blank, capital letters become small
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


# ---- CRC of a part from the CRCs of two beginnings --------------------------------------------------


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """[k, byte, value]: a CRC register moved over 2**k zero bytes, by the bytes of the register."""
    zero_bit = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint32)  # images of the 32 single bits

    def mapped(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for i in range(32):
            out ^= np.where((x >> np.uint32(i)) & np.uint32(1), columns[i], np.uint32(0))
        return out

    columns = zero_bit
    for _ in range(3):  # one bit, two, four, eight: one byte
        columns = mapped(columns, columns)
    values = np.arange(256, dtype=np.uint32)
    tables = []
    for _ in range(32):
        tables.append([mapped(columns, values << np.uint32(8 * b)) for b in range(4)])
        columns = mapped(columns, columns)
    return np.array(tables, np.uint32)


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``crc`` moved over ``length`` bytes."""
    tables, byte = _shifts(), np.uint32(255)
    out = crc.astype(np.uint32)
    for k in range(int(length.max(initial=0)).bit_length()):
        rows = np.flatnonzero((length >> k) & 1)
        x = out[rows]
        t = tables[k]
        out[rows] = t[0][x & byte] ^ t[1][(x >> np.uint32(8)) & byte] ^ t[2][(x >> np.uint32(16)) & byte] ^ t[3][x >> np.uint32(24)]
    return out


def part_crc(before: np.ndarray, through: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of the last ``length`` bytes of a beginning, from the CRCs without and with them."""
    return through ^ shifted(before, length)


# ---- one scan a text --------------------------------------------------------------------------------


def _cuts(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces that end between words."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + BLOCK)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def running(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of words: (text number, CRC before, CRC through, start, end) in the normalised text."""
    rows: list[int] = []
    before: list[int] = []
    through: list[int] = []
    lengths: list[int] = []
    starts: list[int] = []
    held = 0

    def block() -> tuple[np.ndarray, ...]:
        start = np.array(starts, np.int64)
        return (
            np.array(rows, np.int64),
            np.array(before, np.uint32),
            np.array(through, np.uint32),
            start,
            start + np.array(lengths, np.int64),
        )

    for row, data in enumerate(texts):
        crc, at = 0, 0
        for piece in _cuts((data or b"").translate(_TABLE)):
            words = piece.split()
            for word in words:
                crc = crc32(b" ", crc)
                before.append(crc)
                crc = crc32(word, crc)
                through.append(crc)
                at += 1
                starts.append(at)
                at += len(word)
            lengths.extend(map(len, words))
            rows.extend([row] * len(words))
            held += len(piece)
            if held >= BLOCK:
                yield block()
                for values in (rows, before, through, lengths, starts):
                    values.clear()
                held = 0
    if rows:
        yield block()


def features(texts: Iterable[bytes | None], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(text number, bucket, words in the run) of all runs of 1 to ``longest`` words, block by block."""
    carried = [np.zeros(0, t) for t in (np.int64, np.uint32, np.uint32, np.int64, np.int64)]
    for block in running(texts):
        kept = len(carried[0])
        row, before, through, start, end = (np.concatenate(x) for x in zip(carried, block))
        for n in range(1, longest + 1):
            last = np.arange(max(kept, n - 1), len(row))
            first = last - (n - 1)
            same = row[first] == row[last]
            first, last = first[same], last[same]
            crc = part_crc(before[first], through[last], end[last] - start[first])
            yield row[last], (crc % np.uint32(buckets)).astype(np.int64), n
        carried = [x[len(x) - (longest - 1) :] for x in (row, before, through, start, end)]


def _bytes(batch: pa.RecordBatch) -> list[bytes | None]:
    column = batch["text"]
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


# ---- counts, gains, draw ----------------------------------------------------------------------------


def bucket_counts(df: DataFrame, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> dict[int, int]:
    """Features a bucket over all texts; at most ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features(_bytes(batch), longest, buckets):
                met += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(met)
        yield pa.record_batch([pa.array(used), pa.array(met[used])], names=["bucket", "n"])

    counted = df.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    return {r.bucket: r.n for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of target to source share, by bucket, with one added to each count."""
    s_all, t_all = sum(source.values()), sum(target.values())
    ratio = lambda s, t: float(t + 1) * (s_all + buckets) / (float(s + 1) * (t_all + buckets))
    return np.array([floor(1000 * log(ratio(source.get(b, 0), target.get(b, 0)))) for b in range(buckets)], np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise in thousandths, a function of the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def weights(
    docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight and score (weight and noise) of every document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, met, total = (np.zeros(n, np.int64) for _ in range(3))
            for row, bucket, run in features(_bytes(batch), longest, len(gain)):
                each = np.bincount(row, minlength=n)
                met += each
                if run == 1:
                    words += each
                first, last = (int(row[0]), int(row[-1]) + 1) if len(row) else (0, 0)
                edges = np.searchsorted(row, np.arange(first, last + 1))
                summed = np.concatenate([[0], np.cumsum(gain[bucket])])
                total[first:last] += summed[edges[1:]] - summed[edges[:-1]]
            weight = np.where(met > 0, total // np.maximum(met, 1), 0)
            ids = batch["doc_id"]
            score = weight + np.fromiter((noise(i, seed) for i in ids.to_pylist()), np.int64, n)
            yield pa.record_batch(
                [ids, pa.array(words), pa.array(met), pa.array(weight), pa.array(score)],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    return rows_of(docs, id_col, text_col).mapInArrow(weigh, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; rank is null where not drawn."""
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets), buckets)
    scored = saved(weights(docs, gain, longest, seed, id_col, text_col), "weights")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    placed = numbered(scored.where(enough), [F.col("score").desc(), F.col("doc_id").asc()], "rank")
    return placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    )
