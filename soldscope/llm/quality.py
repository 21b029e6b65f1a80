"""Quality by compression: dictionaries of good and bad labelled text, and which one packs a text better.

A text's UTF-8 bytes are cut into blocks, each block is compressed with the dictionary of good text
and with that of bad text, and the sums of the two sizes give
``(bad - good) / (bad + good)``. A logistic curve fitted on labelled rows turns this into a score.
Blocks are short so that the dictionary, not the text's own history, decides at every place.

The fit uses a bounded sample: at most ``SAMPLE_ROWS`` labelled rows a class, those with the smallest
hash of the id, and of each at most ``SAMPLE_BLOCKS`` blocks spread evenly over the whole text. Scoring
reads every block of every text.

Defined results: null and empty texts have difference 0; rows with null labels are not learned from;
ids repeated in the labels count once (the greatest label); with labels of one class only, or none,
every score is that class's share (0.5 if there is none); further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import fit_logistic, labelled_sample, rows_of

BLOCK = 512
DICTIONARY_BYTES = 112 * 1024
SAMPLE_ROWS = 1500
SAMPLE_BLOCKS = 12
LEVEL = 3


def blocks(raw: bytes, size: int = BLOCK) -> list[bytes]:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def spread(items: list[bytes], most: int) -> list[bytes]:
    """At most ``most`` items, evenly spread."""
    if len(items) <= most:
        return items
    return [items[i * len(items) // most] for i in range(most)]


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; few samples are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def difference(good: bytes, bad: bytes) -> Callable[[bytes], float]:
    """The normalised difference of the compressed sizes of one text."""
    packers = []
    for raw in (bad, good):
        if not raw:
            packers.append(zstandard.ZstdCompressor(level=LEVEL))
            continue
        held = zstandard.ZstdCompressionDict(raw)
        held.precompute_compress(level=LEVEL)
        packers.append(zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))

    def measure(raw: bytes) -> float:
        cut = blocks(raw)
        b, g = (sum(map(len, map(p.compress, cut))) for p in packers)
        return (b - g) / (b + g) if cut else 0.0

    return measure


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    constant: float | None = None

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.intercept, -500, 500)))


def fit(samples: list[tuple[int, list[bytes], float | None]]) -> QualityModel:
    """From (label, blocks, weight) rows: dictionaries on the even rows, calibration on the odd ones.

    ``weight`` is how many labelled rows one sampled row of its class stands for.
    """
    by_class = {y: [s for s in samples if s[0] == y] for y in (0, 1)}
    if not by_class[0] or not by_class[1]:
        share = 0.5 if not samples else float(bool(by_class[1]))
        return QualityModel(b"", b"", 0.0, 0.0, share)
    teach = {y: [b for _, cut, _ in rows[::2] for b in cut] for y, rows in by_class.items()}
    good, bad = dictionary(teach[1]), dictionary(teach[0])
    measure = difference(good, bad)
    tuned = [s for rows in by_class.values() for s in (rows[1::2] or rows)]
    x = np.array([measure(b"".join(cut)) for _, cut, _ in tuned])
    y = np.array([s[0] for s in tuned], float)
    # equal weight a class at first; the classes' true odds shift the intercept
    slope, intercept = fit_logistic(x, y)
    n = [sum(1 for s in tuned if s[0] == c) * by_class[c][0][2] for c in (0, 1)]
    seen = [sum(1 for s in tuned if s[0] == c) for c in (0, 1)]
    return QualityModel(good, bad, slope, intercept + math.log(n[1] / n[0]) - math.log(seen[1] / seen[0]))


def quality_sample(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows_per_class: int = SAMPLE_ROWS
) -> list[tuple[int, list[bytes], float]]:
    """The bounded sample: label, blocks, and the labelled rows that each row stands for."""
    sample, total = labelled_sample(docs, labels, label_col, rows_per_class)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [spread(blocks(t.encode()), SAMPLE_BLOCKS) for t in batch["text"].to_pylist()]
            yield pa.record_batch({"doc_id": batch["doc_id"], "y": batch["y"], "cut": pa.array(parts, pa.list_(pa.binary()))})

    rows = (
        sample.mapInArrow(cut, "doc_id long, y int, cut array<binary>")
        .groupBy("doc_id", "y")
        .agg(F.min("cut").alias("cut"))
        .orderBy("doc_id")
        .collect()
    )
    found = Counter(r.y for r in rows)
    return [(r.y, [bytes(b) for b in r.cut], total[r.y] / found[r.y]) for r in rows]


def quality_scores(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, difference and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of 112 kB at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        measure = difference(held.good, held.bad)
        for batch in batches:
            x = np.array([measure(t.encode()) for t in batch["text"].to_pylist()], float)
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "difference": pa.array(x, pa.float64()), "score": pa.array(held.probability(x), pa.float64())}
            )

    return rows_of(docs, id_col, text_col).mapInArrow(score, "doc_id long, difference double, score double")


def keep_good(docs: DataFrame, model: QualityModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, all columns as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        measure = difference(held.good, held.bad)
        for batch in batches:
            x = np.array([measure((t or "").encode()) for t in batch.column(place).to_pylist()], float)
            yield batch.filter(pa.array(held.probability(x) >= least))

    return docs.mapInArrow(choose, docs.schema)
