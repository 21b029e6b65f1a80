"""Jaccard join on word 5-grams with Bayesian pruning of MinHash candidates.

1. Texts become sets of hashed shingles (five lower-case words; a shorter text is one shingle). Texts
   with equal sets are one class from here on.
2. Classes that share a band of MinHash values are candidates. Inside a bucket, values are compared a
   few at a time, and a pair is dropped as soon as the posterior probability that its similarity reaches
   the threshold falls below the tolerance. What is left of a bucket is passed on as a spanning forest,
   never as all pairs.
3. The forests' connected components are clusters: all similar pairs lie within one. Clusters are cut
   into tiles of bounded size, each pair of tiles is one piece of work, its pairs are pruned again and
   verified exactly. Only counts a text and a spanning forest leave a tile.

Texts are told apart by id and text. Defined results: null and empty texts and texts without words have
no shingles, no links but to texts like them (all of these are one class), and similarity 1 among
themselves; texts with equal sets are linked to each other; repeated rows count as texts of one class;
an empty table gives an empty result; further columns are ignored by ``jaccard_groups`` and kept by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import boundaries, groups_in_order, mixed, rows_of, saved

WORDS = 5
THRESHOLD = 0.8
VALUES = 150  # MinHash values a text at most
MISS = 7e-6  # probability that no band of a pair at the threshold agrees
TOLERANCE = 1e-6
STEP = 25  # values compared at a time
TILE = 1024
_SEEDS = mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


@dataclass(frozen=True)
class Screen:
    """How candidates are found for a threshold: bands of as many values as ``miss`` and ``VALUES`` allow."""

    threshold: float = THRESHOLD
    tolerance: float = TOLERANCE
    miss: float = MISS

    @property
    def shape(self) -> tuple[int, int]:
        """(bands, values in each)."""
        return _shape(self.threshold, self.miss)

    @property
    def values(self) -> int:
        bands, rows = self.shape
        return bands * rows

    @property
    def steps(self) -> tuple[tuple[int, int], ...]:
        return least_matches(self.threshold, self.tolerance, self.values)


@lru_cache(maxsize=None)
def _shape(threshold: float, miss: float) -> tuple[int, int]:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and is at most 1")
    bands = lambda rows: max(1, ceil(log(miss) / log1p(-(threshold**rows)))) if threshold**rows < 1 else 1
    fitting = [(bands(rows), rows) for rows in range(1, VALUES + 1) if bands(rows) * rows <= VALUES]
    if not fitting:
        raise ValueError(f"similarity {threshold} needs more than {VALUES} values a text")
    return max(fitting, key=lambda s: s[1])


# ---- shingles and signatures ---------------------------------------------------------------------------


class Shingler:
    """Hashed shingle sets; word hashes are kept between texts."""

    def __init__(self, words: int = WORDS):
        self.words, self.kept = words, {}

    def of(self, text: str) -> np.ndarray:
        found = text.lower().split()
        if not found:
            return np.empty(0, np.uint64)
        if len(self.kept) > 500_000:
            self.kept.clear()
        kept = self.kept
        for w in set(found).difference(kept):
            kept[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([kept[w] for w in found], np.uint64)
        n = max(1, len(h) - self.words + 1)
        out = np.zeros(n, np.uint64)
        for i in range(min(self.words, len(h))):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
        return np.unique(out)


def signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """MinHash values (16 bits each) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), values), np.uint64)
    for i, seed in enumerate(_SEEDS[:values]):
        out[:, i] = np.minimum.reduceat(flat * seed, starts)
    return (mixed(out) & np.uint64(0xFFFF)).astype(np.uint16)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key a band."""
    rows = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), rows.shape[:2]) + np.uint64(1)
    for i in range(rows.shape[2]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i])
    return out


@lru_cache(maxsize=None)
def least_matches(threshold: float, tolerance: float, values: int) -> tuple[tuple[int, int], ...]:
    """(values compared, matches needed to go on): below, the posterior under a flat prior is too small."""
    grid = (np.arange(2000) + 0.5) / 2000
    out = []
    for n in [*range(STEP, values, STEP), values]:
        need = 0
        for m in range(n + 1):
            # the posterior of the similarity after m of n matches
            density = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid) - (m * log((m + 0.5) / (n + 1)) + (n - m) * log((n - m + 0.5) / (n + 1))))
            if density[grid >= threshold].sum() / density.sum() >= tolerance:
                need = m
                break
        out.append((n, need))
    return tuple(out)


def candidate_pairs(a: np.ndarray, b: np.ndarray | None, steps: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of signatures (or pairs within one) that no step of the comparison drops."""
    within = b is None
    b = a if within else b
    first, second = [], []
    for low in range(0, len(a), 256):
        block = a[low : low + 256]
        matches = np.zeros((len(block), len(b)), np.int32)
        n, need = steps[0]
        for i in range(n):
            matches += block[:, i, None] == b[None, :, i]
        alive = matches >= need
        if within:
            alive &= np.arange(low, low + len(block))[:, None] < np.arange(len(b))[None, :]
        x, y = np.nonzero(alive)
        met, seen = matches[x, y], n
        for n, need in steps[1:]:
            met = met + (block[x, seen:n] == b[y, seen:n]).sum(axis=1)
            live = met >= need
            x, y, met, seen = x[live], y[live], met[live], n
        first.append(x + low)
        second.append(y)
    return np.concatenate(first), np.concatenate(second)


def small_groups_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within each of many small groups."""
    first, second = [], []
    for size in np.unique(sizes[sizes > 1]):
        x, y = np.triu_indices(size, 1)
        at = starts[sizes == size]
        first.append((at[:, None] + x).ravel())
        second.append((at[:, None] + y).ravel())
    none = np.empty(0, np.int64)
    return (np.concatenate(first), np.concatenate(second)) if first else (none, none)


def pruned(signed: np.ndarray, x: np.ndarray, y: np.ndarray, steps: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no step of the comparison drops."""
    met, seen = np.zeros(len(x), np.int64), 0
    for n, need in steps:
        met = met + (signed[x, seen:n] == signed[y, seen:n]).sum(axis=1)
        live = met >= need
        x, y, met, seen = x[live], y[live], met[live], n
    return x, y


def surviving_pairs(
    signed: np.ndarray, cuts: np.ndarray, same: np.ndarray, left: np.ndarray, steps: tuple[tuple[int, int], ...], small: int = 16
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows within the groups that ``cuts`` delimit, after the Bayesian pruning.

    Where ``same`` is false the group holds two tiles, and only pairs between them count.
    """
    starts, sizes = cuts[:-1], np.diff(cuts)
    few = (sizes <= small) & same[starts]
    found = [pruned(signed, *small_groups_pairs(starts[few], sizes[few]), steps)]
    for i, j in zip(starts[~few], cuts[1:][~few]):
        here = np.arange(i, j)
        if same[i]:
            x, y = candidate_pairs(signed[i:j], None, steps)
            found.append((here[x], here[y]))
        else:
            one, two = here[left[i:j]], here[~left[i:j]]
            if len(one) and len(two):
                x, y = candidate_pairs(signed[one], signed[two], steps)
                found.append((one[x], two[y]))
    return tuple(np.concatenate(z) for z in zip(*found))


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component, by hooking and halving."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
        if (root == before).all():
            return root


# ---- in Spark -------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of a graph given as edges a, b.

    Each round every node takes the smallest root among its neighbours' and then its root's root; both
    are aggregates over edges, whatever the degree. Rounds are written to the shared folder.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = saved(both.where("a <> b").distinct(), "edges")
    label = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        heard = both.join(label.withColumnsRenamed({"node": "b", "root": "heard"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        near = label.join(heard, "node").select("node", F.least("root", "heard").alias("next"), "root")
        jump = label.withColumnsRenamed({"node": "next", "root": "further"})
        step = saved(near.join(jump, "next").select("node", F.least("next", "further").alias("root"), F.col("root").alias("was")), "roots")
        label = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return label


def _classes(texts: DataFrame, screen: Screen) -> tuple[DataFrame, DataFrame]:
    """Each text's class (the 64-bit digest pair of its set), and per class a member and the signature."""

    values = screen.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            column = batch["text"].to_pylist()
            for low in range(0, len(column), 256):
                sets = [shingler.of(t) for t in column[low : low + 256]]
                some = [i for i, s in enumerate(sets) if len(s)]
                signed = signatures([sets[i] for i in some], values) if some else np.empty((0, values), np.uint16)
                packed: list[bytes | None] = [None] * len(sets)
                for i, s in zip(some, signed):
                    packed[i] = s.tobytes()
                digest = [int(mixed(s).sum(dtype=np.uint64) ^ mixed(s * np.uint64(3) + np.uint64(len(s))).sum(dtype=np.uint64)) for s in sets]
                other = [int((mixed(s ^ np.uint64(0x5851F42D4C957F2D))).sum(dtype=np.uint64)) for s in sets]
                here = batch.slice(low, len(sets))
                yield pa.record_batch(
                    {
                        "doc_id": here["doc_id"],
                        "tkey": here["tkey"],
                        "class": pa.array(np.array(digest, np.uint64).view(np.int64)),
                        "other": pa.array(np.array(other, np.uint64).view(np.int64)),
                        "size": pa.array([len(s) for s in sets], pa.int32()),
                        "signature": pa.array(packed, pa.binary()),
                    }
                )

    schema = "doc_id long, tkey long, class long, other long, size int, signature binary"
    signed = saved(texts.mapInArrow(run, schema), "signatures")
    members = signed.select("doc_id", "tkey", "class", "other")
    classes = signed.groupBy("class", "other").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey")).alias("rep"),
        F.count(F.lit(1)).alias("texts"),
        F.max("size").alias("size"),
        F.max("signature").alias("signature"),
    )
    return members, classes


def _pairs_of(whole: pa.Table, key: str, screen: Screen) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node numbers, signatures and surviving pairs of rows of whole groups."""
    cuts = np.append(boundaries(whole, [key, "ta", "tb"]), whole.num_rows)
    signed = np.frombuffer(b"".join(whole["signature"].to_pylist()), np.uint16).reshape(-1, screen.values)
    same = whole["ta"].to_numpy() == whole["tb"].to_numpy()
    x, y = surviving_pairs(signed, cuts, same, whole["left"].to_numpy().astype(bool), screen.steps)
    return whole["node"].to_numpy(), signed, x, y


def _bucket_forest(rows: DataFrame, screen: Screen) -> DataFrame:
    """Spanning forest a, b (class numbers) of what the pruning leaves of each bucket and tile pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in groups_in_order(batches, ["key", "ta", "tb"], 20_000):
            node, signed, x, y = _pairs_of(whole, "key", screen)
            root = forest(len(node), x, y)
            tied = np.flatnonzero(root != np.arange(len(node)))
            yield pa.record_batch({"a": pa.array(node[root[tied]]), "b": pa.array(node[tied])})

    return rows.mapInArrow(run, "a long, b long")


def _tiled(rows: DataFrame, key: str, n: str, tile: int) -> DataFrame:
    """Rows of a group of ``n`` rows at the tile pairs (ta <= tb) they belong to; ``left``: as tile ta."""
    tiles = F.ceil(F.col(n) / tile).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(11)), tiles).cast("int")
    spread = rows.withColumn("tiles", tiles).withColumn("own", own)
    facing = spread.withColumn("facing", F.explode(F.expr("sequence(0, tiles - 1)")))
    return (
        facing.withColumn("ta", F.least("own", "facing"))
        .withColumn("tb", F.greatest("own", "facing"))
        .withColumn("left", F.col("own") <= F.col("facing"))
        .drop("tiles", "own", "facing")
        .repartition(F.col(key), "ta", "tb")
        .sortWithinPartitions(key, "ta", "tb")
    )


def _verified(rows: DataFrame, screen: Screen) -> DataFrame:
    """Per tile pair: links of each class (texts of other classes at the threshold), and a forest.

    Rows (node, links, root): root is null for counts, links null for the forest's edges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in groups_in_order(batches, ["cluster", "ta", "tb"], 2_000):
            node, _, x, y = _pairs_of(whole, "cluster", screen)
            texts = whole["texts"].to_numpy()
            similar = jaccard_at_least([np.frombuffer(s, np.uint64) for s in whole["shingles"].to_pylist()], x, y, screen.threshold)
            x, y = x[similar], y[similar]
            links = np.bincount(x, texts[y], len(node)) + np.bincount(y, texts[x], len(node))
            some = np.flatnonzero(links)
            root = forest(len(node), x, y)
            tied = np.flatnonzero(root != np.arange(len(node)))
            yield pa.record_batch(
                {
                    "node": pa.array(np.concatenate([node[some], node[tied]])),
                    "links": pa.array([*links[some].astype(np.int64).tolist(), *[None] * len(tied)], pa.int64()),
                    "root": pa.array([*[None] * len(some), *node[root[tied]].tolist()], pa.int64()),
                }
            )

    return rows.mapInArrow(run, "node long, links long, root long")


def jaccard_at_least(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sorted sets reach the threshold, exactly."""
    if not len(x):
        return np.empty(0, bool)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    place = np.unique(flat, return_inverse=True)[1]
    starts = np.cumsum(size) - size
    out = np.zeros(len(x), bool)
    mark = np.zeros(int(place.max(initial=0)) + 1, bool)
    order = np.argsort(x, kind="stable")
    edges = np.append(np.flatnonzero(np.concatenate([[True], x[order][1:] != x[order][:-1]])), len(x))
    for i, j in zip(edges[:-1], edges[1:]):
        pairs = order[i:j]
        a = int(x[pairs[0]])
        own = place[starts[a] : starts[a] + size[a]]
        mark[own] = True
        # sizes too unlike rule a pair out before its sets are read
        fits = pairs[np.minimum(size[y[pairs]], size[a]) >= threshold * np.maximum(size[y[pairs]], size[a]) - 1e-9]
        for p in fits:
            b = int(y[p])
            shared = int(np.count_nonzero(mark[place[starts[b] : starts[b] + size[b]]]))
            out[p] = shared >= threshold * (size[a] + size[b] - shared) - 1e-9
        mark[own] = False
    return out


def _shingle_rows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and packed shingles of the texts that stand for the classes in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            packed = [shingler.of(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.record_batch({"node": batch["node"], "shingles": pa.array(packed, pa.binary())})

    reps = wanted.select("node", F.col("rep.doc_id").alias("r_id"), F.col("rep.tkey").alias("r_key"))
    same = texts["doc_id"].eqNullSafe(reps["r_id"]) & (texts["tkey"] == reps["r_key"])
    found = texts.join(reps, same).select("node", "text").mapInArrow(run, "node long, shingles binary")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))  # repeated rows: any of them


def jaccard_groups(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
    miss: float = MISS,
) -> DataFrame:
    """One row a document: doc_id, text_class, class_texts, n_links, group_id.

    A pair at the threshold or above is missed with a probability of at most ``miss`` by the bands and of
    about ``tolerance`` by the pruning.

    ``text_class`` is the smallest id with the same set of shingles, ``n_links`` counts the other
    documents at the threshold or above (those of the own class included), and ``group_id`` is the
    smallest id of all documents that chains of links reach. Null ids come last.
    """
    found = _groups(docs, Screen(threshold, tolerance, miss), tile, id_col, text_col)
    return found.select(
        "doc_id", F.col("rep.doc_id").alias("text_class"), F.col("texts").alias("class_texts"),
        (F.col("links") + F.col("texts") - 1).alias("n_links"), F.col("group_rep.doc_id").alias("group_id"),
    )


def _groups(docs: DataFrame, screen: Screen, tile: int, id_col: str, text_col: str) -> DataFrame:
    texts = rows_of(docs, id_col, text_col).withColumn("tkey", F.xxhash64("text"))
    members, classes = _classes(texts, screen)
    # a class is known by a number of its own: 64 bits of its set's digest pair
    numbered = saved(classes.withColumn("node", F.xxhash64("class", "other")), "classes")
    signed = numbered.where("signature is not null").select("node", "signature")

    n_bands, values = screen.shape[0], screen.values

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint16).reshape(-1, values)
            keys = band_keys(held, n_bands)
            yield pa.record_batch(
                {"key": pa.array(keys.ravel().view(np.int64)), "node": pa.array(np.repeat(batch["node"].to_numpy(), n_bands))}
            )

    keyed = signed.mapInArrow(bands, "key long, node long")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = saved(keyed.join(shared, "key"), "buckets")
    edges = saved(_bucket_forest(_tiled(met.join(signed, "node"), "key", "n", tile), screen), "forest")
    clusters = components(edges).withColumnRenamed("root", "cluster")
    sized = clusters.join(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "cluster")
    in_cluster = saved(sized.join(numbered.select("node", "rep", "texts", "signature"), "node"), "clusters")
    full = in_cluster.drop("rep").join(_shingle_rows(texts, in_cluster), "node")
    found = saved(_verified(_tiled(full, "cluster", "n", tile), screen), "links")
    links = found.where("root is null").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("root is not null").select(F.col("root").alias("a"), F.col("node").alias("b")))
    grouped = numbered.join(joined, "node", "left").join(links, "node", "left").select(
        "class", "other", "texts", "rep", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")
    )
    names = grouped.groupBy("root").agg(F.min("rep").alias("group_rep"))
    return _on_class(members, grouped.join(names, "root").drop("root"))


def _on_class(members: DataFrame, named: DataFrame, salts: int = 16) -> DataFrame:
    """Each member with its class; members are salted, so that a large class is spread."""

    def salt(*columns: str):
        return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")

    alone = F.array(salt("rep.doc_id", "rep.tkey"))
    copies = F.when(F.col("texts") == 1, alone).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))
    named = named.withColumn("salt", F.explode(copies))
    return members.withColumn("salt", salt("doc_id", "tkey")).join(named, ["class", "other", "salt"])


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of linked documents the one with the smallest id; all columns as they came.

    Rows repeated with the same id and text stay together.
    """
    groups = _groups(docs, Screen(threshold), TILE, id_col, text_col)
    is_kept = F.col("doc_id").eqNullSafe(F.col("group_rep.doc_id")) & (F.col("tkey") == F.col("group_rep.tkey"))
    kept = groups.where(is_kept).select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct()
    own_key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = docs[id_col].cast("long").eqNullSafe(kept["__id"]) & (own_key == kept["__key"])
    return docs.join(kept, same, "left_semi")
