"""Bytes of long strings that occur more than once, by run-compressed Burrows-Wheeler indexes.

Every string of ``length`` bytes has a key: the least hash of the grams inside it. Equal strings have
equal keys, so neighbouring strings of one key form a *stretch* (about every 80 bytes), and only
stretches of one key can hold equal strings.

1. Stretches with a key of their own, and whose strings differ among themselves, end here.
2. Stretches that are equal as a whole (same key and same digest, 64 bits each) occur again as a whole.
3. Of the different stretches that share a key one copy each goes into an index: a Burrows-Wheeler
   transform in runs, with text positions kept at run ends only. Between run ends the longest match
   with a neighbour falls by one a byte, so a pass over the kept positions gives every place where a
   string of ``length`` bytes starts a second time (matching statistics against all other places).
4. Keys whose different stretches hold more than ``group_bytes`` bytes are not gathered in one task. Their
   strings are compared by digest one by one, in a distributed count.

Every row gets a number, written with its text, and all steps know it by that number alone.

Defined results: a null text counts as empty; texts shorter than ``length`` lose nothing; rows with
equal or null ids are told apart by their row numbers, and equal texts remove each other; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import boundaries, groups_in_order, mixed, rows_of, saved

LENGTH = 200
GRAM = 40
GROUP_BYTES = 2_500_000
_INDEX_BYTES = 1_500_000  # the index takes about 80 bytes a byte
_BASE = np.uint64(0x9E3779B97F4A7C15)


# ---- keys of strings -----------------------------------------------------------------------------------


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.full(n, base, np.uint64)) if n else np.empty(0, np.uint64)


class Roller:
    """Hashes of all substrings of one length, by prefix sums modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def hashes(self, raw: np.ndarray, gram: int) -> np.ndarray:
        n = len(raw)
        if len(self.up) < n + 1:
            self.up = _powers(_BASE, 2 * n + 1)
            self.down = _powers(np.uint64(pow(int(_BASE), -1, 2**64)), 2 * n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return mixed((sums[gram:] - sums[:-gram]) * self.down[: n - gram + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(
    raw: np.ndarray, roller: Roller, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, first and last start, and ``folds`` of the stretches of a text of at least ``length`` bytes.

    ``folds``: the least hash stands at several places of the stretch, without which no two of its
    strings can be equal.
    """
    width = length - gram + 1
    hashes = roller.hashes(raw, gram)
    key = sliding_min(hashes, width)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    last = np.append(first[1:], len(key)) - 1
    # a place holds the least hash of some string exactly if the greatest key around it is its hash
    none = np.full(width - 1, np.uint64(2**64 - 1))
    greatest = ~sliding_min(np.concatenate([none, ~key, none]), width)
    least_at = np.flatnonzero(hashes == greatest)
    low = np.searchsorted(least_at, first)
    many = np.searchsorted(least_at, last + width - 1, side="right") - low
    of = np.repeat(np.arange(len(first)), many)
    place = least_at[np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]
    same = hashes[place] == key[first][of]
    return key[first], first, last, np.bincount(of[same], minlength=len(first)) > 1


# ---- the index -------------------------------------------------------------------------------------------


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of an integer text in order, by doubling; only places still open are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    head = np.concatenate([[True], text[order[1:]] != text[order[:-1]]])
    firsts = np.flatnonzero(head)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(firsts, np.diff(np.append(firsts, n)))
    slots = np.arange(n)
    reach = 1
    while True:
        # of the slots sorted last, those in groups of more than one suffix are open
        firsts = np.flatnonzero(head)
        sizes = np.diff(np.append(firsts, len(slots)))
        kept = np.repeat(sizes > 1, sizes)
        slots = slots[kept]
        if not len(slots):
            return order
        suffix = order[slots]
        after = suffix + reach
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        again = np.argsort(rank[suffix] * (n + 1) + second + 1, kind="stable")
        suffix, second = suffix[again], second[again]
        first = rank[suffix]
        head = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        order[slots] = suffix
        begun = np.flatnonzero(head)
        rank[suffix] = np.repeat(slots[begun], np.diff(np.append(begun, len(slots))))
        reach *= 2


class RunIndex:
    """Burrows-Wheeler transform of an integer text in runs, with text positions at run starts.

    ``sample`` holds the text position of the first suffix of each run, ``before`` that of the suffix
    just before it in suffix order, and ``match`` how many symbols the two share.
    """

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        order = suffix_order(text)
        bwt = text[order - 1]  # the symbol before each suffix; the text counts as a circle
        starts = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.symbols, self.lengths = bwt[starts], np.diff(np.append(starts, self.n))
        starts = starts[starts > 0]
        sample, before = order[starts], order[starts - 1]
        by_place = np.argsort(sample)
        self.sample, self.before = sample[by_place], before[by_place]
        self.match = common_prefix(text, self.sample, self.before)

    def repeats(self, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places [first, last] whose string of ``length`` symbols is also that of the suffix before,
        and the same seen from that suffix.

        Streams the matching statistics: from one kept position to the next, the match with the suffix
        before loses one symbol a step, so ``match - length`` further places belong to each.
        """
        last = np.minimum(self.sample + self.match - length, np.append(self.sample[1:], self.n) - 1)
        ok = last >= self.sample
        first, last, other = self.sample[ok], last[ok], self.before[ok]
        return [(first, last), (other, other + last - first)]


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 64) -> np.ndarray:
    """Symbols that different suffixes share; each holds an end symbol of its own, so they differ."""
    padded = np.concatenate([text, np.full(step, -1, text.dtype)])
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    span = np.arange(step)
    at = 0
    while len(live):
        open_ = []
        for part in np.array_split(live, -(-len(live) // 16_384)):
            unlike = padded[(a[part] + at)[:, None] + span] != padded[(b[part] + at)[:, None] + span]
            met = np.where(unlike.any(axis=1), unlike.argmax(axis=1), step)
            out[part] += met
            open_.append(part[met == step])
        live = np.concatenate(open_)
        at += step
    return out


def repeated_in(parts: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(part, first, last): runs of starts of strings that occur twice in the parts.

    Each part ends with a symbol of its own. All strings of a part have the part's key, so parts of
    different keys have no string in common and may share an index.
    """
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1)
    text = np.empty(ends[-1], np.int32)
    stops = ends - 1
    inside = np.ones(len(text), bool)
    inside[stops] = False
    text[inside] = np.frombuffer(b"".join(parts), np.uint8)
    text[stops] = 256 + np.arange(len(parts))
    index = RunIndex(text)
    marked = np.zeros(len(text) + 1, np.int64)
    for first, last in index.repeats(length):
        np.add.at(marked, first, 1)
        np.add.at(marked, last + 1, -1)
    on = np.cumsum(marked)[:-1] > 0
    edges = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    begun, over = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
    part = np.searchsorted(ends, begun, side="right")
    base = ends[part] - sizes[part] - 1
    yield from zip(part.tolist(), (begun - base).tolist(), (over - base).tolist())


# ---- the steps, in Spark -----------------------------------------------------------------------------------

_STRETCH = "row long, key long, digest long, first int, last int, folds boolean"
_PART = "key long, row long, first int, once boolean, part binary"
_SPANS = "row long, first int, last int"


def _stretches(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            held = []
            for row, text in zip(*(batch[c].to_pylist() for c in ("row", "text"))):
                raw = text.encode()
                if len(raw) < length:
                    continue
                key, first, last, folds = stretches(np.frombuffer(raw, np.uint8), roller, length, gram)
                digest = [xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(first.tolist(), (last + length).tolist())]
                held.append((row, key, np.array(digest, np.uint64), first, last, folds))
                if sum(len(h[1]) for h in held) > 100_000:
                    yield _stretch_batch(held)
                    held = []
            if held:
                yield _stretch_batch(held)

    return texts.mapInArrow(run, _STRETCH)


def _stretch_batch(held: list[tuple]) -> pa.RecordBatch:
    times = [len(h[1]) for h in held]
    return pa.record_batch(
        [
            pa.array(np.repeat(np.array([h[0] for h in held], np.int64), times)),
            pa.array(np.concatenate([h[1] for h in held]).view(np.int64)),
            pa.array(np.concatenate([h[2] for h in held]).view(np.int64)),
            pa.array(np.concatenate([h[3] for h in held]).astype(np.int32)),
            pa.array(np.concatenate([h[4] for h in held]).astype(np.int32)),
            pa.array(np.concatenate([h[5] for h in held])),
        ],
        names=["row", "key", "digest", "first", "last", "folds"],
    )


def _parts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the stretches that ``wanted`` lists for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, text, cuts in zip(*(batch[c].to_pylist() for c in ("row", "text", "cuts"))):
                raw = text.encode()
                rows += [(c["key"], row, c["first"], c["once"], raw[c["first"] : c["last"] + length]) for c in cuts]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "row", "first", "once", "part"]
            )

    # a text's own stretches, so no list outgrows its text
    per_text = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "first", "last", "once")).alias("cuts"))
    return texts.join(per_text, "row").select("row", "text", "cuts").mapInArrow(run, _PART)


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    kinds = (pa.int64(), pa.int32(), pa.int32())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["row", "first", "last"])


def _indexed(parts: DataFrame, length: int) -> DataFrame:
    """Starts of repeated strings of the parts that are alone of their content, key by key."""

    def search(tables: list[pa.Table]) -> pa.RecordBatch:
        held = pa.concat_tables(tables)
        raw, once = held["part"].to_pylist(), held["once"].to_pylist()
        of, first = (held[c].to_pylist() for c in ("row", "first"))
        found = repeated_in(raw, length)
        return _span_batch([(of[p], first[p] + a, first[p] + b) for p, a, b in found if once[p]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in groups_in_order(batches, ["key"], 4_000):
            cuts = np.append(boundaries(whole, ["key"]), whole.num_rows).tolist()
            long = pa.compute.binary_length(whole["part"]).to_numpy()
            begun = 0
            for a, b in zip(cuts, cuts[1:]):
                size += int(long[a:b].sum())
                if size >= _INDEX_BYTES:
                    yield search([*held, whole.slice(begun, b - begun)])
                    held, size, begun = [], 0, b
            if begun < whole.num_rows:
                held.append(whole.slice(begun))
        if held:
            yield search(held)

    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(run, _SPANS)


def _counted(parts: DataFrame, length: int) -> DataFrame:
    """The same for keys too large for one task: every string's digest, counted over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, first, once, raw in zip(*(batch[c].to_pylist() for c in ("row", "first", "once", "part"))):
                n = len(raw) - length + 1
                digests = [hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.record_batch(
                    [
                        pa.array([row] * n, pa.int64()),
                        pa.array(range(first, first + n), pa.int32()),
                        pa.array([once] * n, pa.bool_()),
                        pa.array(digests, pa.binary()),
                    ],
                    names=["row", "first", "once", "digest"],
                )

    strings = parts.mapInArrow(run, "row long, first int, once boolean, digest binary")
    again = strings.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    return strings.where("once").join(again, "digest", "left_semi").select("row", "first", F.col("first").alias("last"))


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    group_bytes: int = GROUP_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The texts (row, doc_id, text) and, per text, where repeated strings start: row, first, last."""
    # written once: a row's number must not change when a task runs again
    texts = saved(rows_of(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "texts")
    found = _stretches(texts, length, gram)
    shared = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"),
        F.max("folds").alias("folds"),
    )
    shared = shared.where("n > 1 or folds").select("key", (F.col("folds") | (F.col("low") != F.col("high"))).alias("mixed"))
    met = saved(found.drop("folds").join(shared, "key"), "stretches")
    mixed_rows = met.where("mixed")
    content = saved(
        mixed_rows.groupBy("key", "digest").agg(
            (F.count(F.lit(1)) == 1).alias("once"), F.min(F.struct("row", "first", "last")).alias("at")
        ),
        "contents",
    )
    more = content.where("not once").select("key", "digest")
    whole = met.where("not mixed").select("row", "first", "last").unionByName(
        mixed_rows.join(more, ["key", "digest"], "left_semi").select("row", "first", "last")
    )
    per_key = content.groupBy("key").agg(F.sum(F.col("at.last") - F.col("at.first") + F.lit(length).cast("long")).alias("n"))
    hot = per_key.where(F.col("n") > group_bytes).select("key")
    wanted = content.select("key", "once", "at.*")
    if hot.isEmpty():
        spans = _indexed(_parts(texts, wanted, length), length)
    else:
        spans = _indexed(_parts(texts, wanted.join(hot, "key", "left_anti"), length), length).unionByName(
            _counted(_parts(texts, wanted.join(hot, "key", "left_semi"), length), length)
        )
    return texts, whole.unionByName(spans)


def _removed(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of the bytes that the strings cover; runs that touch are one."""
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_bytes: bool = False, **options) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans [start, end).

    ``with_bytes`` adds the bytes that stay (they may end inside a character).
    """
    texts, spans = repeated_spans(docs, length, **options)
    per_text = spans.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "found"))):
                raw, cuts = text.encode(), _removed(found or [], length)
                edges = [0, *(x for cut in cuts for x in cut), len(raw)]
                kept = b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2]))
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest(),
                             [list(c) for c in cuts], kept if with_bytes else None))
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32())), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            out = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            yield out if with_bytes else out.drop_columns(["kept"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<int>>"
    joined = texts.join(per_text, "row", "left").select("doc_id", "text", "found")
    return joined.mapInArrow(run, schema + ", kept binary" * with_bytes)
