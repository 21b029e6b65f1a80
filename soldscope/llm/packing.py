"""Best-fit packing of token pieces into sequences by linear grouping.

The driver sees one number a length (at most ``capacity`` of them), never documents. Large lengths are
rounded up within groups of equal cardinality, few-size configurations are optimised by column
generation, actual lengths take the places of rounded ones, what is left over goes in by best fit from
long to short, and so do the small lengths. The plan says which ranks of which length go where; ranks
are counted in parallel, so a third of all pieces may have one length.

Defined results: a null text counts as empty and is the end token alone; null and repeated ids pass
through; equal lengths are interchangeable (ties go by position in the input files); an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from math import floor

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from soldscope.llm.bpe import read_ranks
from soldscope.llm.common import rows_of, saved

CAPACITY = 2048
GROUPS = 32
SMALL_SHARES = (2, 4)  # lengths up to capacity / share are small; the better plan of these is taken
END_ID = 0


# ---- the plan, over counts of lengths -------------------------------------------------------------


class Bins:
    """Classes of like sequences: [(length, times), ...] patterns with a number, by room left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)
        self.rooms: list[int] = []

    def add(self, pattern: tuple[tuple[int, int], ...], n: int) -> None:
        room = self.capacity - sum(s * k for s, k in pattern)
        if room not in self.by_room or not self.by_room[room]:
            insort(self.rooms, room)
        self.by_room[room].append((pattern, n))

    def best_fit(self, size: int, count: int) -> None:
        """Each of ``count`` pieces goes where the least room is left over; new sequences if nowhere."""
        while count:
            i = int(np.searchsorted(self.rooms, size))
            if i == len(self.rooms):
                pattern, n, room = (), count, self.capacity
            else:
                room = self.rooms[i]
                pattern, n = self.by_room[room].pop()
                if not self.by_room[room]:
                    self.rooms.pop(i)
            each = room // size
            full = min(n, count // each)
            if full:
                self.add(pattern + ((size, each),), full)
                count -= full * each
                n -= full
            if n and count and count < each:  # the last few share one sequence
                self.add(pattern + ((size, count),), 1)
                count, n = 0, n - 1
            if n and pattern:
                self.add(pattern, n)


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Long to short, cut into groups of equal cardinality; a length may lie in several groups."""
    total = sum(counts.values())
    share = -(-total // groups)
    out: list[list[tuple[int, int]]] = [[]]
    free = share
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            if not free:
                out.append([])
                free = share
            take = min(n, free)
            out[-1].append((size, take))
            n, free = n - take, free - take
    return [g for g in out if g]


def best_pattern(values: np.ndarray, sizes: list[int], capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the greatest total value that fits."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    size = np.array(sizes)
    for room in range(min(sizes), capacity + 1):
        fits = size <= room
        gain = np.where(fits, best[np.maximum(room - size, 0)] + values, -1.0)
        i = int(gain.argmax())
        best[room] = best[room - 1]
        if gain[i] > best[room] + 1e-12:
            best[room], pick[room] = gain[i], i
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            pattern[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in the best fractional packing, by column generation."""
    m = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(rounds):
        values = np.linalg.solve(basis.T, np.ones(m))
        worth, pattern = best_pattern(values, sizes, capacity)
        if worth <= 1 + 1e-7:
            break
        level = np.linalg.solve(basis, need)
        change = np.linalg.solve(basis, pattern)
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = pattern
    level = np.linalg.solve(basis, need)
    return [(basis[:, j].copy(), float(level[j])) for j in range(m)]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns of lengths and how many sequences follow each; every counted piece has its place."""
    plans = [_plan(counts, capacity, groups, share) for share in SMALL_SHARES]
    return min(plans, key=lambda p: sum(n for _, n in p))


def _plan(counts: dict[int, int], capacity: int, groups: int, share: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    bins = Bins(capacity)
    left = {s: n for s, n in counts.items() if n}
    if capacity in left:
        bins.add(((capacity, 1),), left.pop(capacity))
    small = capacity // share
    large = {s: n for s, n in left.items() if s > small}
    rest: dict[int, int] = defaultdict(int)
    if large:
        grouped = linear_groups(large, groups)
        rounded = [g[0][0] for g in grouped]
        stock = [[list(x) for x in g] for g in grouped]
        for pattern, level in configurations(rounded, [sum(n for _, n in g) for g in grouped], capacity):
            n = floor(level + 1e-6)
            slots = [(i, int(k)) for i, k in enumerate(pattern) if k]
            while n > 0:
                # as many sequences as the lengths at the head of each group allow
                alike = min((stock[i][0][1] // k for i, k in slots if stock[i]), default=0)
                times = max(1, min(n, alike))
                made: dict[int, int] = defaultdict(int)
                for i, k in slots:
                    want = k * times
                    while want and stock[i]:
                        take = min(want, stock[i][0][1])
                        made[stock[i][0][0]] += take // times if take == k * times else take
                        stock[i][0][1] -= take
                        want -= take
                        if not stock[i][0][1]:
                            stock[i].pop(0)
                if not made:
                    break
                bins.add(tuple(made.items()), times)
                n -= times
        for group in stock:
            for size, n in group:
                rest[size] += n
    for size in sorted(rest, reverse=True):
        bins.best_fit(size, rest[size])
    for size in sorted((s for s in left if s <= small), reverse=True):
        bins.best_fit(size, left[size])
    return [x for room in sorted(bins.by_room) for x in bins.by_room[room]]


class Places:
    """Where the piece of a given length and rank goes."""

    def __init__(self, patterns: list[tuple[tuple[tuple[int, int], ...], int]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        met: dict[int, int] = defaultdict(int)
        first = 0
        for pattern, n in patterns:
            at = 0
            for size, times in pattern:
                runs[size].append((met[size], first, times, at))
                met[size] += n * times
                at += size * times
            first += n
        self.sequences = first
        self.runs = {s: tuple(np.array(x, np.int64) for x in zip(*r)) for s, r in runs.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length):
            rows = np.flatnonzero(length == size)
            start, first, times, at = self.runs[int(size)]
            run = np.searchsorted(start, rank[rows], side="right") - 1
            within = rank[rows] - start[run]
            sequence[rows] = first[run] + within // times[run]
            offset[rows] = at[run] + within % times[run] * size
        return sequence, offset


# ---- pieces and their places, in Spark --------------------------------------------------------------


@lru_cache(maxsize=2)
def id_coder(ranks: str, tokenizer: str, pattern: str):
    """Ids as the tokenizer of the JSON file gives them.

    The rank file holds the same vocabulary and its library packs several times faster; texts with
    strings of special tokens, which only the JSON file knows, go to the tokenizer itself.
    """
    fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})
    whole = Tokenizer.from_file(tokenizer)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def code(text: str) -> np.ndarray:
        if any(s in text for s in special):
            ids = whole.encode(text, add_special_tokens=False).ids
        else:
            ids = fast.encode_ordinary(text)
        ids.append(END_ID)
        return np.array(ids, "<u4")

    return code


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of full length but perhaps the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(
    docs: DataFrame, ranks: str, tokenizer: str, pattern: str, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and where a task met it: part, and turn among its like."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = id_coder(ranks, tokenizer, pattern)
        part = TaskContext.get().partitionId()
        met: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = code(text)
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc_id, i, start, length, crc, part, met[length]))
                    met[length] += 1
            columns = list(zip(*rows)) or [()] * 7
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "turn"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, turn long"
    return rows_of(docs, id_col, text_col).mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    ranks: str,
    tokenizer: str,
    pattern: str,
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    # written once: part and turn must not change when a task runs again
    held = saved(pieces(docs, ranks, tokenizer, pattern, capacity, id_col, text_col), "pieces")
    per_part = held.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    places = Places(plan({r.length: r.n for r in counts}, capacity, groups))
    shared = docs.sparkSession.sparkContext.broadcast(places)  # grows with capacity, not with documents
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = held.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("turn")).alias("rank")
    )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.of(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield pa.record_batch(
                [*(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
