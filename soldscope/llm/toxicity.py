"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled rows (at most ``EXAMPLES`` a class, those with the smallest hash of the
id) is the set of examples, equal texts once. Terms are lower-case words and, for inflected words, their
beginnings of ``STEMS`` letters. Every term of the examples is kept, however rare; document frequencies
count all documents. Weights are (1 + ln of the times) * ln((documents + 1) / (frequency + 1)). A term
that no example holds cannot bring a text nearer to one; lengths are taken over the examples' terms.

Examples lie in blocks, like beside like; for each term the index keeps its postings and their greatest
weight in each block. Terms of more than ``COMMON`` of the examples are kept as full rows, block by block.
Of a text's blocks the ``FIRST`` by the bound that the greatest weights give are read, then all that can
still reach the kth similarity, so the neighbours are exact. Votes weighted by similarity pass through a logistic curve
fitted on the examples themselves, each without its own vote.

Defined results: null and empty texts and texts without any of the examples' terms have no neighbours and the
vote 0; ties go to the example with the smaller id; rows with null labels or ids are not learned from;
ids repeated in the labels count once (the greatest label), in the documents as well (the greatest text);
with labels of one class only, or none,
every score is that class's share (0.5 if there is none); further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import fit_logistic, labelled_sample, rows_of, saved

EXAMPLES = 1000
NEIGHBOURS = 40
STEMS = (4, 5, 6)
BLOCK = 64
FIRST = 8
COMMON = 1 / 16
TEXTS = 64  # scored at a time
WORDS_HELD = 1 << 19
_WORDS = regex.compile(r"\p{L}+")
_ASCII_WORDS = re.compile("[a-z]+")


def words(text: str) -> list[str]:
    text = text.lower()
    return (_ASCII_WORDS if text.isascii() else _WORDS).findall(text)


def terms_of(word: str) -> list[str]:
    """The word, and the beginnings (marked ``*``) if it is longer."""
    return [word, *(word[:size] + "*" for size in STEMS if len(word) > size)]


class _Numbers(dict):
    """Numbers of words in the order they are met; the known terms of word ``i`` are flat[starts[i]:starts[i + 1]]."""

    def __init__(self, terms: dict[str, int]) -> None:
        self.terms = terms
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.int64)
        self.new: list[int] = []
        self.long: list[int] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        found = [self.terms[t] for t in terms_of(word) if t in self.terms]
        self.new += found
        self.long.append(len(found))
        return number

    def settle(self) -> None:
        """Take the words met since the last call into the arrays; room doubles, so copies stay few."""
        begun, end = len(self) - len(self.long), len(self)
        if not self.long:
            return
        if end >= len(self.starts):
            self.starts = np.concatenate([self.starts[: begun + 1], np.zeros(end + 1, np.int64)])
        self.starts[begun + 1 : end + 1] = self.starts[begun] + np.cumsum(self.long)
        first, last = int(self.starts[begun]), int(self.starts[end])
        if last > len(self.flat):
            self.flat = np.concatenate([self.flat[:first], np.empty(2 * last, np.int64)])
        self.flat[first:last] = self.new
        self.new, self.long = [], []


class TermCounter:
    """Known terms of texts and how often each occurs, many texts at a time; words met before keep their numbers."""

    def __init__(self, terms: dict[str, int]) -> None:
        self.terms = terms
        self.numbers = _Numbers(terms)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times), by text and term."""
        if len(self.numbers) > WORDS_HELD:
            self.numbers = _Numbers(self.terms)
        number, times, sizes = [], [], []
        for text in texts:
            met = Counter(words(text))
            number.extend(map(self.numbers.__getitem__, met))
            times.extend(met.values())
            sizes.append(len(met))
        self.numbers.settle()
        word, held = np.array(number, np.int64), self.numbers
        first, long = held.starts[word], held.starts[word + 1] - held.starts[word]
        text = np.repeat(np.repeat(np.arange(len(texts)), sizes), long)
        place = text * max(1, len(self.terms)) + held.flat[ranges(first, first + long)]
        place, at = np.unique(place, return_inverse=True)
        summed = np.bincount(at, np.repeat(np.array(times, float), long), len(place))
        return *np.divmod(place, max(1, len(self.terms))), summed


def ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [first, end), one range after another."""
    long = end - first
    return np.repeat(first - np.cumsum(long) + long, long) + np.arange(long.sum())


class Postings:
    """Sparse weights, terms x examples. A term's postings lie in cells, one for each block that holds it."""

    def __init__(self, term: np.ndarray, place: np.ndarray, weight: np.ndarray, shape: tuple[int, int]) -> None:
        self.shape = shape
        order = np.lexsort((place, term))
        term, place, self.weight = term[order], place[order], weight[order]
        block = place // BLOCK
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        begun = np.flatnonzero(new)
        self.edges = np.append(begun, len(term))  # of the cells, in the postings
        self.place, self.block = place.astype(np.int32), block[begun].astype(np.int32)
        self.peak = np.maximum.reduceat(self.weight, begun) if len(begun) else np.empty(0)
        self.starts = np.searchsorted(term[begun], np.arange(shape[0] + 1))  # of the terms, in the cells

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        """The rows of these terms, zeros filled in."""
        out = np.zeros((len(rows), self.shape[1]))
        for i, row in enumerate(rows):
            at = slice(self.edges[self.starts[row]], self.edges[self.starts[row + 1]])
            out[i, self.place[at]] = self.weight[at]
        return out


def unit_vectors(counted: tuple[np.ndarray, np.ndarray, np.ndarray], texts: int, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the terms and their weights, of unit length; no terms where all weights are 0."""
    text, term, times = counted
    w = (1 + np.log(times)) * idf[term]
    norm = np.sqrt(np.bincount(text, w * w, texts))
    w = w / np.where(norm > 0, norm, 1)[text]
    edges = np.searchsorted(text, np.arange(texts + 1))
    none = np.empty(0, int), np.empty(0)
    return [(term[a:b], w[a:b]) if n > 0 else none for a, b, n in zip(edges, edges[1:], norm)]


def like_beside_like(rows: np.ndarray) -> np.ndarray:
    """Order of rows in which blocks hold similar ones: halves along the direction of most spread, again and again."""

    def halved(part: np.ndarray) -> np.ndarray:
        if len(part) <= BLOCK:
            return part
        x = rows[part] - rows[part].mean(axis=0)
        v = np.random.default_rng(len(part)).normal(size=x.shape[1])
        for _ in range(12):
            v = x.T @ (x @ v)
            v /= np.linalg.norm(v) or 1.0
        part = part[np.argsort(x @ v, kind="stable")]
        middle = BLOCK * max(1, round(len(part) / 2 / BLOCK))
        return np.concatenate([halved(part[:middle]), halved(part[middle:])])

    return halved(np.arange(len(rows)))


@dataclass
class BlockIndex:
    """Examples' unit vectors by term, and each term's greatest weight in each block of examples."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    weights: np.ndarray | Postings  # terms x examples, in the order of ids; held as postings
    common: np.ndarray = field(init=False)  # each common term's row in dense, else -1
    dense: np.ndarray = field(init=False)  # blocks x common terms x examples of the block
    peaks: np.ndarray = field(init=False)  # common terms x blocks

    def __post_init__(self) -> None:
        if not isinstance(self.weights, Postings):
            dense = self.weights
            self.weights = Postings(*np.nonzero(dense), dense[np.nonzero(dense)], dense.shape)
        examples = self.weights.shape[1]
        met = np.diff(self.weights.edges[self.weights.starts])
        rows = np.flatnonzero(met > COMMON * examples)
        self.common = np.full(len(met), -1)
        self.common[rows] = np.arange(len(rows))
        blocks = -(-examples // BLOCK)
        full = np.zeros((len(rows), blocks * BLOCK))
        full[:, :examples] = self.weights[rows]
        self.dense = np.ascontiguousarray(full.reshape(len(rows), blocks, BLOCK).transpose(1, 0, 2))
        self.peaks = np.ascontiguousarray(self.dense.max(axis=2, initial=0).T)

    def nearest(self, rows: np.ndarray, w: np.ndarray, k: int, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Examples (their places) with the k greatest similarities above 0, and the similarities."""
        return self.nearest_of_each([(rows, w)], k, [but])[0]

    def nearest_of_each(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int | None] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of many texts; a block's common terms are read for all of them while they are at hand."""
        asked = [_Asked(self, rows, w) for rows, w in vectors]
        for phase in (slice(None, FIRST), slice(FIRST, None)):
            parts = [a.open_blocks(phase, k) for a in asked]
            sums = [np.zeros(len(p) * BLOCK) for p in parts]
            text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            slot = np.concatenate([np.arange(len(p)) for p in parts]) * BLOCK
            block = np.concatenate(parts)
            for i in np.argsort(block, kind="stable").tolist():
                a, at = asked[text[i]], slot[i]
                # a sum of products, never a matrix product: its threads would wait for each other
                np.einsum("i,ij->j", a.by, self.dense[block[i]].take(a.shared, axis=0), out=sums[text[i]][at : at + BLOCK])
            for i, (a, part) in enumerate(zip(asked, parts)):
                if len(part):
                    a.read(part, sums[i], k, but[i] if but else None)
        return [(a.places, a.found) for a in asked]

    def vote(self, places: np.ndarray, similarity: np.ndarray) -> float:
        return float(similarity @ self.toxic[places] / similarity.sum()) if len(places) else 0.0


class _Asked:
    """A text on its way to its neighbours."""

    def __init__(self, index: BlockIndex, rows: np.ndarray, w: np.ndarray) -> None:
        self.index, held = index, index.weights
        common = index.common[rows]
        rare = common < 0
        self.shared, self.by = common[~rare], w[~rare]
        first, end = held.starts[rows[rare]], held.starts[rows[rare] + 1]
        self.cells, self.w = ranges(first, end), np.repeat(w[rare], end - first)
        self.block = held.block[self.cells]
        self.bound = np.bincount(self.block, self.w * held.peak[self.cells], len(index.dense)) + 1e-9
        self.bound += np.einsum("i,ij->j", self.by, index.peaks[self.shared])
        order = np.argsort(-self.bound, kind="stable")
        self.order = order[self.bound[order] > 1e-9]
        self.places, self.found = np.empty(0, int), np.empty(0)

    def open_blocks(self, phase: slice, k: int) -> np.ndarray:
        """Blocks of a phase that can still hold one of the k nearest."""
        part = self.order[phase]
        return part[self.bound[part] >= self.found[-1]] if len(self.found) == k else part

    def read(self, part: np.ndarray, sums: np.ndarray, k: int, but: int | None) -> None:
        """Take in the examples of some blocks; ``sums`` holds what the common terms add."""
        held, blocks = self.index.weights, len(self.index.dense)
        chosen, move = np.zeros(blocks, bool), np.zeros(blocks, int)
        chosen[part], move[part] = True, (np.arange(len(part)) - part) * BLOCK
        read = np.flatnonzero(chosen[self.block])
        cell = self.cells[read]
        first = held.edges[cell]
        long = held.edges[cell + 1] - first
        at = ranges(first, first + long)
        slot = held.place[at] + np.repeat(move[self.block[read]], long)
        score = np.bincount(slot, np.repeat(self.w[read], long) * held.weight[at], len(sums)) + sums
        here = np.flatnonzero(score > 0)
        place = part[here // BLOCK] * BLOCK + here % BLOCK
        if but is not None:
            other = self.index.ids[place] != but
            here, place = here[other], place[other]
        places, found = np.concatenate([self.places, place]), np.concatenate([self.found, score[here]])
        if len(found) > k:
            good = found >= np.partition(found, -k)[-k]
            places, found = places[good], found[good]
        best = np.lexsort((self.index.ids[places], -found))[:k]
        self.places, self.found = places[best], found[best]


@dataclass(frozen=True)
class ToxicityModel:
    index: BlockIndex | None
    slope: float = 0.0
    intercept: float = 0.0
    constant: float | None = None

    def probability(self, votes: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(votes), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * votes + self.intercept, -500, 500)))


_COUNTED = "doc_id long, terms array<int>, times array<int>, totals boolean"


def count_terms(docs: DataFrame, terms: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's known terms and how often each occurs, written; the texts are read this once.

    Each task adds a row (``totals``) with the documents that hold each term, and -1 for all its documents.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # the terms of 2 * EXAMPLES rows at most

    def batch_of(ids: pa.Array, sizes: np.ndarray, term: np.ndarray, times: np.ndarray, totals: bool) -> pa.RecordBatch:
        edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (term, times)]
        return pa.record_batch([ids, *lists, pa.array([totals] * len(sizes), pa.bool_())], names=["doc_id", "terms", "times", "totals"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, n, met = TermCounter(shared.value), 0, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            n += batch.num_rows
            for begun in range(0, batch.num_rows, TEXTS):
                texts = batch["text"].slice(begun, TEXTS).to_pylist()
                text, term, times = counter(texts)
                met += np.bincount(term, minlength=len(met))
                yield batch_of(batch["doc_id"].slice(begun, TEXTS), np.bincount(text, minlength=len(texts)), term, times, False)
        at = np.flatnonzero(met)
        yield batch_of(pa.array([None], pa.int64()), np.array([len(at) + 1]), np.append(at, -1), np.append(met[at], n), True)

    # long lists: small row groups keep little of them in a writer's memory
    return saved(rows_of(docs, id_col, text_col).mapInArrow(run, _COUNTED), "terms", **{"parquet.block.size": str(16 << 20)})


def document_frequencies(counted: DataFrame, terms: int) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each of the numbered terms, over all documents."""
    pairs = counted.where("totals").select(F.explode(F.arrays_zip("terms", "times")).alias("p"))
    # two columns of numbers, the examples' terms + 1 rows
    summed = pairs.groupBy("p.terms").agg(F.sum("p.times").alias("n")).toArrow()
    out = np.zeros(terms + 1, int)  # the last one counts the documents
    out[summed["terms"].to_numpy()] = summed["n"].to_numpy()
    return int(out[-1]), out[:-1]


def _widest_terms(vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, most: int = 1024) -> np.ndarray:
    """The vectors over the terms that most of them hold."""
    met = np.bincount(np.concatenate([at for at, _ in vectors]), minlength=terms)
    column = np.full(terms, -1)
    column[np.argsort(-met, kind="stable")[:most]] = np.arange(min(most, terms))
    out = np.zeros((len(vectors), min(most, terms)))
    for i, (at, w) in enumerate(vectors):
        known = column[at] >= 0
        out[i, column[at[known]]] = w[known]
    return out


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", examples: int = EXAMPLES, k: int = NEIGHBOURS
) -> tuple[ToxicityModel, DataFrame | None]:
    """The model, and the counted terms of ``docs`` by which ``counted_scores`` scores them without their texts."""
    sample, total = labelled_sample(docs, labels, label_col, examples)
    # of copies of one text only one example, else they would be each other's nearest; of rows that share an id one too
    sample = sample.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y"))
    sample = sample.groupBy("doc_id").agg(F.max(F.struct("text", "y")).alias("row")).select("doc_id", "row.*")
    if not total.get(0) or not total.get(1):
        return ToxicityModel(None, constant=0.5 if not any(total.values()) else float(bool(total.get(1)))), None
    rows = sample.orderBy("doc_id").collect()  # at most 2 * examples
    if len({r.y for r in rows}) < 2:
        return ToxicityModel(None, constant=total[1] / (total[0] + total[1])), None
    ids = [r.doc_id for r in rows]
    terms = {t: i for i, t in enumerate(sorted({t for r in rows for word in set(words(r.text)) for t in terms_of(word)}))}
    counted = count_terms(docs, terms)
    n, df = document_frequencies(counted, len(terms))
    idf = np.log((n + 1) / (df + 1))
    counter, vectors = TermCounter(terms), []
    for begun in range(0, len(rows), TEXTS):
        texts = [r.text for r in rows[begun : begun + TEXTS]]
        vectors += unit_vectors(counter(texts), len(texts), idf)
    order = like_beside_like(_widest_terms(vectors, len(terms)))
    rows, ids, vectors = ([held[i] for i in order] for held in (rows, ids, vectors))
    at, w = (np.concatenate(parts) for parts in zip(*vectors))
    places = np.repeat(np.arange(len(ids)), [len(at) for at, _ in vectors])
    postings = Postings(at[w > 0], places[w > 0], w[w > 0], (len(terms), len(ids)))
    index = BlockIndex(terms, idf, np.array(ids), np.array([r.y for r in rows], float), postings)
    votes = np.array([index.vote(*f) for f in index.nearest_of_each(vectors, k, ids)])
    y = index.toxic
    slope, intercept = fit_logistic(votes, y)
    # the sample holds the classes evenly: their true odds shift the curve
    odds = math.log(total[1] / total[0]) - math.log(max(1.0, y.sum()) / max(1.0, (1 - y).sum()))
    return ToxicityModel(index, slope, intercept + odds), counted


_SCORES = "doc_id long, vote double, score double, examples array<long>, similarities array<double>"


def _scored(ids: pa.Array, vectors: list[tuple[np.ndarray, np.ndarray]], model: ToxicityModel, k: int, shown: int) -> pa.RecordBatch:
    found = model.index.nearest_of_each(vectors, k) if model.index else [(np.empty(0, int), np.empty(0))] * len(vectors)
    votes = np.array([model.index.vote(*f) if model.index else 0.0 for f in found], float)
    near = [model.index.ids[places[:shown]].tolist() if model.index else [] for places, _ in found]
    return pa.record_batch(
        {
            "doc_id": ids,
            "vote": pa.array(votes),
            "score": pa.array(model.probability(votes), pa.float64()),
            "examples": pa.array(near, pa.list_(pa.int64())),
            "similarities": pa.array([similarity[:shown].tolist() for _, similarity in found], pa.list_(pa.float64())),
        }
    )


def toxicity_scores(
    docs: DataFrame, model: ToxicityModel, k: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text", shown: int = 3
) -> DataFrame:
    """doc_id, vote, score, and as evidence the ``shown`` nearest examples and their similarities."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the terms of 2 * EXAMPLES rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        counter = TermCounter(held.index.terms if held.index else {})
        for batch in batches:
            for begun in range(0, batch.num_rows, TEXTS):
                texts = batch["text"].slice(begun, TEXTS).to_pylist()
                vectors = unit_vectors(counter(texts), len(texts), held.index.idf) if held.index else [()] * len(texts)
                yield _scored(batch["doc_id"].slice(begun, TEXTS), vectors, held, k, shown)

    return rows_of(docs, id_col, text_col).mapInArrow(run, _SCORES)


def counted_scores(counted: DataFrame, model: ToxicityModel, k: int = NEIGHBOURS, shown: int = 3) -> DataFrame:
    """``toxicity_scores`` of the documents whose terms ``fit`` has counted."""
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for begun in range(0, batch.num_rows, TEXTS):
                part = batch.slice(begun, TEXTS)
                text = np.repeat(np.arange(part.num_rows), pc.list_value_length(part["terms"]).to_numpy())
                term, times = (part[c].flatten().to_numpy() for c in ("terms", "times"))
                vectors = unit_vectors((text, term.astype(np.int64), times), part.num_rows, held.index.idf)
                yield _scored(part["doc_id"], vectors, held, k, shown)

    return counted.where("not totals").select("doc_id", "terms", "times").mapInArrow(run, _SCORES)
