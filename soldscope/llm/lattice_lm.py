"""Marginal document probability over all segmentations into pieces of an existing vocabulary.

A document is its words, lower-case A to Z, then an end. A word, with the space before it, is any
sequence of the vocabulary's pieces that spells it; a piece has the share it takes of the distinct
training words when the vocabulary's own merges cut them. The forward recursion sums, in logarithms,
over all segmentations of a word, once a distinct word. One more arc spans a word as a whole: its share
of the training tokens, for which the pieces leave room as often as training met a new word (of N
tokens V + 1 were new). A document's score is the sum over its words and its end.

Counts of words and pieces cover all training documents. The most frequent words (``SHARED_WORDS`` at most) go
to every task (a bounded table); all other words of a document meet their counts in a join.

Defined results: a null text counts as empty and is the end alone; rows with equal ids are told apart
by their text, and equal rows each give their row; with no training rows every word is unknown and
pieces are equally likely; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.llm.bpe import rank_encoder, read_ranks
from soldscope.llm.common import mixed, rows_of, saved

SHARED_WORDS = 200_000
_HELD_WORDS = 400_000  # distinct words that a task holds before it hands its counts on
PIECE_PRIOR = 0.01
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LN10 = math.log(10)


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


class Lattice:
    """Log10 probability of a word over all its segmentations."""

    def __init__(self, pieces: list[bytes], log10: np.ndarray):
        usable = [i for i, p in enumerate(pieces) if p.split() and not any(c in p[1:] for c in b" \t\n\r\x0b\x0c")]
        usable += [i for i, p in enumerate(pieces) if p == b" "]
        self.known = {pieces[i]: float(log10[i]) for i in usable}
        self.longest = max(map(len, self.known), default=1)
        hashes = np.array([self._hash(p) for p in self.known], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], np.array(list(self.known.values()))[order]
        # a first look at 16 bits spares most searches
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _hash(piece: bytes) -> int:
        raw = np.frombuffer(piece, np.uint8).astype(np.uint64) + np.uint64(1)
        power = np.cumprod(np.full(len(raw), _BASE, np.uint64))
        return int(mixed(np.array([(raw * power).sum(dtype=np.uint64)]))[0])

    def words(self, words: list[bytes]) -> np.ndarray:
        """One value a word; words of one length go through the recursion together."""
        out = np.empty(len(words))
        size = np.array([len(w) for w in words])
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            if n > 64:
                out[rows] = [self.one(words[i]) for i in rows]
                continue
            for part in np.array_split(rows, -(-len(rows) // 20_000)):
                raw = np.frombuffer(b"".join([b" " + words[i] for i in part]), np.uint8).reshape(len(part), n + 1)
                out[part] = self._forward(raw)
        return out

    def _forward(self, raw: np.ndarray) -> np.ndarray:
        m, n = raw.shape
        power = np.cumprod(np.full(n, _BASE, np.uint64))
        down = np.cumprod(np.full(n, np.uint64(pow(int(_BASE), -1, 2**64)), np.uint64))
        sums = np.zeros((n + 1, m), np.uint64)
        np.cumsum((raw.T.astype(np.uint64) + np.uint64(1)) * power[:, None], axis=0, out=sums[1:])
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                shift = down[start - 1] if start else np.uint64(1)
                h = mixed((sums[end] - sums[start]) * shift)
                maybe = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
                if not len(maybe):
                    continue
                place = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                hit = self.hashes[place] == h[maybe]
                rows = maybe[hit]
                if len(rows):
                    alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + self.scores[place[hit]] * _LN10)
        return alpha[n] / _LN10

    def one(self, word: bytes) -> float:
        """The same recursion for one long word."""
        raw = b" " + word
        alpha = [0.0] + [-math.inf] * len(raw)
        for end in range(1, len(raw) + 1):
            paths = [
                alpha[start] + self.known[piece] * _LN10
                for start in range(max(0, end - self.longest), end)
                if (piece := raw[start:end]) in self.known and alpha[start] > -math.inf
            ]
            if paths:
                top = max(paths)
                alpha[end] = top + math.log(sum(math.exp(p - top) for p in paths))
        return alpha[-1] / _LN10


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c (times in training rows), n (times in all rows); ``texts`` has text and train."""

    def rows(train: Counter, rest: Counter) -> pa.RecordBatch:
        words = list(train.keys() | rest.keys())
        c = [train[w] for w in words]
        return pa.record_batch(
            [pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array([k + rest[w] for k, w in zip(c, words)], pa.int64())],
            names=["word", "c", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, rest = Counter(), Counter()
        for batch in batches:
            for text, learn in zip(batch["text"].to_pylist(), batch["train"].to_pylist()):
                (train if learn else rest).update(tokens(text))
                if len(train) + len(rest) > _HELD_WORDS:
                    yield rows(train, rest)
                    train, rest = Counter(), Counter()
        yield rows(train, rest)

    local = texts.select("text", "train").mapInArrow(run, "word binary, c long, n long")
    return local.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def piece_scores(words: DataFrame, ends: int, path: str, pattern: str) -> tuple[list[bytes], np.ndarray, float]:
    """The vocabulary's pieces, their log10 shares, and that of the end."""
    ranks = read_ranks(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path, pattern)
        total = np.zeros(len(ranks), np.int64)
        for batch in batches:
            shown = [" " + w.decode() for w in batch["word"].to_pylist()]
            for packed in encoder.encode(shown):
                np.add.at(total, np.frombuffer(packed, "<u4"), 1)
        met = np.flatnonzero(total)
        yield pa.record_batch({"piece": pa.array(met, pa.int64()), "n": pa.array(total[met])})

    counted = words.where("c > 0").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    n = np.zeros(len(ranks))
    for r in counted.collect():  # one row a piece of the vocabulary at most
        n[r.piece] = r.n
    pieces = [p for p, _ in sorted(ranks.items(), key=lambda kv: kv[1])]
    total = n.sum() + ends + PIECE_PRIOR * (len(pieces) + 1)
    return pieces, np.log10((n + PIECE_PRIOR) / total), math.log10((ends + PIECE_PRIOR) / total)


def frequent_from(words: DataFrame, most: int) -> int:
    """The least count at which at most ``most`` words are as frequent, to about one part in sixty.

    Words are counted by the logarithm of their count, a few thousand classes in any corpus.
    """
    by_class = words.groupBy(F.floor(F.log2("n") * 64).alias("class")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("low"))
    least, held = 2**62, 0
    for r in sorted(by_class.collect(), key=lambda r: -r["class"]):
        held += r.k
        if held > most:
            break
        least = r.low
    return least


def document_scores(
    docs: DataFrame, train: Column, path: str, pattern: str, shared_words: int = SHARED_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; ``train`` is a condition on doc_id."""
    spark = docs.sparkSession
    texts = rows_of(docs, id_col, text_col).withColumn("train", train)
    ends = texts.where("train").count()
    counts = saved(word_counts(texts), "words")
    known = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    total, distinct = (known.n or 0) + ends, (known.v or 0) + (ends > 0)
    low = math.log10(total + 0.5 * (distinct + 1))
    pieces, shares, end_share = piece_scores(counts, ends, path, pattern)
    model = spark.sparkContext.broadcast((pieces, shares))  # the size of the vocabulary
    tokens_met, fresh = total + distinct + 1, distinct + 1
    end_score = math.log10((ends + fresh * 10**end_share) / tokens_met)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model.value)
        for batch in batches:
            spelt = lattice.words(batch["word"].to_pylist()) + math.log10(fresh / tokens_met)
            c = batch["c"].to_numpy()
            whole = np.log10(np.maximum(c, 1) / tokens_met)
            own = np.where(c > 0, np.logaddexp(whole * _LN10, spelt * _LN10) / _LN10, spelt)
            yield pa.record_batch([*(batch[c] for c in ("word", "c", "n")), pa.array(own)], names=["word", "c", "n", "own"])

    valued = saved(counts.mapInArrow(value, "word binary, c long, n long, own double"), "valued-words")
    often = valued.where(F.col("n") >= frequent_from(valued, shared_words)).select("word", "c", "own").toArrow()  # shared_words rows at most
    held = spark.sparkContext.broadcast({c: often[c].to_pylist() for c in ("word", "c", "own")})
    end_base = math.log10(ends + 0.5) - low

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text one row of what the shared words give, and one row for each other word."""
        got = held.value
        own = {w: (math.log10(c + 0.5) - low, o, c > 0) for w, c, o in zip(got["word"], got["c"], got["own"])}
        for batch in batches:
            out: list[tuple] = []
            for doc_id, tkey, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "tkey", "text"))):
                words = Counter(tokens(text))
                n, met, base, score = 1, int(ends > 0), end_base, end_score
                for word, times in words.items():
                    n += times
                    if (one := own.get(word)) is not None:
                        base += times * one[0]
                        score += times * one[1]
                        met += times * one[2]
                    else:
                        out.append((word, doc_id, tkey, times, 0, 0, 0, 0.0, 0.0))
                # no word holds a space: this row finds no partner in the join
                out.append((b" %d" % tkey, doc_id, tkey, 0, 1, n, met, base, score))
                if len(out) > 100_000:
                    yield _split_batch(out)
                    out = []
            if out:
                yield _split_batch(out)

    schema = "word binary, doc_id long, tkey long, times int, rows int, n_tokens int, n_known int, base double, own double"
    parts = texts.withColumn("tkey", F.xxhash64("text")).select("doc_id", "tkey", "text").mapInArrow(split, schema)
    rest = valued.select("word", "c", F.col("own").alias("word_own"))
    met = parts.join(rest, "word", "left")
    base = F.when(F.col("times") > 0, F.col("times") * (F.log10(F.col("c") + 0.5) - F.lit(low))).otherwise(F.col("base"))
    own = F.when(F.col("times") > 0, F.col("times") * F.col("word_own")).otherwise(F.col("own"))
    known_here = F.when(F.col("times") > 0, F.when(F.col("c") > 0, F.col("times")).otherwise(0)).otherwise(F.col("n_known"))
    per_text = met.groupBy("doc_id", "tkey").agg(
        F.sum("rows").alias("rows"),
        *[F.sum(x).alias(name) for x, name in ((F.col("n_tokens"), "n_tokens"), (known_here, "n_known"), (base, "base"), (own, "own"))],
    )
    # equal rows were added up: give each its part
    return per_text.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        "doc_id",
        (F.col("n_tokens") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("rows")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("own") / F.col("rows")).alias("score"),
    )


def _split_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
    names = ["word", "doc_id", "tkey", "times", "rows", "n_tokens", "n_known", "base", "own"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
