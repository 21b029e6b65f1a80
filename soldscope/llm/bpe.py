"""Byte-level BPE over Arrow batches: encoding with offsets, and decoding of split characters.

A text is cut by the splitting pattern; each distinct piece is encoded once a worker by the
``tokenizers`` library and kept as packed ids, so a text's ids are a join of kept pieces.

Defined results: a null text counts as empty and has no ids; ids outside the vocabulary cannot be
decoded (KeyError); decoding gives bytes, since ids may end inside a character; null and repeated
document ids pass through; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.models import BPE

from soldscope.llm.common import rows_of

KEPT_PIECES = 300_000  # about 50 MB a worker
_KEPT_LENGTH = 64  # longer pieces hardly recur
_TOGETHER = 300_000  # characters whose new pieces are encoded in one call


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints in Latin-1, else from U+0100 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


_SHOWN = dict(enumerate(byte_characters()))


def pack(kind: str, ids: list[int]) -> bytes:
    return np.array(ids, kind).tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def tokenizer_of_ranks(ranks: dict[bytes, int]) -> Tokenizer:
    """A tokenizer that joins, at each step, the neighbours whose union has the least rank."""
    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda kv: kv[1]):
        for i in range(1, len(token)):
            if token[:i] in ranks and token[i:] in ranks:
                merges.append((text[token[:i]], text[token[i:]]))
    model = BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    return Tokenizer(model)


class PieceEncoder:
    """Packed little-endian ids of texts; ``specials`` are strings with an id of their own."""

    def __init__(self, tokenizer: Tokenizer, pattern: str, specials: dict[str, int] | None = None):
        self.tokenizer = tokenizer
        self.split = regex.compile(pattern).findall
        self.specials = {s: np.array([i], "<u4").tobytes() for s, i in (specials or {}).items()}
        self.around = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split if self.specials else None
        self.kept: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if self.around and any(s in text for s in self.specials):
            return [p for part in self.around(text) for p in ([part] if part in self.specials else self.split(part))]
        return self.split(text)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.pieces(text))
            size += len(text)
            if size >= _TOGETHER:
                yield from self._packed(held)
                held, size = [], 0
        yield from self._packed(held)

    def _packed(self, rows: list[list[str]]) -> Iterator[bytes]:
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        met = set().union(*rows)
        new = [p for p in met if p not in self.kept]
        found = dict(zip(new, self._ids(new)))
        self.kept.update(x for x in found.items() if len(x[0]) <= _KEPT_LENGTH)
        own = self.kept
        if any(len(p) > _KEPT_LENGTH for p in new):
            own = {p: found[p] if p in found else self.kept[p] for p in met}
        for pieces in rows:
            yield b"".join([own[p] for p in pieces])

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Each piece's bytes as characters, through the library's merges."""
        merge = self.tokenizer.model.tokenize
        shown = [p.encode().decode("latin-1").translate(_SHOWN) for p in pieces]
        return [self.specials.get(p) or pack("<u4", [t.id for t in merge(s)]) for p, s in zip(pieces, shown)]


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str) -> PieceEncoder:
    return PieceEncoder(tokenizer_of_ranks(read_ranks(path)), pattern)


@lru_cache(maxsize=4)
def file_encoder(path: str, pattern: str) -> PieceEncoder:
    """The encoder of a byte-level tokenizer's JSON file, its special strings included."""
    with open(path, encoding="utf-8") as held:
        added = {t["content"]: t["id"] for t in json.load(held)["added_tokens"]}
    return PieceEncoder(Tokenizer.from_file(path), pattern, added)


@lru_cache(maxsize=4)
def byte_table(path: str) -> dict[int, bytes]:
    """The bytes of each id."""
    return {rank: token for token, rank in read_ranks(path).items()}


def decode(ids: bytes, table: dict[int, bytes]) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def offsets(ids: bytes, table: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last, in code points.

    Tokens that share a character through its bytes overlap in it.
    """
    tokens = [table[i] for i in np.frombuffer(ids, "<u4").tolist()]
    ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
    if not len(ends):
        return ends, ends
    raw = np.frombuffer(b"".join(tokens), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[np.concatenate([[0], ends[:-1]])], character[ends - 1] + 1


def encoded(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_offsets: bool = False
) -> DataFrame:
    """doc_id, ids and, if asked for, the offsets start and end of each token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = rank_encoder(path, pattern), byte_table(path)
        for batch in batches:
            packed = list(encoder.encode(batch["text"].to_pylist()))
            out = {"doc_id": batch["doc_id"], "ids": _lists([np.frombuffer(p, "<u4") for p in packed])}
            if with_offsets:
                places = [offsets(p, table) for p in packed]
                out["start"], out["end"] = (_lists([x[k] for x in places]) for k in (0, 1))
            yield pa.record_batch(out)

    schema = "doc_id long, ids array<int>" + ", start array<int>, end array<int>" * with_offsets
    return rows_of(docs, id_col, text_col).mapInArrow(run, schema)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32)
    ends = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def decoded(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes of arrays of ids; a null array gives no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path)
        for batch in batches:
            raw = [b"".join(map(table.__getitem__, ids or [])) for ids in batch["ids"].to_pylist()]
            yield pa.record_batch({"doc_id": batch["doc_id"], "bytes": pa.array(raw, pa.binary())})

    return coded.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids").mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the bytes that they decode to.

    Encoding and decoding run in one pass, so no ids leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = rank_encoder(path, pattern), byte_table(path)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids in encoder.encode(batch["text"].to_pylist()):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(decode(ids, table)).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(of_ids, pa.string()),
                    "decoded_sha256": pa.array(of_bytes, pa.string()),
                }
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows_of(docs, id_col, text_col).mapInArrow(run, schema)
