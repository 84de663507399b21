"""Byte-level BPE with a sentencepiece model that is serialised directly from a rank vocabulary.

The model file is a protocol buffer; the few fields that matter are written by hand. Each byte string of the
vocabulary becomes a piece of printable characters, one for each byte, scored by its negative rank, so
sentencepiece's merge order (highest score first, leftmost on ties) is that of the ranks. Normalisation is the
identity: no dummy prefix, no white space changes. Texts are cut by the pattern into pre-tokens, each encoded
separately; ids turn back into bytes by the inverse mapping. A pre-token that is itself in the vocabulary is one
token, as the rank format defines.

Defined results: null texts are empty (no tokens); texts of any length are encoded whole, in one row's memory;
repeated rows are each encoded; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a task's memory of encoded pre-tokens; it starts anew when full and is gone when the task ends.
CACHE = 200_000
#: Pre-tokens longer than this are encoded but not remembered.
CACHE_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a base64 byte string and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def byte_chars() -> list[str]:
    """A character for each byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(own)]
    return [chr(b if b not in others else 256 + others.index(b)) for b in range(256)]


def inverse_chars() -> dict[str, int]:
    """The byte that each character of ``byte_chars`` stands for."""
    return {c: b for b, c in enumerate(byte_chars())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model of the vocabulary. Piece 0 is the unknown piece; rank r is piece r + 1 of the sorted ranks."""
    chars = byte_chars()
    piece = lambda text, score, kind: _field(1, _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _field(3, kind))
    pieces = [piece("<unk>", 0.0, 2)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(piece("".join(chars[b] for b in token), float(-rank), 1))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, 0) + _varint(41 << 3) + _varint((1 << 64) - 1) + _varint(42 << 3) + _varint((1 << 64) - 1) + _varint(43 << 3) + _varint((1 << 64) - 1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder over one vocabulary and pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.order = sorted(self.ranks.values())
        self.pre_tokens = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.table = {b: c for b, c in enumerate(byte_chars())}
        # Ids turn back through the model's own pieces and the inverse of the byte map.
        byte = inverse_chars()
        self.bytes_of = {r: bytes(map(byte.__getitem__, self.model.id_to_piece(i + 1))) for i, r in enumerate(self.order)}
        self.known: dict[str, list[int]] = {}
        self.written: dict[str, tuple[str, bytes]] = {}

    def _encode_new(self, new: list[str]) -> list[list[int]]:
        raw = [t.encode() for t in new]
        pieces = self.model.encode([r.decode("latin-1").translate(self.table) for r in raw], out_type=int, num_threads=1)
        # A vocabulary entry is one token even where merges would not lead to it.
        return [[self.ranks[r]] if r in self.ranks else self._ranks_of(p) for r, p in zip(raw, pieces, strict=True)]

    def _ranks_of(self, pieces: list[int]) -> list[int]:
        if 0 in pieces:
            raise ValueError("the vocabulary lacks a byte")
        return [self.order[i - 1] for i in pieces]

    def _learn(self, tokens: list[str], known: dict, make) -> tuple[dict, dict]:
        """Sees to it that every pre-token is in ``known`` or, if it is long, in the second result."""
        if len(known) > CACHE:
            known.clear()
        new, far = list(set(tokens).difference(known)), {}
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for t, ids in zip(part, self._encode_new(part), strict=True):
                (known if len(t) <= CACHE_CHARS else far)[t] = make(ids)
        return known, {**known, **far} if far else known

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text in turn."""
        for text in texts:
            tokens = self.pre_tokens(text or "")
            _, found = self._learn(tokens, self.known, list)
            ids: list[int] = []
            for t in map(found.__getitem__, tokens):
                ids += t
            yield ids

    def digest_batch(self, texts: Iterable[str | None]) -> Iterator[tuple[int, str, str]]:
        """Of each text: tokens, SHA-256 of the decimal ids, SHA-256 of the bytes that the ids decode to.

        What is remembered of a pre-token is the decimal form of its ids and what these decode to.
        """
        make = lambda ids: (" ".join(map(str, ids)), self.decode(ids))
        for text in texts:
            tokens = self.pre_tokens(text or "")
            _, found = self._learn(tokens, self.written, make)
            parts = list(map(found.__getitem__, tokens))
            line = " ".join([p[0] for p in parts])
            raw = b"".join([p[1] for p in parts])
            yield line.count(" ") + 1 if line else 0, hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _loaded(path: str | None, pattern: str | None) -> ByteBpe:
    """The encoder; without a path or pattern the worker's own installed vocabulary."""
    own = default_vocabulary() if path is None or pattern is None else ("", "")
    return ByteBpe(os.fspath(path or own[0]), pattern or own[1])


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of the public 50k byte-level vocabulary, as the installed package has them."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _batches(rows: Iterator[pa.RecordBatch], rows_each: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for at in range(0, batch.num_rows, rows_each):
            yield batch.slice(at, rows_each)


def encode(df: DataFrame, path: str | None = None, pattern: str | None = None, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and the token ids of each text, as ``token_ids array<int>``."""
    names = _carried(df, text_col, carry)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for b in _batches(rows):
            ids = pa.array(bpe.encode_batch(b.column(0).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], ids], names=[*carry, "token_ids"])
        bpe.known.clear()

    return names.mapInArrow(work, _schema(names) + "token_ids array<int>")


def decode(df: DataFrame, path: str | None = None, ids_col: str = "token_ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and the bytes of each row's ids, as ``decoded binary``; null ids decode to nothing."""
    names = _carried(df, ids_col, carry)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, None)
        for b in _batches(rows):
            out = pa.array([bpe.decode(x or ()) for x in b.column(0).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], out], names=[*carry, "decoded"])

    return names.mapInArrow(work, _schema(names) + "decoded binary")


def digests(df: DataFrame, path: str | None = None, pattern: str | None = None, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, n_tokens, and SHA-256 digests of the ids and of the bytes that they decode to; one pass over the texts."""
    names = _carried(df, text_col, carry)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for b in _batches(rows):
            n, ids_sha, text_sha = zip(*bpe.digest_batch(b.column(0).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[*carry, "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.written.clear()

    return names.mapInArrow(work, _schema(names) + "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _carried(df: DataFrame, first: str, carry: tuple[str, ...]) -> DataFrame:
    return df.select(F.col(f"`{first}`").alias("_first"), *(F.col(f"`{c}`") for c in carry))


def _schema(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields[1:])
