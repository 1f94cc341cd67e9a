"""Byte-level BPE with a sentencepiece model that is written straight from the ranks of a vocabulary.

Nothing is trained: every token of the rank file becomes a piece, its bytes mapped to printable characters, with the
negative rank as its score, so that sentencepiece joins the pair of lowest rank first. Normalisation is the identity.
Texts are cut by the vocabulary's pattern, each match is encoded on its own, and ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import slices, table, texts
from .queries import query

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Distinct matches that a worker keeps with their ids.
CACHED = 400_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, otherwise the next free one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str = RANKS) -> list[bytes]:
    """The tokens of a rank file in order of rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    """One protobuf field: bytes, a float or a whole number."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose piece ``rank + 1`` is the token of that rank; piece 0 is the unknown one."""
    to_char = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    out = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))]
    for rank, token in enumerate(tokens):
        piece = "".join(to_char[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, normal)))
    off = (1 << 64) - 1  # -1: there is no such piece
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, 0) + _field(41, off) + _field(42, off) + _field(43, off)
    out.append(_field(2, trainer))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


def _strings(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte strings end to end, with their starts and lengths."""
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    return np.frombuffer(b"".join(values), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


def _joined(ids: np.ndarray, strings) -> bytes:
    """The strings of ``ids`` one after another."""
    flat, starts, sizes = strings
    n = sizes[ids]
    ends = np.cumsum(n)
    if not len(ids) or not ends[-1]:
        return b""
    return flat[np.repeat(starts[ids] - (ends - n), n) + np.arange(ends[-1])].tobytes()


class Codec:
    """Encodes texts to ranks and decodes them; keeps the ids of matches it has seen."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        import regex
        import sentencepiece

        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.find = regex.compile(pattern.replace("[^\\s", "[^\\p{White_Space}").replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}")).findall
        self.to_char = dict(enumerate(byte_characters()))
        self.raw, self.decimal = _strings(tokens), _strings([b"%d " % k for k in range(len(tokens))])
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        matches = self.find(text)
        if len(self.cache) > CACHED:
            self.cache.clear()
        new = list({m for m in matches if m not in self.cache})
        if new:
            mapped = [m.encode().decode("latin-1").translate(self.to_char) for m in new]
            for m, ids in zip(new, self.model.encode(mapped, out_type=int, num_threads=1)):
                self.cache[m] = (np.array(ids, dtype="<u4") - 1).astype("<u4").tobytes()
        return np.frombuffer(b"".join(map(self.cache.__getitem__, matches)), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return _joined(ids, self.raw)

    def spelled(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by one space."""
        return _joined(ids, self.decimal)[:-1]


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text. A null or empty text has no ids; rows that repeat are encoded alike."""

    def run(batches):
        for ids, raw in slices(batches):
            made = [codec(path, pattern).encode(r.decode()) for r in raw]
            ends = np.cumsum([0, *map(len, made)])
            values = np.concatenate(made).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["doc_id", "ids"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id and the bytes that ``ids`` stand for; null ids give no bytes."""

    def run(batches):
        for batch in batches:
            raw = [codec(path, pattern).decode(np.array(ids or [], dtype=np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every whole text without moving the ids: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        def sha(b: bytes) -> str:
            return hashlib.sha256(b).hexdigest()

        for ids, raw in slices(batches):
            one = codec(path, pattern)
            made = [one.encode(r.decode()) for r in raw]
            columns = [ids, [len(m) for m in made], [sha(one.spelled(m)) for m in made], [sha(one.decode(m)) for m in made]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op1_byte_bpe")
def op1_byte_bpe(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))
