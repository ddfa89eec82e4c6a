"""Byte-level BPE through a sentencepiece model that is written straight from the vocabulary.

Nothing is trained: every token of the rank file becomes a piece whose characters stand for its
bytes, scored by its negative rank, so that sentencepiece merges the lowest rank first.  The
normalizer is the identity.  Pre-tokens of the public pattern are encoded separately; decoding
looks the bytes of every id up again.

Null and empty texts have no tokens.  Every text is encoded whole, whatever its length; repeated
rows are encoded alike and stay separate rows.  Empty tables give empty results.
"""

from __future__ import annotations

import base64
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.llm.frames import kept_by_worker, map_batches, ragged, texts_of
from claimrisk.llm.pieces import Memory

# A byte stands in a piece as one character: U+0100 and up, none of which is white space.
FIRST_CHARACTER = 0x100
TO_CHARACTERS = {b: FIRST_CHARACTER + b for b in range(256)}


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens of a rank file (base64 token, blank, rank), by rank."""
    pairs = sorted((int(rank), base64.b64decode(token))
                   for token, rank in map(bytes.split, data.splitlines()) if token)
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in pairs]


def characters(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHARACTERS)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value >= 128:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model; piece 0 is the unknown piece, piece n + 1 the token of rank n.

    Field numbers and kinds are fixed values of the public model format.
    """
    unknown, bpe = 2, 2
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)]
    pieces += [_field(1, characters(t).encode()) + _field(2, -float(rank))
               for rank, t in enumerate(tokens)]
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, 0)
    for absent in (41, 42, 43):  # begin, end and padding: -1
        trainer += _field(absent, 2**64 - 1)
    identity = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, identity)


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece
        self.tokens = tokens
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.pieces = Memory(self._encode_pieces)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The model's ids of each piece, as 32-bit integers."""
        cut = [[p] if p[1:].isalpha() and p[0] == " " else self.split(p) for p in pieces]
        distinct = dict.fromkeys(t for ts in cut for t in ts)
        ids = self.model.encode([characters(t.encode()) for t in distinct], num_threads=1)
        spelled = dict(zip(distinct, [array("i", x).tobytes() for x in ids]))
        return [spelled[ts[0]] if len(ts) == 1 else b"".join([spelled[t] for t in ts])
                for ts in cut]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b, np.int32) - 1 for b in self.pieces.joined(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def encoded(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary, from the ids) of every document.

    The rank file is read once by the driver and broadcast: a vocabulary does not grow with the
    data.
    """
    with open(rank_file, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def work():
        codec = kept_by_worker("codec", data.value + pattern.encode(),
                               lambda: Codec(read_ranks(data.value), pattern))

        def function(rows):
            ids = codec.encode(rows["text"])
            return {"doc_id": rows["doc_id"], "ids": ragged(ids, np.int32),
                    "decoded": pa.array([codec.decode(x) for x in ids], pa.binary())}
        return function

    return map_batches(texts_of(docs), "doc_id long, ids array<int>, decoded binary", work)


def digests(encodings: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    return encodings.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
