"""Byte-level BPE through a sentencepiece model that is written directly from a rank file.

Every byte is mapped to a printable character, every token to the string of its characters.  That string
becomes a piece with the score -rank, so that the model merges the pair of lowest rank first, as the rank
file demands; there is no normalisation, no prefix and no white-space rule.  Texts are cut by the pre-token
pattern before; ids are ranks; decoding concatenates the bytes of the pieces.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.chunks import Pieces
from panelloom.llm.common import once_per_worker

# Field numbers and codes of the model format (pieces, trainer, normaliser).
NORMAL, UNKNOWN, BPE = 1, 2, 2
UNKNOWN_PIECE = "\u2585"

# White space as the pattern language of the rank files understands it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else the next one from U+0100."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, f)))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks are not consecutive from 0")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(tokens: Iterable[bytes]) -> bytes:
    """A serialised sentencepiece BPE model: piece i is token i with score -i; the unknown piece comes last."""
    signs = byte_characters()
    names = ["".join(signs[b] for b in token) for token in tokens]
    pieces = [(name, float(-i), NORMAL) for i, name in enumerate(names)] + [(UNKNOWN_PIECE, 0.0, UNKNOWN)]
    out = [_block(1, _block(1, name.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)) for name, score, kind in pieces]
    off = (1 << 64) - 1  # an id of -1: the piece does not exist
    trainer = _number(3, BPE) + _number(4, len(pieces)) + _number(40, len(names)) + b"".join(_varint(k << 3) + _varint(off) for k in (41, 42, 43)) + _block(45, UNKNOWN_PIECE.encode())
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _block(2, trainer) + _block(3, normaliser)


class Codec:
    """Encode texts to little-endian 32-bit ids and back."""

    def __init__(self, tokens: list[bytes], pattern: str):
        signs = byte_characters()
        self.tokens = tokens
        self.whole = {token: i for i, token in enumerate(tokens)}
        self.signs = str.maketrans({chr(b): signs[b] for b in range(256)})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))
        self.texts = Pieces(self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        """A pre-token that is a token has its id; the model merges the others."""
        parts = [[p.encode() for p in self.split.findall(t)] for t in texts]
        others = list({p for own in parts for p in own if p not in self.whole})
        ids = self.model.encode([p.decode("latin-1").translate(self.signs) for p in others], num_threads=1) if others else []
        packed = {p: np.array(own, dtype="<u4").tobytes() for p, own in zip(others, ids)}
        for own in parts:
            for p in own:
                if p not in packed:
                    packed[p] = struct.pack("<I", self.whole[p])
        return [b"".join(map(packed.__getitem__, own)) for own in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.texts(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text", step: int = 256) -> DataFrame:
    """(doc_id, ids as little-endian 32-bit integers, decoded bytes) of every whole text.

    A null or empty text has no ids.  Repeated rows give repeated rows, other columns are ignored.  The
    rank file is read by the driver and sent to the workers; `step` texts are encoded at a time.
    """
    tokens = read_ranks(ranks)
    key = hashlib.sha256(b"\n".join(base64.b64encode(t) for t in tokens) + pattern.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        own = once_per_worker(key, lambda: Codec(shared.value, pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = own.encode([x or "" for x in part.column(1).to_pylist()])
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())], names=["doc_id", "ids", "decoded"])
        own.texts.trim()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
