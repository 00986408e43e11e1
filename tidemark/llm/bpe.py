"""Byte-level BPE through a sentencepiece model that is serialised from the rank file.

The model file is written field by field as a protocol buffer: one piece per rank, its bytes mapped
to printable characters, scored by the negative rank so that sentencepiece merges in rank order, with
an identity normaliser that adds, removes and escapes nothing. Nothing is trained. Texts are split
by the pattern first and each match is encoded alone; a match that is a piece is that piece.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import PieceEncoder, byte_characters, id_and_text, id_bytes

#: Sentencepiece wants an unknown piece; ranks follow it.
_FIRST = 1
_UNKNOWN, _NORMAL, _BPE = 2, 1, 2
#: Stands between matches; beyond the 256 bytes.
_CUT = 0x2047


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [tokens[i] for i in range(len(tokens))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def serialise_model(tokens: list[bytes]) -> bytes:
    """Bytes of a sentencepiece model whose piece ``rank + 1`` is the token of that rank."""
    letters = byte_characters()
    pieces = [_piece("⁇", 0.0, _UNKNOWN)]  # a character that stands for no byte
    pieces += [_piece("".join(letters[b] for b in t), -float(rank), _NORMAL) for rank, t in enumerate(tokens)]
    trainer = _block(2, _number(3, _BPE) + _number(4, len(pieces)) + _number(40, 0) + _block(45, "⁇".encode())
                     + b"".join(_varint(f << 3) + _varint((1 << 64) - 1) for f in (41, 42, 43)))
    normaliser = _block(3, _block(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5)))
    return b"".join(pieces) + trainer + normaliser


class ByteBPE:
    """Encodes and decodes by the ranks in ``path``, splitting by ``pattern``."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self._decimals = [str(i).encode() for i in range(len(self.tokens))]
        letters = byte_characters()
        self._mapping = {i: c for i, c in enumerate(letters)} | {_CUT: "⁇"}
        self._split = regex.compile(pattern).findall
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        # Tokens that merging does not reach; a match equal to one is that token all the same.
        self._unreached = {t: i for i, t in enumerate(self.tokens) if self._merge(["".join(map(letters.__getitem__, t))])[0] != [i]}
        self.encode_all = PieceEncoder(self._encode_many, self._encode_whole, spaces=True)

    def _merge(self, mapped: list[str]) -> list[list[int]]:
        """Ids of byte-mapped matches. The unknown piece between them keeps them apart."""
        out: list[list[int]] = [[]]
        for i in self._model.encode("⁇".join(mapped)):
            if i < _FIRST:
                out.append([])
            else:
                out[-1].append(i - _FIRST)
        return out

    def _matches(self, matches: list[str]) -> list[list[int]]:
        letters = chr(_CUT).join([m.encode().decode("latin-1") for m in matches]).translate(self._mapping)
        found = self._merge([letters]) if matches else []
        if self._unreached:
            found = [[self._unreached[t]] if (t := m.encode()) in self._unreached else ids for m, ids in zip(matches, found)]
        return found

    def _encode_many(self, pieces: list[str]) -> list[bytes]:
        """``pieces`` have no white space but one leading space, so a line break between them is a match of its own."""
        matches = self._split("\n".join(pieces))
        found = iter(self._matches([m for m in matches if m != "\n"]))
        out: list[list[int]] = [[]]
        for m in matches:
            if m == "\n":
                out.append([])
            else:
                out[-1] += next(found)
        return list(map(id_bytes, out))

    def _encode_whole(self, text: str) -> list[int]:
        matches = self._split(text)
        return [i for start in range(0, len(matches), 4096) for ids in self._matches(matches[start:start + 4096]) for i in ids]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encode_all([text])), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        """The bytes the ids stand for; a character may be cut, so these need not be UTF-8."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])

    def decimals(self, ids: list[int]) -> bytes:
        decimals = self._decimals
        return b",".join([decimals[i] for i in ids])


@lru_cache(maxsize=2)
def _loaded(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids ARRAY<INT>), one per input row. A null or empty text has no ids."""
    def encode(batches):
        bpe = _loaded(path, pattern)
        for b in batches:
            parts = [np.frombuffer(x, "<i4") for x in bpe.encode_all(b["text"].to_pylist())]
            ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*parts, np.zeros(0, "<i4")])))
            yield pa.RecordBatch.from_arrays([b["doc_id"], ids], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, bytes BINARY) of (doc_id, ids); null ids give no bytes."""
    def decode(batches):
        bpe = _loaded(path, pattern)
        for b in batches:
            data = [bpe.decode(ids or []) for ids in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: n_tokens, sha256 of the decimal ids joined by commas, sha256 of the decoded bytes.

    Encodes, then decodes the ids, in one pass without an exchange; ids never leave the task. A null or
    empty text has 0 tokens and the digests of no bytes. Repeated rows each give a row.
    """
    def digest(batches):
        from hashlib import sha256

        bpe = _loaded(path, pattern)
        for b in batches:
            counts, of_ids, of_bytes = [], [], []
            for part in bpe.encode_all(b["text"].to_pylist()):
                ids = np.frombuffer(part, "<u4").tolist()
                counts.append(len(ids))
                of_ids.append(sha256(bpe.decimals(ids)).hexdigest())
                of_bytes.append(sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
