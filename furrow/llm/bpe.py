"""Byte-level BPE through a sentencepiece model that is written directly from a rank file.

Every byte is mapped to one private character. The pieces of the model are the vocabulary's byte
strings in these characters, scored by their negative rank, so merging the best pair first is
merging the lowest rank first. Normalisation is the identity, with no prefix and no change of
white space. A text is split by the pattern of the vocabulary, each split is encoded alone (a split
that is itself in the vocabulary is one token), and ids are the ranks. Decoding maps ids back to
byte strings.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import per_batch, with_fields

FIRST_CHARACTER = 0xE000  # private use area: byte b is chr(FIRST_CHARACTER + b)
KEPT_SPLITS = 500_000  # encoded splits that a task keeps at hand; others are encoded again
KEPT_LENGTH = 64  # longer splits are not kept
GROUP_LENGTH = 1 << 19  # characters whose splits are looked up together


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


_CHARACTERS = "".join(chr(FIRST_CHARACTER + b) for b in range(256))


def _mapped(piece: bytes) -> str:
    return codecs.charmap_decode(piece, "strict", _CHARACTERS)[0]


def _varint(value: int) -> bytes:
    out = bytearray()
    value &= (1 << 64) - 1
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto: piece 0 is unknown, piece 1 + i the i-th smallest rank."""
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)]
    for piece, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(_field(1, _mapped(piece).encode()) + _field(2, float(-rank)) + _field(3, 1))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, 0) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normalizer = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, piece) for piece in pieces) + _field(2, trainer) + _field(3, normalizer)


class Table:
    """Byte strings by number, joined for a whole array of numbers at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(x) for x in strings], np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        parts = []
        for low in range(0, len(numbers), 1 << 16):
            part = numbers[low : low + (1 << 16)]
            size = self.size[part]
            shift = self.begin[part] - (np.cumsum(size) - size)
            parts.append(self.data[np.repeat(shift, size) + np.arange(size.sum())])
        return np.concatenate(parts) if parts else self.data[:0]


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        import sentencepiece

        self.ranks = ranks
        self.ids = [rank for _, rank in sorted(ranks.items(), key=lambda x: x[1])]
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.piece_table = Table([self.pieces.get(i, b"") for i in range(max(self.ids, default=-1) + 1)])
        self.decimal_table = Table([b"%d," % i for i in range(max(self.ids, default=-1) + 1)])
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(ranks))
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}  # ids as 32-bit numbers

    def encode_splits(self, splits: list[str]) -> list[list[int]]:
        raw = [split.encode("utf-8", "surrogatepass") for split in splits]
        out = [[self.ranks[r]] if r in self.ranks else None for r in raw]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.model.encode([_mapped(raw[i]) for i in rest], num_threads=1)):
            out[i] = [self.ids[k - 1] for k in found]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_splits(self.split(text)) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, SHA-256 of the ids joined by commas, SHA-256 of the decoded bytes."""
        out, low = [], 0
        while low < len(texts):  # a group of texts of bounded length, or one text
            high, size = low + 1, len(texts[low])
            while high < len(texts) and size + len(texts[high]) <= GROUP_LENGTH:
                size += len(texts[high])
                high += 1
            out += self._digests(texts[low:high])
            low = high
        return out

    def _digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        splits = [self.split(text) for text in texts]
        if len(self.kept) > KEPT_SPLITS:
            self.kept.clear()
        new = list(set(chain.from_iterable(splits)).difference(self.kept))
        for low in range(0, len(new), 4096):
            part = new[low : low + 4096]
            self.kept.update(zip(part, [array("i", ids).tobytes() for ids in self.encode_splits(part)]))
        out = []
        for each in splits:
            ids = np.frombuffer(b"".join(map(self.kept.__getitem__, each)), np.int32)
            decimal = self.decimal_table.joined(ids)[:-1]
            out.append((len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(self.piece_table.joined(ids)).hexdigest()))
        for split in new:
            if len(split) > KEPT_LENGTH:
                del self.kept[split]
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def encoded(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns of ``documents`` with ``token_ids`` and ``decoded`` (the bytes that the ids stand for).

    Null texts count as empty and have no ids. Columns of these names in the input are replaced.
    The vocabulary file must lie at ``path`` on every executor.
    """
    kept = documents.drop("token_ids", "decoded")
    schema = with_fields(kept, token_ids="array<int>", decoded="binary")

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path, pattern)
        ids = [own.encode(text.as_py() or "") for text in batch.column("text")]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(x) for x in ids], pa.binary())],
            names=[*batch.schema.names, "token_ids", "decoded"],
        )

    return per_batch(kept, convert, schema)


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row's whole text; null is empty."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path, pattern)
        found = own.digests([text or "" for text in batch.column("text").to_pylist()])
        columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return per_batch(rows, convert, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
