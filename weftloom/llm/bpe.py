"""Operator 6: byte-level BPE through a sentencepiece model that is serialised straight from a rank vocabulary.

Every token's bytes become a piece of printable characters, one for each byte; its score is its negative
rank, so that sentencepiece's best-scored merge is the lowest-ranked one. The normaliser is the identity. The model is
written as protocol-buffer bytes (public ``sentencepiece_model.proto``), so nothing is trained and no file is made.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

CACHE_ENTRIES = 200_000  # encoded pre-tokens kept by a task; a full cache is emptied, results stay the same
_TEXT_SLICE = 4_000_000  # characters of texts whose new pre-tokens are encoded together


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> list[str]:
    """A character for each byte: printable Latin-1 stands for itself, the others are moved up from 256 on."""
    own = [chr(b) if chr(b).isprintable() and not chr(b).isspace() else None for b in range(256)]
    spare = iter(range(256, 512))
    return [c or chr(next(spare)) for c in own]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


# Field numbers and codes of the public model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE, _TYPE_UNKNOWN = 1, 2, 3, 2
_MODEL_TYPE, _MODEL_TYPE_BPE, _VOCAB_SIZE, _TREAT_WHITESPACE_AS_SUFFIX = 3, 2, 4, 24
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 40, 41, 42, 43
_NAME, _ADD_DUMMY_PREFIX, _REMOVE_EXTRA_WHITESPACES, _ESCAPE_WHITESPACES = 1, 3, 4, 5


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """The model's bytes; id 0 is the unknown piece, id k + 1 the k-th token by rank."""
    letters = byte_characters()
    pieces = [_field(_PIECES, _field(_PIECE, "<unk>") + _field(_SCORE, 0.0) + _field(_TYPE, _TYPE_UNKNOWN))]
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        piece = "".join(letters[b] for b in token)
        pieces.append(_field(_PIECES, _field(_PIECE, piece) + _field(_SCORE, -float(rank))))
    trainer = (
        _field(_MODEL_TYPE, _MODEL_TYPE_BPE) + _field(_VOCAB_SIZE, len(pieces)) + _field(_UNK_ID, 0)
        + _field(_BOS_ID, -1) + _field(_EOS_ID, -1) + _field(_PAD_ID, -1)
    )
    normalizer = (
        _field(_NAME, "identity") + _field(_ADD_DUMMY_PREFIX, 0) + _field(_REMOVE_EXTRA_WHITESPACES, 0)
        + _field(_ESCAPE_WHITESPACES, 0)
    )
    return b"".join(pieces) + _field(_TRAINER, trainer) + _field(_NORMALIZER, normalizer)


class ByteBpe:
    """Encode and decode with the serialised model. A pre-token that is a token itself is that token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialize_model(ranks))
        self.split = regex.compile(pattern).findall
        self.letters = byte_characters()
        self.to_letters = {b: c for b, c in enumerate(self.letters)}
        by_rank = sorted(ranks.items(), key=lambda item: item[1])
        self.rank_of_id = np.array([0] + [rank for _, rank in by_rank], "<u4")
        self.bytes_of_rank = {rank: token for token, rank in by_rank}
        self.whole = ranks
        self.cache: dict[str, bytes] = {}

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.split(text) for text in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        self._learn(set().union(*parts).difference(self.cache))
        known = self.cache.__getitem__
        for tokens in parts:
            yield b"".join(map(known, tokens))

    def _learn(self, tokens: Iterable[str]) -> None:
        rest, raw = [], []
        for token in tokens:
            own = token.encode()
            rank = self.whole.get(own)
            if rank is None:
                rest.append(token)
                raw.append(own)
            else:
                self.cache[token] = struct.pack("<I", rank)
        letters = b"".join(raw).decode("latin-1").translate(self.to_letters)  # one character for each byte
        ends = list(accumulate(map(len, raw), initial=0))
        pieces = self.model.encode([letters[i:j] for i, j in pairwise(ends)], num_threads=1) if rest else []
        ids = self.rank_of_id[np.fromiter(chain.from_iterable(pieces), np.int64)].tobytes()
        ends = list(accumulate((4 * len(x) for x in pieces), initial=0))
        self.cache.update(zip(rest, (ids[i:j] for i, j in pairwise(ends))))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of_rank.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _TEXT_SLICE:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``ids``, the token ids of the whole text as little-endian unsigned 32-bit integers, to the columns ``keep``.

    A null text is encoded as an empty one, which has no ids. Special tokens are ordinary text. The vocabulary is
    broadcast, its size being that of the rank file. An empty table gives no rows; repeated rows are encoded alike.
    """
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))
    source = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = None
        for batch in batches:
            tool = tool or ByteBpe(*shared.value)
            at = batch.schema.get_field_index("__text")
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                ids = [x for _, texts in _slices(part.column(at).to_pylist()) for x in tool.encode_many(texts)]
                columns = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], [*keep, "ids"])

    fields = [source.schema[name] for name in keep]
    return source.mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.BinaryType())]))


def decode(df: DataFrame, ranks: dict[bytes, int], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``content``, the bytes that ``ids`` stand for; null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    source = df.select(*keep, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.__getitem__
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                content = [
                    None if ids is None else b"".join(map(known, np.frombuffer(ids, "<u4").tolist()))
                    for ids in part.column("ids").to_pylist()
                ]
                columns = [part.column(name) for name in keep] + [part.column("ids"), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "content"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField("content", T.BinaryType())]))


def digests(decoded: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Token count and SHA-256 digests of ids and decoded bytes."""
    return decoded.select(
        *keep,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"),
    )
