"""Byte-level BPE through a sentencepiece model serialised from a rank file.

The ranks become the pieces of a BPE model: every byte is written as one
character (U+0100 + byte), a piece's score is its negative rank, and the
normaliser is the identity.  Merging the best-scored pair first, leftmost on a
tie, is then merging by lowest rank.  A text is cut by the split pattern, each
pre-token is encoded on its own (one that is itself in the vocabulary is that
id), and ids decode through the inverse of the byte mapping.

Defined cases: null counts as the empty text, which has no ids; white space,
unknown scripts and very long pre-tokens are encoded whole; repeated rows give
repeated results.  A vocabulary without all 256 single bytes is refused.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens whose ids a task keeps at most (memory bound; no effect on ids).
CACHE_ENTRIES = 200_000
#: Characters of the texts that are cut at a time, or one longer text.
GROUP_CHARS = 1 << 20

_TO_CHAR = {i: chr(0x100 + i) for i in range(256)}


def byte_map(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHAR)


def byte_unmap(piece: str) -> bytes:
    return bytes(ord(c) - 0x100 for c in piece)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``base64 rank`` file (a vocabulary: a few MB at most)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n & (1 << 64) - 1)


def _bytes(field: int, raw: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(raw)) + raw


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto (public protobuf layout): pieces in rank
    order, then the obligatory unknown piece."""
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"vocabulary lacks the single bytes {missing[:8]}")
    out = []
    for raw, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = _bytes(1, byte_map(raw).encode()) + b"\x15" + np.float32(-rank).tobytes()
        out.append(_bytes(1, piece))
    unknown = _bytes(1, b"<unk>") + b"\x15" + np.float32(0).tobytes() + _number(3, 2)
    out.append(_bytes(1, unknown))
    trainer = (_number(3, 2) + _number(4, len(ranks) + 1) + _number(40, len(ranks))
               + b"".join(_number(f, -1) for f in (41, 42, 43)))
    normalizer = _bytes(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))
    out += [_bytes(2, trainer), _bytes(3, normalizer)]
    return b"".join(out)


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, proto: bytes, rank_of: list[int], pattern: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.split = regex.compile(pattern).findall
        n = len(rank_of)
        self.rank_of = np.array(rank_of, "<u4")
        raws = [byte_unmap(self.sp.id_to_piece(i)) for i in range(n)]
        self.whole = {raw: rank_of[i] for i, raw in enumerate(raws)}
        self.raw_of = {rank_of[i]: raw for i, raw in enumerate(raws)}
        self.cache: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        rest = []
        for token, raw in zip(new, map(str.encode, new)):
            if raw in self.whole:
                self.cache[token] = self.whole[raw].to_bytes(4, "little")
            else:
                rest.append((token, byte_map(raw)))
        if not rest:
            return
        ids = self.sp.encode([m for _, m in rest], num_threads=1)
        packed, at = self.rank_of[list(chain.from_iterable(ids))].tobytes(), 0
        for (token, _), own in zip(rest, ids):
            end = at + 4 * len(own)
            self.cache[token], at = packed[at:end], end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; what is
        new in any of the texts is learnt at once."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        cut = [self.split(t) for t in texts]
        self._learn(list(set().union(*cut).difference(self.cache)))
        return [b"".join(map(self.cache.__getitem__, tokens)) for tokens in cut]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of any number of texts, GROUP_CHARS characters at a time."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= GROUP_CHARS:
                yield from self.encode(group)
                group, size = [], 0
        yield from self.encode(group)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec_maker(ranks_path: str, pattern: str):
    ranks = read_ranks(ranks_path)
    proto, rank_of = model_proto(ranks), sorted(ranks.values())
    return lambda: Codec(proto, rank_of, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded): ``ids`` packed as little-endian unsigned
    32-bit integers, ``decoded`` the bytes that these ids stand for."""
    make = _codec_maker(ranks_path, pattern)
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches):
        codec = make()
        for batch in batches:
            ids = list(codec.encode_all([t or "" for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())], schema=schema)

    out = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
           .mapInArrow(run, "id long, n_tokens long, ids binary, decoded binary"))
    return out.withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str,
                     id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) of packed ids; null ids decode to nothing."""
    make = _codec_maker(ranks_path, pattern)

    def run(batches):
        codec = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([codec.decode(x or b"") for x in batch.column(1).to_pylist()], pa.binary())],
                names=["id", "decoded"])

    out = (encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
           .mapInArrow(run, "id long, decoded binary"))
    return out.withColumnRenamed("id", id_col)
