"""Byte-level BPE through a sentencepiece model written directly from a rank file.

The model's pieces are the vocabulary's byte strings, each byte mapped to one printable character,
scored by negative rank, so sentencepiece merges the pair with the lowest rank first and the
leftmost of equals, as the rank file means it. The normaliser is the identity. Texts are split into
pre-tokens first; each is encoded separately; decoding maps pieces back to bytes.

Cases: null and empty texts have no ids. Repeated rows and null ids give one row each. Whole texts
are encoded, whatever their length. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import plus

#: Distinct pre-tokens a task keeps with their ids.
CACHE = 400_000


def byte_characters() -> list[str]:
    """One character per byte: printable Latin-1 bytes stand for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary's byte strings in rank order."""
    ranks: dict[int, bytes] = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                piece, rank = line.split()
                ranks[int(rank)] = base64.b64decode(piece)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranks[n] for n in range(len(ranks))]


# --- the model file ---------------------------------------------------------------------------


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    """A protobuf field: bytes are length-delimited, whole numbers varints."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_file(vocabulary: list[bytes]) -> bytes:
    """A serialised sentencepiece model: piece 0 is the unknown piece, piece r + 1 has rank r."""
    of_byte = byte_characters()
    unknown, normal, bpe = 2, 1, 2  # fixed values of the model format
    pieces = [("⁇unknown", 0.0, unknown)]
    pieces += [("".join(of_byte[b] for b in piece), -float(rank), normal) for rank, piece in enumerate(vocabulary)]
    out = bytearray()
    for text, score, kind in pieces:
        score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
        out += _field(1, _field(1, text.encode()) + score_field + _field(3, kind))
    out += _field(2, _field(3, bpe) + _field(4, len(pieces)) + _field(24, 0))
    # Identity: no character map, no dummy prefix, white space left as it is.
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class Codec:
    """Encodes and decodes texts; one per Python worker and vocabulary."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.vocabulary = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_file(self.vocabulary))
        self.split = regex.compile(pattern).findall
        self.table = {b: c for b, c in enumerate(byte_characters())}
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        tokens = self.split(text)
        new = list(set(tokens).difference(self.known))
        if new:
            if len(self.known) + len(new) > CACHE:
                self.known, new = {}, list(set(tokens))
            mapped = [t.encode().decode("latin-1").translate(self.table) for t in new]
            for token, ids in zip(new, self.model.encode(mapped, out_type=int, num_threads=1)):
                self.known[token] = (np.array(ids, "<u4") - np.uint32(1)).tobytes()
        return b"".join(map(self.known.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


# --- on frames --------------------------------------------------------------------------------


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


#: Rows that are encoded or decoded at once: a worker keeps the memory it once used.
SLICE = 256


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(first, SLICE) for first in range(0, batch.num_rows, SLICE))


def encode(
    docs: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    keep: Iterable[str] = (),
) -> DataFrame:
    """(id, kept columns, token_ids binary): ids as little-endian unsigned 32-bit numbers.

    path: the rank file, at one place on every machine. ``keep`` names columns to carry along; other
    columns are left out, so none of them can clash.
    """
    pattern = pattern or default_pattern()
    keep = [c for c in keep if c not in (id_col, text_col, "token_ids")]
    rows = docs.select(id_col, *keep, F.coalesce(text_col, F.lit("")).alias(text_col))
    out = plus(rows.drop(text_col).schema, token_ids="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            ids = pa.array([own.encode(t.as_py()) for t in batch.column(at)], pa.binary())
            arrays = [a for n, a in enumerate(batch.columns) if n != at]
            names = [a for n, a in enumerate(batch.schema.names) if n != at]
            yield pa.RecordBatch.from_arrays([*arrays, ids], [*names, "token_ids"])

    return rows.mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, token_ids, kept columns, decoded binary): the bytes of the pieces, joined."""
    pattern = pattern or default_pattern()
    rows = encoded.select(id_col, "token_ids", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches):
            texts = pa.array([own.decode(t.as_py() or b"") for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [id_col, "token_ids", *keep, "decoded"])

    return rows.mapInArrow(run, plus(rows.schema, decoded="binary"))


def digest(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return decoded.select(
        id_col,
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

