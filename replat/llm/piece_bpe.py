"""Byte-level BPE encoding and decoding through a serialised piece model (operator 10)."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from replat.llm.common import in_blocks, keyed_text, once

#: Byte b is written as this character plus b; letters, so that nothing is taken for white space.
FIRST = 0x100
REMEMBERED = 500_000


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One field in the wire format of protocol buffers."""
    if isinstance(value, str):
        value = value.encode()
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, in rank order; ranks must run from 0 without gaps."""
    with open(path, "rb") as file:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    return [found[i] for i in range(len(found))]


def piece_model(tokens: list[bytes]) -> bytes:
    """A serialised model whose piece r + 1 is the token of rank r, scored -r; piece 0 is the unknown one.

    Merging the pair with the highest score is then merging the pair of lowest rank. The normaliser is the
    identity and adds or removes no space.
    """
    unknown = _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)
    pieces = [_field(1, unknown)]
    for rank, token in enumerate(tokens):
        text = "".join(chr(FIRST + b) for b in token)
        pieces.append(_field(1, _field(1, text) + _field(2, -float(rank))))
    # trainer: BPE, its size, no begin, end or padding piece; normaliser: identity, three switches off
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, 0)
    trainer += b"".join(_field(n, 2**64 - 1) for n in (41, 42, 43))
    normaliser = _field(1, "identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Ids of a pre-token, and the bytes of ids."""

    def __init__(self, path: str):
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_model(self.tokens))
        self.letters = [chr(FIRST + b) for b in range(256)]

    def encode(self, parts: list[bytes]) -> list[list[int]]:
        letters = self.letters
        mapped = ["".join([letters[b] for b in part]) for part in parts]
        return [[i - 1 for i in ids] for ids in self.model.encode(mapped, out_type=int, num_threads=1)]

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def encode_text(codec: Codec, split: regex.Pattern, text: str) -> list[int]:
    parts = split.findall(text)
    return [i for ids in codec.encode([p.encode() for p in parts]) for i in ids]


def _coded(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec: Codec = once(f"codec:{path}", lambda: Codec(path))
    split = regex.compile(pattern)
    known: dict[str, tuple[int, str, bytes]] = once(f"coded:{path}:{pattern}", dict)
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts, ids_hash, bytes_hash = [], [], []
        for first, last in in_blocks(texts):
            found = [split.findall(t) for t in texts[first:last]]
            if len(known) > REMEMBERED:
                known.clear()
            new = list(set().union(*found).difference(known))
            for token, ids in zip(new, codec.encode([t.encode() for t in new]), strict=True):
                known[token] = (len(ids), " ".join(map(str, ids)), codec.decode(ids))
            for tokens in found:
                coded = [known[t] for t in tokens]
                counts.append(sum([c[0] for c in coded]))
                ids_hash.append(hashlib.sha256(" ".join([c[1] for c in coded]).encode()).hexdigest())
                bytes_hash.append(hashlib.sha256(b"".join([c[2] for c in coded])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(bytes_hash, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def encoded(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids of every text as an array: ``doc_id``, ``ids``. A null or empty text has an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec: Codec = once(f"codec:{ranks}", lambda: Codec(ranks))
        split = regex.compile(pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [encode_text(codec, split, t or "") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return keyed_text(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, ranks: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The bytes of every id array: ``doc_id``, ``content``; null ids give empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec: Codec = once(f"codec:{ranks}", lambda: Codec(ranks))
        for batch in batches:
            content = [codec.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(content, pa.binary())], ["doc_id", "content"])

    narrow = rows.selectExpr(f"cast(`{key}` as long) as doc_id", f"cast(`{ids}` as array<int>) as ids")
    return narrow.mapInArrow(run, "doc_id long, content binary")


def coded_digests(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes every text and decodes its ids again; the digests of both, one row for each input row.

    Each match of ``pattern`` is encoded by itself and special strings are ordinary text. Null and empty
    texts have no ids, and the digests of nothing. Repeated rows give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _coded(ranks, pattern, batches)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return keyed_text(docs, key, text).mapInArrow(run, schema)
